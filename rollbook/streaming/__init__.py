"""The streaming job."""
