"""DataFrame-to-DataFrame steps, the same for batch and streaming input."""
