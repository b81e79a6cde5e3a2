"""What existing readers and writers of the data rely on."""

from __future__ import annotations

# The stored record's columns, in order. All are text.
USER_COLUMNS = (
    "id",
    "full_name",
    "gender",
    "address",
    "postcode",
    "email",
    "user_name",
    "dob",
    "registered_date",
    "phone",
    "image",
)

# The parts of a raw user document that the record is made of. Leaves stay VARIANT,
# because the flattening rules tell a missing key from a JSON null.
DOCUMENT = """
    struct<
        name: struct<first: variant, last: variant>,
        gender: variant,
        location: struct<
            street: struct<number: variant, name: variant>,
            city: variant,
            state: variant,
            country: variant,
            postcode: variant>,
        email: variant,
        login: struct<username: variant>,
        dob: struct<date: variant>,
        registered: struct<date: variant>,
        phone: variant,
        picture: struct<medium: variant>>
"""
# Its objects: each may be left out, which reads as empty, but must not be anything else.
CONTAINERS = ("location", "location.street", "name", "login", "dob", "registered", "picture")

# Topic, namespace and table.
TOPIC = "users_created"
DATABASE = "spark_stream"
TABLE = "created_users"

# Fetch attempts for one request before it is given up; records published by one run.
MAX_ATTEMPTS = 5
QUOTA = 20

# Messages per micro-batch, and how often a continuous job looks for new ones.
MAX_PER_TRIGGER = 2000
INTERVAL = "5 seconds"

# The key-value store's connector and its write pacing, for when it is on the classpath.
STORE_FORMAT = "org.apache.spark.sql.cassandra"
STORE_PACING = {
    "spark.cassandra.output.concurrent.writes": "2",
    "spark.cassandra.output.throughputMBPerSec": "10",
}
