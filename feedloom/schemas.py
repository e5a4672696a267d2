"""Fixed contracts: the record shapes that cross a boundary between jobs."""

from pyspark.sql import types as T

# --- fixed values: field names, topics and table names the feeds agree on ---
USER_FIELDS = [
    "first_name", "last_name", "gender", "address", "postcode", "email",
    "username", "dob", "registered_date", "phone", "picture",
]
CREATED_USER_FIELDS = [
    "id", "first_name", "last_name", "gender", "address", "post_code", "email",
    "username", "registered_date", "phone", "picture",
]
ARTICLE_FIELDS = ["title", "excerpt", "date", "link", "author", "content", "image"]
USER_TOPIC = "user_created"
KAFKA_CHECK_TOPIC = "user_created_kafka"
SINGLE_USER_TOPIC = "single_user"
USER_DATABASE = "spark_streams"
USER_TABLE = "created_users"
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# --- end of fixed values ---


def strings(names):
    """A schema of nullable strings; ``from_json`` never enforces NOT NULL."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


USER = strings(USER_FIELDS)
CREATED_USER = strings(CREATED_USER_FIELDS)
ARTICLE = strings(ARTICLE_FIELDS)

# What a Kafka source delivers; the file stand-in for a topic has the same columns.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
