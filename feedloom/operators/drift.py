"""What messages hold against what their reader expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def drift_report(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """(field, type, in_messages, in_contract, messages, nulls) for each field that either has.

    Fields are those of the JSON objects in ``value``; ``type`` is what all their values fit, ``messages`` how many hold
    the field and ``nulls`` how many of these a JSON null. A field of NULL stands for messages that are no object
    at all. A task sends one row a field, however many messages there are. Names are compared as they are written.
    """
    docs = messages.select(F.try_parse_json(F.col(value).cast("string")).alias("doc"))
    is_object = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False))
    # A map keeps the names of nested objects out; one row for each field of each message, and one for a message without.
    fields = F.when(is_object, F.coalesce(F.try_variant_get("doc", "$", "map<string,variant>"), F.create_map()))
    rows = docs.select(F.explode_outer(fields).alias("field", "held"), is_object.alias("object")).where(
        F.col("field").isNotNull() | ~F.col("object"))
    seen = rows.groupBy("field").agg(
        F.schema_of_variant_agg("held").alias("type"), F.count("*").alias("messages"),
        F.count(F.when(F.is_variant_null("held"), 1)).alias("nulls"))
    contract = messages.sparkSession.createDataFrame([(name,) for name in schema.fieldNames()], "name string")
    return seen.join(contract, F.col("field") == F.col("name"), "full_outer").select(
        F.coalesce("field", "name").alias("field"), F.when(F.col("field").isNotNull(), F.col("type")).alias("type"),
        F.col("messages").isNotNull().alias("in_messages"),
        F.col("name").isNotNull().alias("in_contract"), F.coalesce("messages", F.lit(0)).alias("messages"),
        F.coalesce("nulls", F.lit(0)).alias("nulls"))
