"""Schemas of the records that flow through the library, and DDL derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

# One definition; the column list and the table DDL below are derived from it.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("usage_type", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# The event time travels as text; operators.security turns it into a timestamp.
SECURITY_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("realm", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Keys every status message must have. Its payload is open, so the whole parses to a map.
STATUS_KEYS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
STATUS_PAYLOAD = T.MapType(T.StringType(), T.StringType())

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
        T.StructField("batch_id", T.LongType()),
    ]
)


def ddl_columns(schema: T.StructType) -> str:
    """``name TYPE, ...`` for a flat schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_table_ddl(table: str, schema: T.StructType = EVENT_SCHEMA, provider: str = "iceberg") -> str:
    return f"CREATE TABLE IF NOT EXISTS {table} ({ddl_columns(schema)}) USING {provider}"


def create_namespace_ddl(table: str) -> str:
    """Namespace statement for a ``catalog.namespace.table`` name."""
    namespace, _, _ = table.rpartition(".")
    if not namespace:
        raise ValueError(f"table name has no namespace: {table}")
    return f"CREATE NAMESPACE IF NOT EXISTS {namespace}"
