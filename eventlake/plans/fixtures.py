"""Pipeline inputs derived from the given tables.

The ``events`` table plays the usage topic, the status topic and the security topic; ``customer``
plays the identity directory. Every view is a projection of whole tables, so work grows with them.
``k`` is the number in an event's ``props`` and drives which rows are faulty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.json_safe import computed_once
from eventlake.schemas import EVENT_COLUMNS, EVENT_SCHEMA
from eventlake.sources.tables import read_table

_TIME = """concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00')"""


def base_events(spark: SparkSession, folder: str) -> DataFrame:
    return with_k(read_table(spark, folder, "events"))


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def usage_of(events: DataFrame, *extra: str) -> DataFrame:
    """Usage events: some without id (k=99), some with an empty service (k=98).

    ``extra`` are further SQL expressions over the same event row.
    """
    return events.selectExpr(
        "event_id AS seq",
        "CASE WHEN k <> 99 THEN concat('evt-', event_id) END AS event_id",
        "'usage' AS event_type",
        "CAST(user_id AS string) AS user_id",
        "concat('user', user_id % 15) AS username",
        """CASE WHEN k = 98 THEN '' ELSE
             CASE k % 5 WHEN 0 THEN 'api-gateway' WHEN 1 THEN 'billing' WHEN 2 THEN 'search'
                        WHEN 3 THEN 'recommendation' ELSE 'storage' END END AS service""",
        """CASE user_id % 5 WHEN 0 THEN 'request' WHEN 1 THEN 'read' WHEN 2 THEN 'write'
                           WHEN 3 THEN 'upload' ELSE 'download' END AS usage_type""",
        "CAST(floor(value) AS int) AS quantity",
        f"{_TIME} AS timestamp",
        "k",
        *extra,
    )


def usage(spark: SparkSession, folder: str) -> DataFrame:
    return usage_of(base_events(spark, folder))


def usage_json_of(events: DataFrame) -> DataFrame:
    """Usage records as JSON: k=97 is malformed, k=96 has its quantity as text."""
    rows = usage_of(events)
    text_quantity = [F.col(c).cast("string" if c == "quantity" else EVENT_SCHEMA[c].dataType).alias(c) for c in EVENT_COLUMNS]
    as_text = F.to_json(F.struct(*text_quantity))
    value = (
        F.when(F.col("k") == 97, "{bad")
        .when(F.col("k") == 96, as_text)
        .otherwise(F.to_json(F.struct(*EVENT_COLUMNS)))
    )
    return rows.select("seq", computed_once(value).alias("value"))


def usage_json_with_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Usage records by ``offset``; for k % 10 = 3 each comes again later with a larger quantity."""
    rows = usage(spark, folder).withColumn("copy", F.explode(F.expr("CASE WHEN k % 10 = 3 THEN array(0, 1) ELSE array(0) END")))
    rows = rows.withColumn("quantity", F.col("quantity") + F.col("copy"))
    value = F.when(F.col("k") == 97, "{bad").otherwise(F.to_json(F.struct(*EVENT_COLUMNS)))
    return rows.select((F.col("seq") * 2 + F.col("copy")).alias("offset"), value.alias("value"))


def usage_json(spark: SparkSession, folder: str) -> DataFrame:
    return usage_json_of(base_events(spark, folder))


def created_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events the gateway created; those with k % 19 = 0 exist only in status messages."""
    return base_events(spark, folder).where("k % 19 <> 0").selectExpr(
        "concat('evt-', event_id) AS event_id", "event_id * 10 AS created_arrival"
    )


def events_created_again(spark: SparkSession, folder: str) -> DataFrame:
    """Created events; every 40th is created once more, 300 events later."""
    return created_events(spark, folder).selectExpr(
        "event_id",
        "explode(CASE WHEN created_arrival % 400 = 0 THEN array(created_arrival, created_arrival + 3000) ELSE array(created_arrival) END) AS created_arrival",
    )


def late_messages(status: DataFrame) -> DataFrame:
    """Status rows of which some come much later: by 50 to 250 events, by the number of their event."""
    number = F.expr("CAST(substring(event_id, 5) AS bigint)")
    later = F.when(number % 3 == 0, (number % 5 + 1) * 500).otherwise(0)
    return status.withColumn("arrival", F.col("arrival") + later)


def status_messages_of(events: DataFrame) -> DataFrame:
    """Status messages as JSON, up to eight steps per event, some invalid.

    Batch retries, failures and missing steps follow from ``k``. The snapshot id of step 5 is a
    JSON null for k % 4 = 0.
    """
    steps = F.expr(
        """filter(array(
             struct(1 AS step, 'kafka' AS stage,
                    CASE WHEN k % 50 = 0 THEN 'failed' ELSE 'completed' END AS status),
             struct(2 AS step, 'spark' AS stage, 'processing' AS status),
             struct(3 AS step, 'spark' AS stage, 'completed' AS status),
             struct(4 AS step, 'iceberg' AS stage, 'processing' AS status),
             struct(5 AS step, 'iceberg' AS stage,
                    CASE WHEN k % 10 = 0 THEN 'failed' ELSE 'completed' END AS status),
             struct(6 AS step, 'spark' AS stage, 'failed' AS status),
             struct(7 AS step, 'minio' AS stage, 'processing' AS status),
             struct(8 AS step, 'minio' AS stage,
                    CASE WHEN k % 17 = 0 THEN 'failed' ELSE 'completed' END AS status),
             struct(9 AS step, 'minio' AS stage, '' AS status)),
           s -> CASE WHEN s.step = 9 THEN k % 23 = 0
                     WHEN s.step = 1 THEN true
                     WHEN k % 50 = 0 THEN false
                     WHEN s.step <= 4 THEN true
                     WHEN k % 13 = 0 THEN false
                     WHEN s.step = 5 THEN true
                     WHEN s.step = 6 THEN k % 10 = 0
                     ELSE k % 10 <> 0 END)"""
    )
    rows = events.select("event_id", "user_id", "k", F.inline(steps))
    value = F.expr(
        """concat('{"event_id":"evt-', event_id, '","stage":"', stage, '","status":"', status, '"',
             CASE WHEN step = 1 THEN concat(',"topic":"',
               CASE WHEN user_id % 7 = 0 THEN 'usage-replay' ELSE 'usage-events' END,
               '","partition":', user_id % 3) ELSE '' END,
             CASE WHEN step BETWEEN 3 AND 8 THEN concat(',"batch_id":', event_id div 100) ELSE '' END,
             CASE WHEN step = 5 AND k % 10 <> 0 THEN concat(',"snapshot_id":',
               CASE WHEN k % 4 <> 0 THEN CAST(1000 + event_id div 100 AS string) ELSE 'null' END) ELSE '' END,
             '}')"""
    )
    return rows.select(F.expr("event_id * 10 + step AS arrival"), computed_once(value).alias("value"))


def open_status_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Status messages of which those of the third and eighth step have a nested object or a flag besides."""
    more = F.expr(
        """CASE arrival % 10 WHEN 8 THEN concat(',"details":{"files":', arrival div 10 % 7, ',"ok":true,"paths":["a",null]}}')
                           WHEN 3 THEN ',"retried":false,"took":1.5}' ELSE '}' END"""
    )
    messages = status_messages(spark, folder)
    return messages.select("arrival", F.concat(F.expr("substring(value, 1, length(value) - 1)"), more).alias("value"))


def status_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of a topic keyed by event: its partitions, as many as a shuffle has, hold events by key.

    Only three narrow columns are shuffled, before each event becomes its up to nine messages.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = base_events(spark, folder).select("event_id", "user_id", "k")
    return status_messages_of(events.repartition(partitions, "event_id"))


def security_of(events: DataFrame) -> DataFrame:
    """Security events in arrival order ``seq``, with event times up to six hours out of order."""
    return events.selectExpr(
        "event_id AS seq",
        "CAST(event_id AS string) AS event_id",
        "CAST(ts AS timestamp) - make_interval(0, 0, 0, 0, k % 7, 0, 0) AS ets",
        "CASE WHEN event_type = 'error' THEN 'LOGIN_FAILED' ELSE upper(event_type) END AS event_type",
        """CASE k % 20 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('user', user_id % 15) END AS username""",
        "CASE WHEN k % 4 <> 0 THEN concat('10.10.', user_id % 256, '.', k) END AS ip_address",
        "'usage-api' AS client_id",
        "'main' AS realm",
        "k",
    )


def security(spark: SparkSession, folder: str) -> DataFrame:
    return security_of(base_events(spark, folder)).drop("k")


def security_json_of(events: DataFrame) -> DataFrame:
    """Security events as JSON: k=95 has an unreadable time, k=94 is malformed, odd k ends in Z."""
    time = F.concat(
        F.date_format("ets", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.when(F.col("k") % 2 == 1, "Z").otherwise("+00:00"),
    )
    body = F.to_json(
        F.struct(
            "event_id",
            F.when(F.col("k") == 95, "yesterday").otherwise(time).alias("timestamp"),
            F.lit("idp").alias("source"),
            "event_type",
            "username",
            "ip_address",
            "client_id",
            "realm",
        )
    )
    value = F.when(F.col("k") == 94, "{bad").otherwise(body)
    return security_of(events).select("seq", computed_once(value).alias("value"))


def security_json(spark: SparkSession, folder: str) -> DataFrame:
    return security_json_of(base_events(spark, folder))


# The usage table's history: one append per day, and one clear after day 19.
CLEAR_DAY = 19
FIRST_SNAPSHOT = 1001
CLEAR_SNAPSHOT = FIRST_SNAPSHOT + CLEAR_DAY + 1
EARLY_SNAPSHOT = 1010
LAST_FULL_SNAPSHOT = CLEAR_SNAPSHOT - 1
LATE_SNAPSHOT = 1026
_DAY = "datediff(CAST(ts AS date), DATE'2024-01-01')"
_COMMIT = f"CAST({FIRST_SNAPSHOT} + {{day}} + CASE WHEN {{day}} > {CLEAR_DAY} THEN 1 ELSE 0 END AS bigint)"


def table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Usage rows with an id, tagged with the commit that appended them."""
    return usage_of(base_events(spark, folder).where("k <> 99"), f"{_COMMIT.format(day=_DAY)} AS commit_seq")


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """The commit log: one append for each day with rows, and the clear."""
    days = base_events(spark, folder).where("k <> 99").selectExpr(f"{_DAY} AS day").distinct()
    entries = days.select(
        F.expr(
            f"""inline(filter(array(
              struct({_COMMIT.format(day="day")} AS seq, day, 'append' AS operation,
                     CAST(date_add(DATE'2024-01-01', day + 1) AS timestamp) AS committed_at),
              struct(CAST({CLEAR_SNAPSHOT} AS bigint) AS seq, day, 'delete' AS operation,
                     CAST(date_add(DATE'2024-01-01', day + 1) AS timestamp) + INTERVAL 1 SECOND AS committed_at)),
              c -> c.operation = 'append' OR day = {CLEAR_DAY}))"""
        )
    )
    return entries.select(
        "seq",
        F.col("seq").alias("snapshot_id"),
        F.when(F.col("seq") > FIRST_SNAPSHOT, F.col("seq") - 1).alias("parent_id"),
        "committed_at",
        "operation",
        F.create_map(F.lit("day"), F.col("day").cast("string")).alias("summary"),
        F.col("day").cast("long").alias("batch_id"),
    )


def changed_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Usage rows of a later version of the table: in every fourth day's, some lost, changed or doubled."""
    rows = daily_usage(spark, folder)
    copies = F.expr("CASE WHEN day % 4 <> 1 THEN 1 WHEN k = 41 THEN 0 WHEN k = 43 THEN 3 ELSE 1 END")
    more = F.when((F.col("day") % 4 == 1) & (F.col("k") == 42), 1).otherwise(0)
    return rows.withColumn("quantity", F.col("quantity") + more).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy")


def daily_usage(spark: SparkSession, folder: str) -> DataFrame:
    return usage_of(base_events(spark, folder), f"{_DAY} AS day")


def topic_log_of(events: DataFrame) -> DataFrame:
    """Records of a keyed topic, an internal topic and a broken one; the event's number is the record's offset."""
    topics = F.expr(
        """filter(array(
             struct('usage-events' AS topic, CAST(user_id % 3 AS int) AS partition, 0 AS error_code),
             struct('__consumer_offsets' AS topic, 0 AS partition, 0 AS error_code),
             struct('usage-dead' AS topic, CAST(user_id % 2 AS int) AS partition, 5 AS error_code)),
           t -> CASE t.topic WHEN '__consumer_offsets' THEN user_id % 50 = 0
                             WHEN 'usage-dead' THEN user_id % 50 = 1 ELSE true END)"""
    )
    return events.select("event_id", F.col("event_id").alias("offset"), F.inline(topics))


def topic_log(spark: SparkSession, folder: str) -> DataFrame:
    return topic_log_of(read_table(spark, folder, "events").select("event_id", "user_id"))


def people(spark: SparkSession, folder: str) -> DataFrame:
    """One person per customer: identity claims and a directory request, some of them faulty."""
    return read_table(spark, folder, "customer").selectExpr(
        "c_custkey AS seq",
        "CASE WHEN c_custkey % 7 = 0 THEN 'bad user!' ELSE concat('user', c_custkey) END AS username",
        """CASE WHEN c_custkey % 11 = 0 THEN '  '
                ELSE concat(' ', c_mktsegment, '  Van  Nation', c_nationkey, ' ') END AS full_name""",
        "concat('u', c_custkey, '@example.org') AS email",
        "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS department",
        """CASE c_nationkey % 3 WHEN 0 THEN array('user', 'ldap-admin')
                                WHEN 1 THEN array('user') END AS realm_roles""",
        "CASE WHEN c_custkey % 10 = 0 THEN array('data-admin') END AS roles",
    )


def claims(spark: SparkSession, folder: str) -> DataFrame:
    return people(spark, folder).selectExpr(
        "concat('sub-', seq) AS sub",
        "username AS preferred_username",
        "email",
        "trim(full_name) AS name",
        "CASE WHEN realm_roles IS NOT NULL THEN struct(realm_roles AS roles) END AS realm_access",
        "roles",
    )


def directory_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for new entries. Every fifth person asks for the same username."""
    wanted = F.when(F.col("seq") % 5 == 1, "shared.name").otherwise(F.col("username"))
    return people(spark, folder).select("seq", wanted.alias("username"), "full_name", "email", "department")


def directory_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Present directory entries, one per supplier, as attribute lists."""
    return read_table(spark, folder, "supplier").selectExpr(
        "array(concat('user', s_suppkey), concat('alias', s_suppkey)) AS uid",
        "array(s_name) AS cn",
        "CASE WHEN s_suppkey % 3 <> 0 THEN array(concat('s', s_suppkey, '@example.org')) END AS mail",
        """CASE WHEN s_suppkey % 4 = 0 THEN CAST(array() AS array<string>)
                ELSE array(concat('nation-', s_nationkey)) END AS departmentNumber""",
    )


def mixed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier rows with every kind of value JSON cannot carry as it is."""
    return read_table(spark, folder, "supplier").selectExpr(
        "s_suppkey",
        "encode(s_name, 'UTF-8') AS name_bytes",
        """CASE s_suppkey % 10 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity')
                               WHEN 2 THEN double('-Infinity') ELSE s_acctbal END AS balance""",
        "CAST(s_acctbal AS decimal(12, 2)) AS balance_exact",
        "timestamp_seconds(1704067200 + s_suppkey * 3600) + make_interval(0, 0, 0, 0, 0, 0, (s_suppkey % 2) * 0.25) AS seen_at",
        "date_add(DATE'2024-01-01', CAST(s_suppkey AS int)) AS seen_on",
        "array(CASE WHEN s_suppkey % 5 = 0 THEN double('NaN') ELSE double(s_nationkey) END) AS readings",
        "map(s_nationkey, named_struct('since', DATE'2024-01-01', 'ok', s_suppkey % 2 = 0)) AS by_nation",
    )
