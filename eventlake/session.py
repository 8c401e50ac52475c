"""Session set-up and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


# A shuffle starts with about one partition per this much input; small ones are coalesced at run time.
BYTES_PER_PARTITION = 128 * 1024**2
LEAST_PARTITIONS = 200


def shuffle_width(input_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """Shuffle partitions to start with for an input of this size."""
    return max(LEAST_PARTITIONS, -(-input_bytes // bytes_per_partition))


def build_session(
    app_name: str = "eventlake", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A UTC session with adaptive execution; extra settings win over the defaults here.

    Give ``input_bytes`` for large inputs: without it a shuffle has the cluster's default width,
    and adaptive execution can coalesce partitions and split skewed ones but not add to the rest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **({"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_width(input_bytes))} if input_bytes else {}),
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``, which must be set.

    A local session that was started without it gets a folder of the session's own warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
