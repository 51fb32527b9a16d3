"""Session helpers: a local session for tests and the shared scratch folder of a cluster."""

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, name: str = "gradeloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that `spark.checkpoint.dir` names, which all executors must reach.

    There is no other place: without that setting it raises, in local sessions too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/gradeloom-{uuid.uuid4().hex}"
