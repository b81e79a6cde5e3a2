"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class SessionOptions:
    """Settings of the jobs' session.

    `shuffle_partitions` is left to the cluster unless given; adaptive execution
    coalesces from there. Executor sizes belong to spark-submit, not to code.
    """

    app_name: str = "rollbook"
    master: str | None = None
    shuffle_partitions: int | None = None
    extra: Mapping[str, str] = field(default_factory=dict)


def build_session(options: SessionOptions = SessionOptions()) -> SparkSession:
    """Return a session for the jobs; failure to get one is raised, never swallowed."""
    builder = (
        SparkSession.builder.appName(options.app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A repeated key in a JSON document takes its last value instead of failing the document.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        # The JVM never compiles a method above this size. Flattening generates a larger one
        # when fused into a whole stage; split up instead, it takes a quarter less time.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if options.master:
        builder = builder.master(options.master)
    if options.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(options.shuffle_partitions))
    for name, value in options.extra.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder that every executor can reach.

    The cluster names it in `spark.checkpoint.dir`; without the setting a cluster is
    refused. Only where driver and executors are one process, as in tests and trials,
    does an unset one become a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="rollbook-")
    return f"{root.rstrip('/')}/rollbook/{purpose}-{uuid.uuid4().hex}"
