"""Session helpers: a configured SparkSession, the checkpoint location and
small literal tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "gleaner") -> SparkSession:
    """A session tuned for these jobs.

    On a cluster the caller's own session (with its shuffle partitions,
    executors and ``spark.checkpoint.dir``) is used instead; this helper is
    for tests and local runs.
    """
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local master without one gets a fresh
    private folder; any other session without one is an error, because
    executors would write to their own disks. Sessions without a SparkContext
    (Spark Connect) keep the server's setting."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context (Spark Connect)
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="gleaner-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (shared-storage) checkpoint so that a later
    executor loss never recomputes a non-deterministic upstream shuffle."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_once(df: DataFrame) -> DataFrame:
    """``df`` written once as parquet into the shared checkpoint folder and
    read from there, for rows that several branches of a plan read and that
    are dear to make; smaller than a checkpoint, which stores rows as they are."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_df(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table built inside the JVM (``inline`` over an array
    of structs), so scanning it never starts Python workers. For config
    tables and other bounded driver-side values only."""
    st = _parse_datatype_string(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
