"""Session settings, the shared scratch root and table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Settings every job of the library relies on. AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes, and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (windows, joins, summaries) kept in RocksDB, not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "strata", cpus: str | int = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster the caller's session is used."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> None:
    """Pin the setting results depend on (UTC for windows and NTZ casts). Writers that
    need dynamic partition overwrite ask for it themselves."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables and stream checkpoints.

    Taken from the session (``spark.checkpoint.dir`` / ``setCheckpointDir``); only
    when neither is set, and only in local mode (tests), a folder of our own is set.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def new_scratch(spark: SparkSession, tag: str = "ws") -> str:
    return f"{scratch_root(spark)}/strata/{tag}-{uuid.uuid4().hex[:12]}"


class Tables(SimpleNamespace):
    """Readers of the given Parquet tables, each made on first use (pruning and pushdown
    stay with the scan)."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=TABLES):
        super().__init__()
        object.__setattr__(self, "_spark", spark)
        object.__setattr__(self, "_dir", sf_dir)
        object.__setattr__(self, "_names", tuple(names))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._names:
            raise AttributeError(name)
        df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        object.__setattr__(self, name, df)
        return df


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> Tables:
    return Tables(spark, sf_dir, names)


def sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run a SQL template whose ``{name}`` slots are DataFrames."""
    return spark.sql(text, **frames)
