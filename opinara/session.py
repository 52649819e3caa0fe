"""Session helpers: sensible SQL settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "opinara", cores: str = "8", memory: str = "12g",
                  shuffle_partitions: int = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the caller brings their own session; nothing in the package
    builds one.
    """
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for name, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset (tests) a local one is made
    and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="opinara-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared scratch folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by writing to the shared folder and reading back.

    Unlike a block on an executor's own disk, the written table outlives the
    executor, so an iterative consumer never recomputes from the source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows over the cores when the scan gives fewer tasks than there are cores.

    For plain scans ahead of heavy per-row work. A table of any real size
    already has more splits than cores and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-side table of a few rows, planned as a local relation."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))
