"""Reading and writing tables."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import small_table

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# The column that names a row's run in a log.
RUN = "run_id"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             separator: str = ",", multi_line: bool = True) -> DataFrame:
    """CSV with a header; quoted fields may hold separators, quotes and newlines.

    Pass a schema wherever it is known: without one Spark reads the file twice.
    A file whose fields hold no newline is cut into many tasks with
    ``multi_line=False``; with newlines in fields it is one task.
    """
    reader = (spark.read.option("header", True).option("sep", separator).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"').option("encoding", "UTF-8"))
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def write_csv(df: DataFrame, path: str, separator: str = ",", mode: str = "overwrite") -> None:
    """CSV with a header that ``read_csv`` reads back unchanged, empty texts included."""
    (df.write.mode(mode).option("header", True).option("sep", separator).option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def load_csv(spark: SparkSession, path: str, target: str, separator: str = ",",
             group_sentiment: bool = False, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """Read, optionally turn ratings into sentiments, put the target last."""
    from opinara.operators.rows import relabel, target_last

    df = read_csv(spark, path, schema, separator, multi_line)
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; check the separator")
    return target_last(relabel(df, target, group_sentiment), target)


def class_folder(label: str) -> str:
    return label.replace(" ", "_").upper()


def split_by_class(df: DataFrame, target: str, path: str, part: str = "class_part") -> None:
    """One folder per non-null class, so a later read touches only its class.

    Every task writes its own files: a dominant class is spread over as many
    files as it has input partitions.
    """
    (df.filter(F.col(target).isNotNull())
     .withColumn(part, F.upper(F.replace(F.col(target).cast("string"), F.lit(" "), F.lit("_"))))
     .write.mode("overwrite").partitionBy(part).parquet(path))


def read_class(spark: SparkSession, path: str, label: str, part: str = "class_part") -> DataFrame:
    """The rows of one class, by partition pruning."""
    return spark.read.parquet(path).filter(F.col(part) == class_folder(label)).drop(part)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run to a log, in place of what an earlier run of that name has left.

    The rows go to a folder of their own; only when all are there does a line of
    the manifest name it. A job that dies halfway changes nothing, and a
    repeated one replaces its own rows and no others.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    df.withColumn(RUN, F.lit(run)).write.parquet(os.path.join(path, "rows", folder))
    small_table(spark, [(run, folder, time.time_ns())], "run string, folder string, at long").write.mode("append").parquet(
        os.path.join(path, "manifest"))


def read_runs(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """The latest rows of every run (or of those named), with the run's name in ``run_id``."""
    manifest = spark.read.parquet(os.path.join(path, "manifest"))
    latest = manifest.groupBy("run").agg(F.max_by("folder", F.struct("at", "folder")).alias("folder"))
    # One line a run: as many folders are listed, not rows.
    named = [r["folder"] for r in latest.orderBy("run").collect() if runs is None or r["run"] in runs]
    if not named:
        raise ValueError(f"no run {runs} in {path}")
    return spark.read.option("mergeSchema", True).parquet(*[os.path.join(path, "rows", f) for f in named])
