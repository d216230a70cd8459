"""Writers, and what can be said about the files they wrote."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.operators.columns import quoted
from millrace.sources.probe import as_literal_path, list_files


@dataclass(frozen=True)
class Receipt:
    """What was written where; ``schema`` reads it back with its types, partition values included."""

    path: str
    rows: int
    schema: T.StructType


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("source",),
    mode: str = "overwrite",
    replace: str = "static",
    rebalance: bool = False,
) -> Receipt:
    """Write partitioned Parquet and count the rows in the same pass.

    ``replace="static"`` puts the new data in place of the whole dataset, ``"dynamic"`` in place of
    the partitions it holds. ``rebalance`` evens out file sizes: adaptive execution then gathers
    each partition value in few files and splits a value that is too large for one task. It costs
    a shuffle, so it is for tables that arrive in many small pieces.
    """
    if rebalance:
        df = df.hint("rebalance", *[quoted(c) for c in partition_by])
    counted = Observation()
    writer = (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("partitionOverwriteMode", replace)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return Receipt(path, counted.get["rows"], df.schema)


def read_back(spark: SparkSession, receipt: Receipt) -> DataFrame:
    """The dataset a receipt speaks of. The stated schema keeps partition values from being guessed."""
    return spark.read.schema(receipt.schema).parquet(receipt.path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", sep: str = ",") -> str:
    """Write delimited files with a header, quotes doubled, blanks kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def list_objects(
    spark: SparkSession, path: str, prefix: str = "", glob: str | None = None, first: int | None = None
) -> DataFrame:
    """``(path, length, modificationTime, key)`` of the files of any kind below a path whose key, the
    part after the path, starts with a prefix.

    Only the folders that the prefix names are listed. ``glob`` picks names, ``first`` the first keys
    in order. Files that Spark takes for hidden (a name that begins with ``_`` or ``.``) are none. A
    path that does not exist holds none.
    """
    folder = prefix.rpartition("/")[0]
    try:
        files = list_files(spark, f"{path.rstrip('/')}/{as_literal_path(folder)}" if folder else path, glob)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp, key string")
    base = path.rstrip("/").split("://", 1)[-1].removeprefix("file:") + "/"
    keyed = files.withColumn("key", F.element_at(F.split("path", _literal(base), 2), -1))
    keyed = keyed.where(F.col("key").startswith(prefix))
    return keyed if first is None else keyed.orderBy("key").limit(first)


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def inventory(dataset: DataFrame, partition_by: Sequence[str] = ("source",)) -> DataFrame:
    """Files and rows per partition of a Parquet dataset; no data column is read.

    Rows are counted per file first, so counting the files is a count of few rows.
    """
    parts = [quoted(c).alias(c) for c in partition_by]
    per_file = dataset.groupBy(*parts, F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    return per_file.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("_n").alias("n_rows")
    )


def require_output(spark: SparkSession, path: str, prefix: str = "") -> None:
    """Fail when the path holds no data file."""
    if list_objects(spark, path, prefix, "*.parquet").isEmpty():
        raise ValueError(f"no Parquet file below {path}/{prefix}")


def publish(spark: SparkSession, receipt: Receipt, path: str, replace: str = "static", partition_by: Sequence[str] = ("source",)) -> Receipt:
    """Move a checked dataset's files to where readers look, in place of what is there.

    Files are renamed by the storage's own client, so data is not written again where it can rename. What was
    there goes aside first and is deleted last; if a rename fails it comes back. ``replace="dynamic"`` puts
    aside only the partitions that the new dataset holds. Readers meet the old dataset or the new one, or
    for the moment between two renames none.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    new, old = hadoop.Path(receipt.path), hadoop.Path(path)
    fs = old.getFileSystem(conf)
    aside = hadoop.Path(old.getParent(), f".{old.getName()}-before-{uuid.uuid4().hex}")
    names = [None]
    if replace == "dynamic" and partition_by and fs.exists(old):
        parts = fs.listStatus(new)
        names = sorted(p.getPath().getName() for p in parts if p.isDirectory())
    moved: list[tuple] = []

    def move(a, b) -> None:
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise OSError(f"could not rename {a} to {b}")
        moved.append((a, b))

    try:
        for name in names:
            there = old if name is None else hadoop.Path(old, name)
            if fs.exists(there):
                move(there, aside if name is None else hadoop.Path(aside, name))
            move(new if name is None else hadoop.Path(new, name), there)
    except Exception:
        for a, b in reversed(moved):
            fs.rename(b, a)
        raise
    fs.delete(aside, True)
    fs.delete(new, True)
    spark.catalog.refreshByPath(path)
    return Receipt(path, receipt.rows, receipt.schema)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a dataset that did not pass its check."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
