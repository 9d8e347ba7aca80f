"""Tables, views and exports."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Stored input per bucket: a task for less costs more than its rows.
BUCKET_BYTES = 2 << 20


def fitting_buckets(spark: SparkSession, paths: list[str]) -> int:
    """Buckets for tables made of the given files: one per `BUCKET_BYTES`, two per core at least, and not more than shuffle partitions."""
    folders = [spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths]
    stored = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in folders)
    wanted = max(math.ceil(stored / BUCKET_BYTES), 2 * spark.sparkContext.defaultParallelism)
    return min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_table(
    frame: DataFrame,
    name: str,
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int | None = None,
    aligned: bool = False,
) -> DataFrame:
    """Create or replace a Parquet table and return it.

    The rows are written to a table of their own first. Only when all of them are
    there does the name pass to it, so a write that fails leaves the table as it was,
    and the frame may read from the table that it replaces. Below ``path`` every
    version has its own folder; the one that is replaced is deleted.

    With ``bucket_by`` the rows are laid out by the hash of that key, one file per
    bucket: later joins and groupings on the key then need no shuffle. All tables
    joined on a key must use one bucket count. ``aligned`` says that the frame comes
    from tables with this layout and needs no shuffle either; it is then read
    bucket by bucket, even where Spark would rather split the files.
    """
    spark = frame.sparkSession
    if bucket_by is not None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not aligned:
            frame = frame.repartition(buckets, bucket_by)
    writer = frame.write.mode("errorifexists").format("parquet")
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by)
    version = uuid.uuid4().hex
    staged, folder = f"{name}_{version}", None
    if path is not None:
        folder = f"{path.rstrip('/')}/{version}"
        writer = writer.option("path", folder)
    try:
        with _whole_buckets(spark, aligned):
            writer.saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        if folder is not None:
            _delete(spark, folder)
        raise
    _pass_name(spark, staged, name, folder)
    return spark.table(name)


def _pass_name(spark: SparkSession, staged: str, name: str, folder: str | None) -> None:
    """Let `name` stand for the staged table."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        return
    old, new = _layout(spark, name), _layout(spark, staged)
    if folder is not None and old[:-1] == new[:-1]:
        # One entry of the catalog changes; there is no moment without the table.
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {staged}")
        spark.catalog.refreshTable(name)
        _delete(spark, old[-1])
        return
    # Another schema or layout, or a table without a path: the old one stays under another name until the new one has its place.
    before = f"{name}_{uuid.uuid4().hex}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE {before}")
    if old[1] == "EXTERNAL":
        _delete(spark, old[-1])


def _layout(spark: SparkSession, name: str) -> tuple:
    """Schema, kind, buckets and location of a table."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    schema = spark.table(name).schema.simpleString()
    return (schema, *(told.get(k) for k in ("Type", "Num Buckets", "Bucket Columns", "Location")))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _whole_buckets(spark: SparkSession, wanted: bool) -> Iterator[None]:
    """Read bucketed tables one bucket per task for as long as this lasts."""
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    if wanted:
        spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def register_view(frame: DataFrame, name: str) -> DataFrame:
    """Name a lazy view, replacing one of the same name."""
    frame.createOrReplaceTempView(name)
    return frame.sparkSession.table(name)


def export_parquet(frame: DataFrame, path: str, codec: str = "zstd") -> str:
    """Write a table, view or query result as compressed Parquet files."""
    frame.write.mode("overwrite").option("compression", codec).parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
