"""Writers for normalised forms, visit tables and flag tables.

The scripts save a binary copy plus a tab-delimited text copy of each form,
and write result tables, sorted, with a run-date suffix. Here the binary copy is
Parquet, the text copy is header + tab CSV, and the run date becomes a
``run_date=`` directory so that every run is kept and readable as one
partitioned table.

Dated tables are published whole: they are written beside their place, under a
name that Spark's readers skip, and renamed when every file and the file manifest
are there. A run that dies while writing leaves the table of an earlier run of that date
as it was; one that dies between the two renames of a replacement leaves the earlier
table under its side name, from where the next write or ``read_dated`` puts it back.
Renames are atomic on HDFS and local file systems.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitline.sources.forms import FORM_RELABEL, normalise_columns

#: Beside a table's files: one row per file, in order, with its rows and the first and last key.
FILES = "_files"
_STAGED, _REPLACED = ".staged-", ".replaced-"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-delimited text with a header line (the ``txt`` copy)."""
    df.write.mode(mode).option("sep", "\t").option("header", "true").csv(path)


def stored_form_name(name: str) -> str:
    """File name a form is stored under.

    Spark's file sources treat names starting with ``_`` or ``.`` as hidden
    and never read them, so such forms are stored under their study name
    (``_9hpt`` becomes ``nhpt``, as the study scripts call it).
    """
    stored = FORM_RELABEL.get(name, name)
    if stored.startswith(("_", ".")):
        raise ValueError(f"form name {name!r} would be hidden from Spark; add it to FORM_RELABEL")
    return stored


def write_normalised(df: DataFrame, base: str, name: str) -> str:
    """Both copies of one normalised form (lower-case columns): ``{base}/{name}.parquet`` and ``.txt``."""
    stored = stored_form_name(name)
    df = normalise_columns(df)
    write_parquet(df, f"{base}/{stored}.parquet")
    write_text(df, f"{base}/{stored}.txt")
    return stored


# -- publishing


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path, hadoop_path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    make, fs = _fs(spark, path)
    return fs.exists(make(path))


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement of ``path`` that was cut short: the earlier table comes back if no new one took its place."""
    parent, name = _split(path)
    make, fs = _fs(spark, path)
    if not fs.exists(make(parent)):
        return
    for found in fs.listStatus(make(parent)):
        old = found.getPath()
        if old.getName().startswith(f"{_REPLACED}{name}."):
            if fs.exists(make(path)):
                fs.delete(old, True)
            else:
                fs.rename(old, make(path))


def publish(write: Callable[[str], None], spark: SparkSession, path: str) -> str:
    """Let ``write`` fill a staging folder beside ``path``, then put it in the place of ``path``; returns ``path``."""
    parent, name = _split(path)
    run = uuid.uuid4().hex
    staged = f"{parent}/{_STAGED}{name}.{run}"
    make, fs = _fs(spark, path)
    recover(spark, path)
    try:
        write(staged)
        replaced = make(f"{parent}/{_REPLACED}{name}.{run}")
        if fs.exists(make(path)) and not fs.rename(make(path), replaced):
            raise RuntimeError(f"{path} could not be replaced")
        if not fs.rename(make(staged), make(path)):
            recover(spark, path)
            raise RuntimeError(f"{staged} could not be renamed to {path}")
        fs.delete(replaced, True)
    finally:
        fs.delete(make(staged), True)
    return path


def _keys(order: Sequence[str]) -> Column:
    """A struct that compares as ``order`` sorts: ascending, missing last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c).alias(c))])


def _write_files(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """The list of a written table's files: name, rows, first and last key."""
    keys = _keys(order) if order else F.struct(F.lit(None).cast("string").alias("none"))
    files = (
        df.sparkSession.read.schema(df.schema)
        .parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(keys).alias("first"), F.max(keys).alias("last"))
    )
    # One row per file: small beside the table.
    files.coalesce(1).sortWithinPartitions("file").write.parquet(f"{path}/{FILES}")


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` sorted over all its output files (missing last): dealt by range of ``order``, then sorted in each.

    The other columns follow as tie breakers, so rows that share the leading keys (a subject
    with most of the rows, or one visit of it) are dealt to several ranges.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in order and not kinds[c].startswith(("map", "variant"))]
    by = [F.asc_nulls_last(c) for c in (*order, *rest)]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def dated_path(base: str, run_date: _dt.date | None = None) -> str:
    return f"{base.rstrip('/')}/run_date={(run_date or _dt.date.today()).isoformat()}"


def write_dated(
    df: DataFrame,
    base: str,
    run_date: _dt.date | None = None,
    partition_by: tuple[str, ...] = (),
    order: Sequence[str] = (),
) -> str:
    """Publish a result table under ``{base}/run_date=YYYY-MM-DD``; returns the path.

    ``partition_by`` (for example ``("study",)``) lays the table out by study so
    readers of one study prune the rest. ``order`` sorts the whole table (missing last): files follow each other in
    name order with ranges that don't overlap, and ``_files`` holds each file's rows and bounds.
    A date's earlier table is replaced when the new one is whole.
    """
    if order:
        df = in_order(df, (*partition_by, *order))

    def write(path: str) -> None:
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        if not partition_by:
            _write_files(df, path, order)

    return publish(write, df.sparkSession, dated_path(base, run_date))


def read_dated(spark: SparkSession, base: str, run_date: _dt.date) -> DataFrame:
    """The table of one run date (an interrupted replacement is finished or undone first)."""
    path = dated_path(base, run_date)
    recover(spark, path)
    return spark.read.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, rows, first, last`` of a published table."""
    return spark.read.parquet(f"{path}/{FILES}")


def read_in_order(spark: SparkSession, path: str, place: str = "place") -> DataFrame:
    """A published sorted table with each row's 0-based place in the whole order.

    The place is the row's index in its file plus the rows of the files before (from the file list, one number per file).
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = read_files(spark, path).select(F.col("file").alias("__file"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__start"))
    df = spark.read.parquet(path)
    rows = df.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    return rows.join(starts, "__file").select(*df.columns, (F.col("__start") + F.col("__index")).alias(place))
