"""Helpers shared by the operators: written tables, global order, connected components."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitline.session import checkpoint_dir, cut_lineage

__all__ = ["stored", "shared_path", "table", "only", "as_rows", "global_rank", "components", "is_empty", "hash_limit"]

#: Written to the session's shared checkpoint folder and read again.
stored = cut_lineage


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the session's shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/visitline-{label}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that extra columns can't clash with an operator's own."""
    return df.select(*[df[n] for n in names])


def as_rows(df: DataFrame) -> DataFrame:
    """``df`` as one struct column ``row``, so that helper columns can't clash with its own; ``select("row.*")`` undoes it."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))


def hash_limit(wanted: int, n: int) -> int:
    """The signed 64-bit hash up to which about ``wanted`` of ``n`` values lie (all, if there are fewer)."""
    return (1 << 63) - 1 if n <= wanted else (wanted << 64) // n - (1 << 63)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def global_rank(df: DataFrame, order: Iterable[Column], name: str = "rank") -> DataFrame:
    """``df`` with each row's 0-based place in the global order, without a single-task sort.

    Rows are range-partitioned and sorted per partition; a row's place is its place
    in the partition plus the number of rows in the partitions before (one number
    per partition). Rows equal in ``order`` get neighbouring places in any order.
    """
    order = list(order)
    sorted_df = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sorted_df = stored(sorted_df)
    counts = sorted_df.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return sorted_df.join(counts, "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges ``(a, b)``: rows ``(node, component)``.

    ``component`` is the smallest node of the component. Each round a node takes the
    smallest label among its neighbours' labels (a partial aggregate, so a hub's
    neighbours are reduced before the shuffle) and then its label's label, which
    doubles the distance covered. Labels are written each round: no growing lineage,
    and a lost executor recomputes from the files.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_near"))
        )
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("_old"), F.least("component", "_near").alias("_mid")
        )
        up = labels.select(F.col("node").alias("_mid"), F.col("component").alias("_up"))
        new = stored(
            step.join(up, "_mid", "left").select(
                "node", F.least("_mid", "_up").alias("component"), (F.least("_mid", "_up") != F.col("_old")).alias("_moved")
            )
        )
        labels = new.select("node", "component")
        if is_empty(new.where("_moved")):
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
