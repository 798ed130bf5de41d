"""Dated tables: published whole, replaced only when whole, sorted over all files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from visitline.sources import sinks

DATE = dt.date(2026, 1, 2)


def rows(spark, n=2000):
    """Two thirds of the rows belong to one subject, half of them to one visit of it."""
    return spark.range(n).select(
        F.lit("S").alias("study"),
        F.when(F.col("id") % 3 < 2, F.lit(5)).otherwise(F.col("id") % 40).cast("bigint").alias("sjid"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 6 < 2, F.lit(1.0)).otherwise((F.col("id") % 11).cast("double")).alias("avisitn"),
        F.col("id").alias("value"),
    )


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_a_failing_run_leaves_the_table_of_an_earlier_one(spark, tmp_path):
    base = str(tmp_path / "visit.dates")
    path = sinks.write_dated(rows(spark), base, DATE, order=("sjid", "avisitn"))
    bad = rows(spark).withColumn("value", F.when(F.col("value") == 1999, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_dated(bad, base, DATE)
    assert spark.read.parquet(path).count() == 2000 and names(tmp_path / "visit.dates") == ["run_date=2026-01-02"]
    sinks.write_dated(rows(spark, 10), base, DATE, order=("sjid",))
    assert sinks.read_dated(spark, base, DATE).count() == 10 and names(tmp_path / "visit.dates") == ["run_date=2026-01-02"]


def test_a_run_killed_between_the_renames_is_undone_or_finished(spark, tmp_path):
    base = tmp_path / "visit.dates"
    path = sinks.write_dated(rows(spark, 10), str(base), DATE)
    staged, replaced = base / ".staged-run_date=2026-01-02.x", base / ".replaced-run_date=2026-01-02.x"
    # Killed after the earlier table was set aside: it comes back, and a half-written new one is never read.
    (base / "run_date=2026-01-02").rename(replaced)
    staged.mkdir()
    assert sinks.read_dated(spark, str(base), DATE).count() == 10 and not replaced.exists()
    assert spark.read.parquet(str(base)).count() == 10  # what is staged has a hidden name
    # Killed before the earlier table was deleted: the new one stays.
    replaced.mkdir()
    (replaced / "old").write_text("x")
    assert sinks.read_dated(spark, str(base), DATE).count() == 10 and not replaced.exists()
    assert path.endswith("run_date=2026-01-02")


def test_sorted_tables_have_disjoint_files_in_order(spark, tmp_path):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = sinks.write_dated(rows(spark), str(tmp_path / "t"), DATE, order=("sjid", "avisitn"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = sorted(sinks.read_files(spark, path).collect(), key=lambda r: r.file)
    assert len(files) == 6 and sum(r.rows for r in files) == 2000
    assert max(r.rows for r in files) < 800  # the subject with two thirds of the rows is split
    assert all(tuple(a["last"]) <= tuple(b["first"]) for a, b in zip(files, files[1:], strict=False) if None not in (*a["last"], *b["first"]))
    got = sinks.read_in_order(spark, path).orderBy("place").collect()
    assert [r.place for r in got] == list(range(2000))
    key = lambda r: (r.sjid, r.avisitn is None, r.avisitn or 0, r.study, r.value)
    want = sorted(rows(spark).collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in want]


def test_empty_and_unsorted_tables(spark, tmp_path):
    path = sinks.write_dated(rows(spark, 0), str(tmp_path / "t"), DATE, order=("sjid",))
    assert sinks.read_in_order(spark, path).collect() == [] and spark.read.parquet(path).columns == ["study", "sjid", "avisitn", "value"]
    path = sinks.write_dated(rows(spark, 5), str(tmp_path / "u"), DATE)
    assert sum(r.rows for r in sinks.read_files(spark, path).collect()) == 5
