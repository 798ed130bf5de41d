"""Plan checks: no Python in any plan, no cartesian product, no whole-group windows in the operators."""

from __future__ import annotations

import pytest
from study_helpers import SF_SMALL, day

import __spark_entry__ as E
from visitline.operators import conflicts, flags, repair

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", list(E._study_queries()))
def test_no_python_and_no_pair_explosion(spark, name):
    plan = physical(E.queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PYTHON_NODES), name
    assert not any(n in plan for n in PAIR_NODES), name


def test_operators_use_aggregates_not_group_windows(spark, obs_of):
    """Group statistics are partial aggregates + joins; no Window operator sees a whole group."""
    obs = obs_of([(1, "a", day(0)), (1, "b", day(4)), (2, "a", day(4)), (2, "c", None)])
    v9 = repair.forms_per_date(repair.one_date_per_form_visit(obs))
    v13 = repair.drop_collided_forms(repair.apply_corrections(v9, repair.visit_corrections(repair.inconsistent_visits(v9))))
    v14 = repair.snap_to_median(v13)
    summary = conflicts.conflict_summary(conflicts.conflict_rows(v14))
    frames = [
        v14,
        conflicts.conflict_shared_forms(summary),
        conflicts.resolve_conflicts(summary),
        flags.visit_dates_flagged(obs),
        flags.visit_mode_summary(obs.withColumn("hpf", obs.crf)),
    ]
    for df in frames:
        assert "Window" not in logical(df)


def test_inconsistent_visits_does_not_pair_forms_with_forms(spark, obs_of):
    """The self join meets one summary row per visit and date, never all form pairs."""
    obs = obs_of([(1, f"f{i}", day(0)) for i in range(30)] + [(2, f"g{i}", day(0)) for i in range(30)])
    v9 = repair.forms_per_date(repair.one_date_per_form_visit(obs))
    inc = repair.inconsistent_visits(v9)
    # 60 rows x 1 other visit each: 60 rows out, not 30 x 30 x 2 pairs.
    assert inc.count() == 60


def test_skewed_subject_is_aggregated_map_side(spark, obs_of):
    """A subject holding almost every row: its statistics are partial aggregates, no window."""
    from visitline.plans import pipelines

    rows = [(v, f"f{f}", day(v * 40 + (f % 3))) for v in range(20) for f in range(12)]
    obs = obs_of(rows).unionByName(obs_of([(1, "a", day(1))], sjid=2))
    v14 = pipelines.repair_stage(obs, "snap_to_median")
    v14.write.format("noop").mode("overwrite").save()
    plan = physical(v14)
    assert "partial_" in plan  # map-side combine before the shuffle
    assert "Window" not in plan
    assert v14.count() == len(rows) + 1


def test_scale_conf_sizes_partitions_from_input():
    from visitline.session import scale_conf

    assert scale_conf(10 * 1024**2)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 * 1024**4)["spark.sql.shuffle.partitions"] == "409600"
    assert scale_conf(1024**4)["spark.sql.shuffle.partitions"] == "4096"


def static_plan(spark, df_of) -> str:
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return physical(df_of())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_inconsistent_visits_exchange_count(spark, obs_of):
    """Static plan of C10 on stored visit entries, as in the pipeline: one exchange for each side of the join."""
    import re

    from visitline.session import cut_lineage

    obs = obs_of([(1, "a", day(0)), (1, "b", day(0)), (2, "c", day(0)), (2, "a", day(9))])
    stored = cut_lineage(repair.visit_forms(repair.one_date_per_form_visit(obs)))
    plan = static_plan(spark, lambda: repair.inconsistent_entries(stored))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2, plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_hot_subject_join_is_split_by_aqe(spark):
    """With skew thresholds scaled down to test size, AQE splits the hot subject's join partition."""
    import datetime as dt

    from pyspark.sql import functions as F

    from visitline.operators import ages

    n = 60000
    obs = spark.range(n).select(
        F.lit("S").alias("study"),
        F.when(F.col("id") < n * 0.9, F.lit(1)).otherwise(2 + F.col("id") % 200).cast("bigint").alias("sjid"),
        F.lit("V").alias("avisit"),
        (F.col("id") % 50).cast("double").alias("avisitn"),
        F.lit("a").alias("crf"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 400).cast("int")).alias("adt"),
    )
    subj = spark.range(202).select(F.lit("S").alias("study"), F.col("id").alias("sjid"), F.lit(30.0).alias("start_age"))
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # Splitting works on map outputs; keep several mappers upstream, as at scale.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from visitline.operators import conflicts

        # C21 works on distinct visit dates: every row gets its own date so the hot subject stays hot.
        clean = spark.range(n).select(
            F.lit("S").alias("study"),
            F.when(F.col("id") < n * 0.9, F.lit(1)).otherwise(2 + F.col("id") % 200).cast("bigint").alias("sjid"),
            (F.lit(18262.0) + F.col("id")).alias("adt_day"),
            F.lit(1.0).alias("avisitn"),
            F.lit("a").alias("crf"),
        )
        checks = [
            (ages.with_age_at_visit(obs, subj), n),
            (ages.subjects_with_age(obs, subj), n),
            (conflicts.visit_dates_with_age(clean, subj), clean.select("study", "sjid", "adt_day", "avisitn").distinct().count()),
        ]
        for df, rows in checks:
            assert len(df.collect()) == rows
            plan = physical(df)
            assert "SortMergeJoin(skew=true)" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
