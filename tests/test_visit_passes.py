"""How often the repair and conflict steps shuffle and collect the visits, and that their results stay whole."""

from __future__ import annotations

import random
import re

from study_helpers import SF_SMALL, day
from test_plans import physical, static_plan

from visitline.functions import first_by, join_on_keys, sort_keys
from visitline.operators import ages, conflicts, repair
from visitline.plans import pipelines
from visitline.session import cut_lineage
from visitline.sources import fixtures

SNAPPED = "study string, sjid bigint, avisitn double, adt_day double, crf string"


def planned_by_size(spark, build) -> str:
    """The plan before it runs, small tables broadcast as their stored size allows."""
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return physical(build())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)


def test_snap_shuffles_the_rows_once(spark, obs_of):
    c9 = repair.forms_per_date(repair.one_date_per_form_visit(obs_of([(1, "a", day(0)), (1, "b", day(4)), (2, "a", day(90))])))
    rows = cut_lineage(repair.drop_collided_forms(repair.apply_corrections(c9, repair.visit_corrections(repair.inconsistent_visits(c9)))))
    plan = static_plan(spark, lambda: repair.snap_to_median(rows))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan, plan


def test_counts_collect_nothing(spark):
    rows = spark.createDataFrame([("S", 1, 1.0, 0.0, "a"), ("S", 1, 1.0, 0.0, "a"), ("S", 1, 1.0, 0.0, None), ("S", 1, None, None, "b")], SNAPPED)
    counts = conflicts.visit_counts(rows)
    assert "collect_" not in physical(counts)
    assert counts.first().asDict() == {"total_rows": 4, "unique_subjects": 1, "unique_visits": 2, "unique_dates": 2, "unique_crf_records": 3}


def test_corrections_sort_no_entry_of_a_date_that_one_visit_has(spark):
    """Dates are told by a count, which is hashed; texts are compared only for dates that several visits claim."""
    entries = cut_lineage(
        repair.visit_forms(spark.createDataFrame([("S", 1, float(v), "x", day(v)) for v in range(20)], "study string, sjid bigint, avisitn double, crf string, adt date"))
    )
    seen = []
    assert repair.correction_pairs(entries, lambda df: seen.append(df) or df).count() == 0
    assert seen[0].count() == 0


def test_clean_table_keeps_rows_without_a_form_name(spark):
    rows = [("S", 1, 1.0, 0.0, "a"), ("S", 1, 1.0, 0.0, None), ("S", 1, 2.0, 50.0, None), ("S", 2, 1.0, 0.0, "a"), ("S", 2, 1.0, 90.0, "b"), ("S", 2, 1.0, 90.0, "c")]
    visits = spark.createDataFrame(rows + rows[:2], SNAPPED)
    entries = conflicts.visit_entries(visits)
    summary = conflicts.conflict_entries(entries)
    resolved = conflicts.resolve_conflicts(summary)
    want = {("S", 1, 1.0, 0.0, "a"), ("S", 1, 1.0, 0.0, None), ("S", 1, 2.0, 50.0, None), ("S", 2, 1.0, 90.0, None)}
    for clean in (conflicts.clean_visits(visits, summary, resolved), conflicts.clean_visits(visits, summary, resolved, entries)):
        got = [tuple(r) for r in clean.select("study", "sjid", "avisitn", "adt_day", "crf").collect()]
        assert len(got) == 4 and set(got) == want


def test_sorts_compare_numbers_before_texts(spark):
    df = spark.createDataFrame([], "study string, sjid bigint, adt date, crf string, avisitn double")
    assert sort_keys(df, ("study", "sjid", "avisitn", "crf", "adt")) == ["sjid", "avisitn", "adt", "study", "crf"]
    plan = static_plan(spark, lambda: repair.one_date_per_form_visit(df))
    assert re.search(r"hashpartitioning\(sjid#\d+L, avisitn#\d+, study#\d+, crf#\d+", plan), plan


def test_first_row_takes_named_order_nulls_last_and_carries_it_once(spark):
    df = spark.createDataFrame([("S", 1, None, "x"), ("S", 1, 2.0, "z"), ("S", 1, 2.0, "y"), ("T", 1, None, "w")], "study string, sjid bigint, v double, p string")
    best = first_by(df, ("study", "sjid"), ["v"], ["v", "p"])
    assert sorted(map(tuple, best.select("study", "sjid", "v", "p").collect())) == [("S", 1, 2.0, "y"), ("T", 1, None, "w")]
    assert best.columns == ["study", "sjid", "v", "p"] and "__o0" not in best.columns


def test_rows_are_not_shuffled_again_between_the_ages_and_the_visit_entries(spark):
    plan = static_plan(spark, lambda: repair.visit_forms(repair.one_date_per_form_visit(pipelines.repair_input(spark, SF_SMALL))))
    above, semi, _ = plan.partition("LeftSemi")
    assert semi and "Exchange" not in above and "ShuffledHashJoin" in above, plan


def test_subjects_without_an_age_may_go_before_the_copies(spark):
    schema = "study string, sjid bigint, avisit string, avisitn double, crf string, adt date, hpf string, qty double, status string"
    rows = [
        (study, sjid, f"Visit {v}" if v != 3 else "PRN", float(v) if v else None, "a", day(v * 7 % 5) if v % 4 else None, "h", float(v % 2), "s")
        for study in ("S", "T", None) for sjid in (1, 2, None) for v in range(6)
    ]
    forms = spark.createDataFrame(rows + rows[:9], schema)
    known = spark.createDataFrame([("S", 1, 30.0), ("T", 2, 40.0), ("T", None, 50.0)], "study string, sjid bigint, start_age double")
    before = pipelines.stack_for_repair(ages.subjects_with_age(forms, known.hint("shuffle_hash")))
    after = ages.subjects_with_age(pipelines.stack_for_repair(forms), known)
    got = sorted(map(str, before.collect()))
    assert got and got == sorted(map(str, after.collect())) and before.columns == after.columns


def test_one_shuffle_from_the_corrections_to_the_visit_entries(spark, obs_of):
    """Stored corrections are small: the form rows meet them without a shuffle, then C13, C14 and the entries share one."""
    obs = obs_of([(1, c, day(0)) for c in "abc"] + [(2, "x", day(0)), (3, "y", day(40)), (3, "z", day(90)), (4, "y", None)])
    visits = pipelines.repair_stage(obs, "snap_to_median")
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical(conflicts.visit_entries(visits).select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "SortMergeJoin" not in plan, plan
    found = {(r.avisitn, r.adt_day and int(r.adt_day), tuple(r.distinct_crfs)) for r in conflicts.visit_entries(visits).collect()}
    first = (day(0) - day(0).__class__(1970, 1, 1)).days
    assert found == {(1.0, first, ("a", "b", "c", "x")), (3.0, first + 40, ("y",)), (3.0, first + 90, ("z",)), (4.0, None, ("y",))}


def test_dates_of_several_visits_are_stored_before_the_entries_meet_them(spark):
    rows = [("S", 1, 1.0, 0.0, "a"), ("S", 1, 2.0, 0.0, "b"), ("S", 1, 2.0, 50.0, "b"), ("S", 2, 1.0, None, "a"), ("S", 2, None, None, "a")]
    entries = cut_lineage(conflicts.visit_entries(spark.createDataFrame(rows, SNAPPED)))
    kept = []
    stored = conflicts.conflict_entries(entries, lambda df: kept.append(df) or cut_lineage(df))
    assert [sorted(map(str, df.collect())) for df in kept] == [sorted(map(str, kept[0].collect()))] and kept[0].count() == 2
    assert sorted(map(str, stored.collect())) == sorted(map(str, conflicts.conflict_entries(entries).collect()))


def test_repaired_entries_are_those_of_the_repaired_rows(spark):
    """Visits that are moved, left, emptied, snapped, spread or undated, and rows without subject, visit number or form name."""
    obs = [("S", 1, "V", 1.0, c, day(0)) for c in "abc"] + [("S", 1, "V", 2.0, c, day(d)) for c, d in (("x", 0), ("a", 3), ("b", 0))]
    obs += [("S", 1, "V", 3.0, "y", day(40)), ("S", 1, "V", 3.0, "z", day(90)), ("S", 1, "V", 4.0, "y", None), ("S", 1, "V", 4.0, "z", day(9))]
    obs += [("S", 2, "V", 1.0, "a", day(0)), ("S", 2, "V", 2.0, "b", day(0)), ("S", 2, "V", 3.0, "c", day(0)), ("S", 2, "V", 3.0, "a", day(0))]
    obs += [("S", 3, "V", v, c, d) for v in (None, 1.0) for c in (None, "a") for d in (None, day(1), day(80))]
    obs += [(study, sjid, "V", v, c, day(int(v or 7) * 50)) for study, sjid in ((None, 4), ("S", None)) for v in (None, 1.0, 2.0) for c in ("a", None)]
    obs += [(None, 4, "V", 1.0, "q", day(300)), (None, 4, "V", 2.0, "q", day(300)), ("T", 1, "V", 1.0, "a", day(0)), ("T", 1, "V", 5.0, "d", day(4))]
    stacked = spark.createDataFrame(obs, "study string, sjid bigint, avisit string, avisitn double, crf string, adt date")
    visits = pipelines.repair_stage(stacked, "snap_to_median")
    assert visits.where("avisitn_original is not null").count() > 1
    by_visit = cut_lineage(pipelines.repaired_entries(stacked))
    want = sorted(map(str, conflicts.visit_entries(visits).collect()))
    assert want == sorted(map(str, by_visit.drop("n_dates").collect()))
    for name in ("conflict_rows", "conflict_summary", "conflict_shared_forms", "resolve_conflicts", "clean_visits", "visit_dates_with_age"):
        known = spark.createDataFrame([("S", 1, 30.0), ("S", 3, 40.0)], "study string, sjid bigint, start_age double")
        by_rows = pipelines.conflict_stage(visits, known, name)
        got = pipelines.conflict_stage(None, known, name, entries=by_visit)
        assert got.columns == by_rows.columns and sorted(map(str, got.collect())) == sorted(map(str, by_rows.collect())), name


def test_rows_of_visits_without_a_correction_are_not_shuffled_after_they_are_collected(spark, obs_of):
    """From the stored visits to the entries: only the corrected visits' rows are shuffled, and the entries are not collected again."""
    obs = obs_of([(1, c, day(0)) for c in "abc"] + [(2, "x", day(0)), (3, "y", day(40)), (3, "z", day(90)), (4, "y", None)])
    plan = planned_by_size(spark, lambda: pipelines.repaired_entries(obs))
    assert "collect_set" not in plan and "SortMergeJoin" not in plan, plan
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Union" in line)
    second = next(i for i in range(at + 2, len(lines)) if lines[i].startswith(lines[at + 1].split(":-")[0] + "+-"))
    rest = "\n".join(lines[at:second])
    assert "LeftAnti" in rest and "Exchange hashpartitioning" not in rest and "ObjectHashAggregate" not in rest, plan


def test_conflicts_of_counted_entries_shuffle_no_entry(spark, obs_of):
    entries = cut_lineage(pipelines.repaired_entries(obs_of([(1, "a", day(0)), (1, "b", day(90)), (2, "c", day(90)), (3, "d", day(200))])))
    claimed = cut_lineage(conflicts.several_visits(entries))
    summary = cut_lineage(conflicts.conflict_entries(entries, claimed=claimed))
    for found in (conflicts.conflict_entries(entries, claimed=claimed), conflicts.untouched_entries(entries, summary, claimed)):
        plan = planned_by_size(spark, lambda found=found: found)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan, plan


def test_repair_input_carries_no_visit_label(spark):
    plan = static_plan(spark, lambda: repair.one_date_per_form_visit(pipelines.repair_input(spark, SF_SMALL)))
    # The label is made from the order for the as-needed filter only: neither C3 nor a shuffle of the form rows reads it.
    assert not re.search(r"(Exchange hashpartitioning|SortAggregate).*avisit#", plan), plan


def test_orders_meet_their_customers_on_the_days(spark):
    """Orders are shuffled for their day and for their key; customers, also repeated ones, join the customer's days."""
    orders = spark.createDataFrame(
        [(k, c, day(d) if d is not None else None) for k, (c, d) in enumerate([(1, 0), (1, 0), (1, 5), (2, 1), (None, 1), (3, 2), (1, None)])],
        "o_orderkey bigint, o_custkey bigint, o_orderdate date",
    )
    customers = spark.createDataFrame([(1, "S"), (2, "T"), (2, "T"), (None, "U"), (9, "S")], "c_custkey bigint, study string")
    got = sorted((r.o_orderkey, r.o_custkey, r.vn, r.study) for r in fixtures.visit_numbers(orders, customers).collect())
    numbered = fixtures.visit_numbers(orders)
    want = numbered.join(customers, numbered.o_custkey == customers.c_custkey)
    assert got == sorted((r.o_orderkey, r.o_custkey, r.vn, r.study) for r in want.collect()) and len(got) == 5


def test_corrections_from_visits_read_no_form_to_find_the_dates(spark):
    """The dates that several visits claim come from dates alone; forms are collected for these dates only, with the same corrections."""
    rng = random.Random(4)
    rows = {(rng.choice("ST"), rng.randint(1, 25), rng.choice([None, -1.0, 1.0, 2.0, 3.0]), rng.choice([None, "a", "b", "c", "d"])): rng.choice([None, day(0), day(1), day(rng.randint(2, 60))]) for _ in range(400)}
    # One study's only other visit on the date has no form name; the other study has the same subject, date and a larger form count there.
    rows |= {("S", 90, 1.0, "a"): day(0), ("S", 90, 1.0, "b"): day(0), ("S", 90, 1.0, "c"): day(0), ("S", 90, 2.0, None): day(0)}
    rows |= {("T", 90, 1.0, "a"): day(0), ("T", 90, 1.0, "b"): day(0), ("T", 90, 2.0, "c"): day(0)}
    c8 = spark.createDataFrame([(*key, d) for key, d in rows.items()], "study string, sjid bigint, avisitn double, crf string, adt date")
    visits = cut_lineage(repair.visit_rows(c8))
    seen = []
    got = repair.fewest_corrections(repair.visit_correction_pairs(visits, lambda df: seen.append(df) or cut_lineage(df)))
    want = repair.fewest_corrections(repair.correction_pairs(repair.visit_forms(c8)))
    assert want.count() and sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert {r.sjid for r in want.collect()} >= {90} and not want.where("study = 'S' and sjid = 90").count()
    plan = physical(seen[0])
    assert "crf" not in plan.split("ReadSchema")[1].split("\n")[0] and "lambda" not in plan, plan
    claimed = {(r.study, r.sjid, r.adt) for r in seen[0].collect()}
    assert 0 < len(claimed) and {(r.study, r.sjid, r.adt) for r in seen[1].collect()} <= claimed


def test_clean_dates_shuffle_no_untouched_entry(spark):
    """Only winners can repeat: an entry that wins both kinds of conflict is one visit date, and the others are not made distinct."""
    rows = [("S", 1, 1.0, 0.0, c) for c in "abc"] + [("S", 1, 1.0, 90.0, "a"), ("S", 1, 2.0, 0.0, "b"), ("S", 1, 3.0, 200.0, "a"), ("S", 2, None, None, "a")]
    rows += [("S", None, 1.0, 5.0, "a"), ("S", None, 2.0, 5.0, "a")]
    entries = conflicts.visit_entries(spark.createDataFrame(rows, SNAPPED))
    visit = ("study", "sjid", "avisitn")
    dates = entries.groupBy(*visit).count().withColumnRenamed("count", "n_dates")
    entries = cut_lineage(join_on_keys(entries, dates, visit, ("sjid", "avisitn")))
    claimed = cut_lineage(conflicts.several_visits(entries))
    summary = cut_lineage(conflicts.conflict_entries(entries, claimed=claimed))
    resolved = cut_lineage(conflicts.resolve_conflicts(summary))
    assert resolved.count() == 2
    got = conflicts.clean_dates(entries, summary, resolved, claimed)
    want = conflicts.clean_entries(entries, summary, resolved, claimed)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).distinct().collect())) and got.count() == 5
    plan = planned_by_size(spark, lambda: conflicts.clean_dates(entries, summary, resolved, claimed))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    known = spark.createDataFrame([("S", 1, 30.0)], "study string, sjid bigint, start_age double")
    ages_of = [conflicts.dates_with_age(got, known), conflicts.visit_dates_with_age(want, known)]
    assert sorted(map(str, ages_of[0].collect())) == sorted(map(str, ages_of[1].collect()))
