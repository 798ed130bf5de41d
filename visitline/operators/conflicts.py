"""Finding and resolving the conflicts left after repair.

Input is the repaired visit table (``snap_to_median`` output): dates are
``adt_day`` (days since 1970-01-01, possibly a half day) so that a snapped
half-day date stays distinct from its whole day, as in the study scripts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.functions import (
    day_to_date,
    first_by,
    join_on_keys,
    n_rows,
    own_shuffle,
    poisoned,
    r_number_text,
    several_rows,
    sort_keys,
)

# Conflict type labels.
SAME_DATE = "same adt, multiple avisitn"
SAME_VISIT = "same avisitn, multiple adt"

SUBJECT = ("study", "sjid")
SUBJECT_DATE = ("study", "sjid", "adt_day")
ENTRY = ("study", "sjid", "avisitn", "adt_day")
DAYS_PER_YEAR = 365.25


def visit_counts(visits: DataFrame) -> DataFrame:
    """Rows, subjects, visits, dates and form records (missing values count as values).

    Nested aggregates over coarser keys: form records first, then visit entries,
    then the visits and dates of each subject. All of them only count, so rows are
    aggregated map-side and never collected.
    """
    records = visits.groupBy(*ENTRY, "crf").agg(n_rows().alias("__rows"))
    entries = records.groupBy(*ENTRY).agg(F.sum("__rows").alias("__rows"), n_rows().alias("__records"))
    # Each entry counts once for its visit and once for its date; rows and records go with the visit.
    visit = F.struct(F.lit(True).alias("visit"), F.col("avisitn").alias("key"), "__rows", "__records")
    none = F.lit(0)
    date = F.struct(
        F.lit(False).alias("visit"),
        F.col("adt_day").alias("key"),
        none.cast("bigint").alias("__rows"),
        none.cast("bigint").alias("__records"),
    )
    keys = entries.select(*SUBJECT, F.inline(F.array(visit, date))).groupBy(*SUBJECT, "visit", "key").agg(
        F.sum("__rows").alias("__rows"), F.sum("__records").alias("__records")
    )
    subjects = keys.groupBy(*SUBJECT).agg(
        F.sum("__rows").alias("__rows"),
        F.sum("__records").alias("__records"),
        F.count_if("visit").alias("__visits"),
        F.count_if(~F.col("visit")).alias("__dates"),
    )
    total = {"__visits": "unique_visits", "__dates": "unique_dates", "__records": "unique_crf_records"}
    return subjects.agg(
        F.coalesce(F.sum("__rows"), none).cast("bigint").alias("total_rows"),
        n_rows().alias("unique_subjects"),
        *[F.coalesce(F.sum(c), none).cast("bigint").alias(name) for c, name in total.items()],
    )


def staged_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """The five counts before and after conflicts are resolved, with their ``stage``."""
    rows = [visit_counts(df).select(F.lit(stage).alias("stage"), "*") for stage, df in (("repaired", before), ("resolved", after))]
    return rows[0].unionByName(rows[1])


def visit_entries(visits: DataFrame) -> DataFrame:
    """One row per subject, visit number and date with its distinct forms (at most the catalogue), sorted; ``unnamed``: it has rows without a form name."""
    entries = visits.groupBy(*sort_keys(visits, ENTRY)).agg(
        F.array_sort(F.collect_set("crf")).alias("distinct_crfs"), (F.count("crf") < n_rows()).alias("unnamed")
    )
    return entries.select(*ENTRY, "distinct_crfs", "unnamed")


def entry_forms(entries: DataFrame) -> DataFrame:
    """The distinct form rows of ``visit_entries``; a missing form name is one of them."""
    unnamed = F.when(F.col("unnamed"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    return entries.select("study", "sjid", "adt_day", "avisitn", F.explode(F.concat("distinct_crfs", unnamed)).alias("crf"))


def several_visits(entries: DataFrame) -> DataFrame:
    """The dates of a subject that several visit numbers claim."""
    return several_rows(entries, SUBJECT_DATE)


def _has_several_dates() -> Column:
    """Whether an entry's visit has several dates, where its entries were counted (``n_dates``); a missing subject conflicts with nothing."""
    return (F.col("n_dates") > 1) & F.col("study").isNotNull() & F.col("sjid").isNotNull()


def conflict_entries(
    entries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df, claimed: DataFrame | None = None
) -> DataFrame:
    """Entries of a date claimed by several visit numbers, and of a visit with several dates.

    ``entries`` (``visit_entries``) hold each visit number and date of a subject
    once, so a conflict is a group of more than one entry. An entry can be in
    both types, once per type. It carries its form count and sorted form list.
    ``keep`` may store the dates claimed by several visits: they are few, and once their size is known the
    entries need not be shuffled for them. ``claimed`` are these dates, where they are stored already. Entries
    that know the ``n_dates`` of their visit are not counted again.
    """
    claimed = keep(several_visits(entries)) if claimed is None else claimed
    same_date = join_on_keys(entries, claimed, SUBJECT_DATE, ("adt_day",), how="left_semi")
    if "n_dates" in entries.columns:
        same_visit = entries.where(_has_several_dates())
    else:
        visit = ("study", "sjid", "avisitn")
        same_visit = join_on_keys(entries, several_rows(entries, visit), visit, ("avisitn",), how="left_semi")
    both = same_date.withColumn("conflict_type", F.lit(SAME_DATE)).unionByName(
        same_visit.withColumn("conflict_type", F.lit(SAME_VISIT))
    )
    return both.select(
        *ENTRY,
        "conflict_type",
        F.size("distinct_crfs").cast("bigint").alias("n_crf"),
        "distinct_crfs",
        day_to_date("adt_day").alias("adt"),
    )


def conflict_rows(
    visits: DataFrame | None, entries: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Rows of a date claimed by several visit numbers, and of a visit with several dates.

    A row can be in both, once per conflict type. Conflicts are found on visit
    entries and spread over their forms at the end.
    """
    found = conflict_entries(visit_entries(visits) if entries is None else entries, keep)
    return found.select(*ENTRY, F.explode_outer("distinct_crfs").alias("crf"), "conflict_type", "adt")


def conflict_summary(rows: DataFrame) -> DataFrame:
    """Per visit entry and conflict type: distinct forms and their sorted list (C17)."""
    return rows.groupBy(*ENTRY, "conflict_type").agg(
        F.count_distinct("crf").alias("n_crf"),
        F.array_sort(F.collect_set("crf")).alias("distinct_crfs"),
    ).withColumn("adt", day_to_date("adt_day"))


def conflict_key() -> Column:
    """The value a conflict is about, as text: the date, or the visit number.

    A half-day date prints as its whole day, so it shares a key with it.
    """
    date_text = F.date_format(day_to_date("adt_day"), "yyyy-MM-dd")
    return F.when(F.col("conflict_type") == SAME_DATE, date_text).otherwise(r_number_text("avisitn"))


def conflict_shared_forms(summary: DataFrame) -> DataFrame:
    """Conflicts with more than one entry, with the forms all entries share.

    A conflict is (subject, type, key) without the study, as in the scripts.
    Shared forms are found by counting, per conflict and form, the entries
    listing the form: shared when it equals the number of entries. Nothing
    per conflict is collected beyond the form names.
    """
    group = ("sjid", "conflict_type", "group_key")
    entries = summary.withColumn("group_key", conflict_key())
    sizes = entries.groupBy(*sort_keys(entries, group)).agg(n_rows().alias("__entries")).where(F.col("__entries") > 1)
    hits = (
        entries.select(*group, F.explode("distinct_crfs").alias("__form"))
        .groupBy(*group, "__form")
        .agg(n_rows().alias("__hits"))
    )
    shared = (
        join_on_keys(hits, sizes, group, ("group_key",))
        .where(F.col("__hits") == F.col("__entries"))
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list("__form")).alias("__shared"))
    )
    out = join_on_keys(entries, sizes, group, ("group_key",))
    out = join_on_keys(out, shared, group, ("group_key",), how="left")
    return out.select(
        "study",
        "sjid",
        "avisitn",
        "adt_day",
        "adt",
        "conflict_type",
        "n_crf",
        F.array_join("distinct_crfs", ", ").alias("distinct_crfs"),
        "group_key",
        F.coalesce(F.array_join("__shared", ", "), F.lit("")).alias("shared_crfs"),
        F.coalesce(F.size("__shared"), F.lit(0)).cast("bigint").alias("n_shared_crfs"),
    )


REVIEW_ORDER = ("study", "sjid", "avisitn", "adt_day", "conflict_type")


def conflict_review(shared: DataFrame) -> DataFrame:
    """The review list: every shared-forms row, in entry order (K5, O3)."""
    return shared.orderBy(*[F.asc_nulls_last(c) for c in REVIEW_ORDER])


def resolve_conflicts(summary: DataFrame) -> DataFrame:
    """Per conflict (with study), the entry with the most forms.

    Ties go to the lowest visit number, then the earliest date, missing last.
    An entry can lose one conflict and win another.
    """
    group = ("study", "sjid", "conflict_type", "group_key")
    entries = summary.withColumn("group_key", conflict_key()).withColumn(
        "distinct_crfs", F.array_join("distinct_crfs", ", ")
    )
    order = [-F.col("n_crf"), "avisitn", "adt_day"]
    best = first_by(entries, group, order, ["avisitn", "adt_day", "n_crf", "distinct_crfs"])
    return best.withColumn("adt", day_to_date("adt_day"))


def untouched_entries(entries: DataFrame, summary: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """Entries without a conflict.

    With ``claimed`` (the stored dates of several visits) and ``n_dates``, an entry tells by itself and these few
    dates whether it is in the summary, so neither the entries nor the summary are shuffled.
    """
    if claimed is not None and "n_dates" in entries.columns:
        return join_on_keys(entries.where(~_has_several_dates()), claimed, SUBJECT_DATE, ("adt_day",), how="left_anti")
    keys = ("study", "sjid", "adt_day", "avisitn")
    return join_on_keys(entries, summary.select(*keys), keys, ("adt_day", "avisitn"), how="left_anti")


def clean_entries(entries: DataFrame, summary: DataFrame, resolved: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """Winning conflict entries (as entries without a form name) plus all untouched ones: the entries of C20."""
    kept = [*ENTRY, "distinct_crfs", "unnamed"]
    winners = resolved.select(*ENTRY, F.array().cast("array<string>").alias("distinct_crfs"), F.lit(True).alias("unnamed"))
    return winners.unionByName(untouched_entries(entries, summary, claimed).select(*kept))


def clean_visits(
    visits: DataFrame | None, summary: DataFrame, resolved: DataFrame, entries: DataFrame | None = None, claimed: DataFrame | None = None
) -> DataFrame:
    """Winning conflict entries (no form name) plus all untouched visit-date-form rows (C20).

    ``entries`` are the ``visit_entries`` of ``visits``, where they are stored already, ``claimed`` their ``several_visits``.
    """
    entries = clean_entries(visit_entries(visits) if entries is None else entries, summary, resolved, claimed)
    return entry_forms(entries).withColumn("adt", day_to_date("adt_day"))


def visit_dates_with_age(clean: DataFrame, ages: DataFrame) -> DataFrame:
    """Distinct visit dates with baseline age, years since first date and age."""
    return dates_with_age(clean.select(*ENTRY).distinct(), ages)


def clean_dates(entries: DataFrame, summary: DataFrame, resolved: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """The distinct visit dates of C20, from entries that hold each visit date once.

    An entry can win both kinds of conflict, an untouched one is in none: only the winners can repeat.
    """
    return resolved.select(*ENTRY).distinct().unionByName(untouched_entries(entries, summary, claimed).select(*ENTRY))


def dates_with_age(visits: DataFrame, ages: DataFrame) -> DataFrame:
    """C21 from distinct visit dates, which are read twice."""
    first = visits.groupBy(*sort_keys(visits, SUBJECT)).agg(poisoned(F.min("adt_day"), "adt_day").alias("__first"))
    bl = ages.select(*SUBJECT, F.col("start_age").alias("age_bl"))
    per_subject = own_shuffle(join_on_keys(first, bl, SUBJECT, how="left"), SUBJECT)
    rows = join_on_keys(visits, per_subject, SUBJECT)
    time = (F.col("adt_day") - F.col("__first")) / F.lit(DAYS_PER_YEAR)
    return rows.select(
        "study",
        "sjid",
        "adt_day",
        day_to_date("adt_day").alias("adt"),
        "avisitn",
        "age_bl",
        time.alias("time"),
        (F.col("age_bl") + time).alias("age"),
    )
