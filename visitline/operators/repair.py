"""Repairing visit numbers and dates.

Input is an ``OBS`` table (``study, sjid, avisitn, crf, adt``). Every group
statistic is an aggregate joined back on its key: the map side pre-aggregates,
and a join on a hot subject or visit is a shuffle join that AQE can split,
where a window would put the whole group into one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.functions import (
    day_number,
    day_to_date,
    join_on_keys,
    keep_group_extreme,
    n_distinct_na,
    n_rows,
    several_rows,
    sort_keys,
)

VISIT = ("study", "sjid", "avisitn")
VISIT_DATE = ("study", "sjid", "avisitn", "adt")
NULLABLE = ("avisitn", "adt")

# Fixed value: dates of one visit at most this many days apart are merged.
SNAP_DAYS = 31


def one_date_per_form_visit(obs: DataFrame) -> DataFrame:
    """One row per subject, visit number and form, with its earliest date.

    Exact duplicates go first; among different dates of one form at one
    visit the earliest is kept. The date is missing only if all are.
    """
    return obs.groupBy(*sort_keys(obs, (*VISIT, "crf"))).agg(F.min("adt").alias("adt")).select(*VISIT, "adt", "crf")


def _n_forms(forms: Column) -> Column:
    """Distinct form names in an array."""
    return F.size(F.array_distinct(F.array_compact(forms))).cast("bigint")


def visit_forms(visits: DataFrame) -> DataFrame:
    """Visit entries: one row per subject, visit and date with its ``forms`` (at most the catalogue) and ``n_crf_date``.

    Input is the C8 table: a form occurs once per visit.
    """
    entries = visits.groupBy(*sort_keys(visits, VISIT_DATE)).agg(F.collect_list(F.struct("crf")).alias("__forms"))
    return entries.select(*VISIT_DATE, F.col("__forms")["crf"].alias("forms"), _n_forms(F.col("__forms")["crf"]).alias("n_crf_date"))


def forms_of(entries: DataFrame) -> DataFrame:
    """The form rows of visit entries."""
    return entries.select(*VISIT_DATE, F.explode("forms").alias("crf"), "n_crf_date")


def forms_per_date(visits: DataFrame) -> DataFrame:
    """Adds ``n_crf_date``: distinct forms with the same subject, visit and date.

    The forms of one visit-date travel as one array, are counted and spread out again. One shuffle, no join back.
    """
    return forms_of(visit_forms(visits))


def entries_of(rows: DataFrame) -> DataFrame:
    """Visit entries of a C9 table."""
    entries = rows.groupBy(*sort_keys(rows, VISIT_DATE)).agg(F.collect_list(F.struct("crf")).alias("__forms"), F.max("n_crf_date").alias("n_crf_date"))
    return entries.select(*VISIT_DATE, F.col("__forms")["crf"].alias("forms"), "n_crf_date")


def _pairs(entries: DataFrame, targets: DataFrame) -> DataFrame:
    """Entries (``*_tbc``) that meet a target entry of another visit number on the same date, with their forms that the target can take.

    The target must hold a form other than the one that would move, which its smallest and largest form name decide.
    """
    tbc = entries.select(
        "study", "sjid", "adt", F.col("avisitn").alias("avisitn_tbc"), F.col("forms").alias("forms_tbc"), F.col("n_crf_date").alias("n_crf_date_tbc")
    )
    targets = targets.select(*VISIT_DATE, "n_crf_date", F.array_min("forms").alias("crf_lo"), F.array_max("forms").alias("crf_hi"))
    pairs = join_on_keys(tbc, targets, ("study", "sjid", "adt"), ("adt",)).where(F.col("avisitn") != F.col("avisitn_tbc"))
    other = F.filter("forms_tbc", lambda c: (c != F.col("crf_lo")) | (c != F.col("crf_hi")))
    pairs = pairs.withColumn("forms_tbc", other).where(F.size("forms_tbc") > 0)
    return pairs.select("study", "sjid", "avisitn_tbc", "adt", "forms_tbc", "n_crf_date_tbc", "avisitn", "n_crf_date")


def inconsistent_entries(entries: DataFrame) -> DataFrame:
    """C10 from visit entries: pairs of entries of one date, spread over their forms last."""
    pairs = _pairs(entries, entries)
    return pairs.select(
        "study", "sjid", "avisitn_tbc", "adt", F.explode("forms_tbc").alias("crf_tbc"), "n_crf_date_tbc", "avisitn", "n_crf_date"
    )


def inconsistent_visits(visits: DataFrame) -> DataFrame:
    """Forms dated on a day that another visit of the subject also claims.

    For each form row (``*_tbc``: to be corrected) and each other visit number
    of the same subject on the same date (missing dates match each other),
    one row, provided that other visit holds a form other than this one.

    The rule is a many-to-many self join on subject and date. Here visit entries
    (one row per visit and date) meet, and the forms are spread at the end.
    """
    return inconsistent_entries(entries_of(visits))


def visit_corrections(inconsistent: DataFrame) -> DataFrame:
    """Which form moves to which visit number (C11), from the C10 table.

    Per subject and date, only the target visits with the most forms stay;
    then, per subject and target visit, only the forms whose own visit had
    the fewest forms that day. Equal counts make two visits swap forms; a
    larger minority is left alone. Keys are by subject without study, as in
    the study scripts.
    """
    most = keep_group_extreme(inconsistent, ("sjid", "adt"), "n_crf_date", "max", ("adt",))
    fewest = keep_group_extreme(most, ("sjid", "avisitn"), "n_crf_date_tbc", "min", ("avisitn",))
    return fewest.select(
        "study",
        "sjid",
        F.col("avisitn_tbc").alias("avisitn"),
        F.col("avisitn").alias("avisitn_new"),
        F.col("crf_tbc").alias("crf"),
    )


def correction_pairs(entries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The first half of C11 from visit entries: pairs whose target has the most forms of its subject and date.

    That largest count is known before anything is paired. On one date of a subject, an entry is a target
    if another entry holds a form that it can take; that is so for all entries of the date or for none
    (there are two entries, and not all hold the same single form). So the largest count is that of the date's
    entries, and only the entries that have it are met by the others. ``keep`` may store what is read more than once.
    """
    entries = entries.where(F.col("avisitn").isNotNull() & F.array_min("forms").isNotNull())
    day = ("study", "sjid", "adt")
    # Dates that several visits claim are told by a count alone; the steps below read only their entries. They are few:
    # stored, their size is known before the join is planned, and the entries need not be shuffled and sorted for it.
    several = keep(several_rows(entries, day))
    return _target_pairs(keep(join_on_keys(entries, several, day, ("adt",), how="left_semi")))


def visit_correction_pairs(visits: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``correction_pairs`` of ``visit_rows`` of a C8 table.

    A visit only tells its dates at first, also one that has no form name; forms are dealt to their dates for the
    few dates that several visits claim.
    """
    visits = visits.where(F.col("avisitn").isNotNull())
    day = ("study", "sjid", "adt")
    dates = visits.select("study", "sjid", F.explode(F.array_distinct(F.col("rows")["adt"])).alias("adt"))
    several = keep(several_rows(dates, day))
    rows = visits.select(*VISIT, F.inline("rows")).where(F.col("crf").isNotNull())
    return _target_pairs(keep(visit_forms(join_on_keys(rows, several, day, ("adt",), how="left_semi"))))


def _target_pairs(entries: DataFrame) -> DataFrame:
    """Entries, where several visits claim their date, paired with those that have the most forms of their subject and date."""
    day = ("study", "sjid", "adt")
    dates = entries.groupBy(*sort_keys(entries, day)).agg(
        F.min(F.array_min("forms")).alias("__lo"), F.max(F.array_max("forms")).alias("__hi"), F.max("n_crf_date").alias("__most"), n_rows().alias("__entries")
    )
    dates = dates.where((F.col("__lo") != F.col("__hi")) & (F.col("__entries") > 1))
    most = dates.groupBy("sjid", "adt").agg(F.max("__most").alias("__most"))
    targets = join_on_keys(entries, most, ("sjid", "adt"), ("adt",)).where(F.col("n_crf_date") == F.col("__most"))
    return _pairs(entries, targets)


def fewest_corrections(pairs: DataFrame) -> DataFrame:
    """The second half of C11: per subject and target visit, the entries with the fewest forms, spread over their forms."""
    fewest = keep_group_extreme(pairs, ("sjid", "avisitn"), "n_crf_date_tbc", "min", ("avisitn",))
    return fewest.select(
        "study", "sjid", F.col("avisitn_tbc").alias("avisitn"), F.col("avisitn").alias("avisitn_new"), F.explode("forms_tbc").alias("crf")
    )


def apply_corrections(visits: DataFrame, corrections: DataFrame) -> DataFrame:
    """New visit number where a correction exists; ``avisitn_original`` keeps the old one.

    A form with several corrections appears once per correction.
    """
    joined = join_on_keys(
        visits, corrections, ("study", "sjid", "avisitn", "crf"), ("avisitn",), how="left"
    )
    moved = F.col("avisitn_new").isNotNull()
    return joined.select(
        "study",
        "sjid",
        F.coalesce("avisitn_new", "avisitn").alias("avisitn"),
        "adt",
        "crf",
        "n_crf_date",
        F.when(moved, F.col("avisitn")).alias("avisitn_original"),
    )


def drop_collided_forms(visits: DataFrame) -> DataFrame:
    """Remove every copy of a form that is now twice in one visit on one date."""
    groups = visits.groupBy(*sort_keys(visits, (*VISIT_DATE, "crf"))).agg(
        n_rows().alias("__copies"),
        F.max("n_crf_date").alias("n_crf_date"),
        F.max("avisitn_original").alias("avisitn_original"),
    )
    return groups.where(F.col("__copies") == 1).select(
        "study", "sjid", "avisitn", "adt", "crf", "n_crf_date", "avisitn_original"
    )


def distinct_dates(visits: DataFrame) -> DataFrame:
    """Number of distinct dates in the table, a missing date counting as one."""
    return visits.agg(n_distinct_na("adt").alias("n_dates"))


def snap_to_median(visits: DataFrame, snap_days: int = SNAP_DAYS) -> DataFrame:
    """Dates of one visit at most ``snap_days`` apart become their median (C14).

    The median is over form rows and may fall on a half day; ``adt_day``
    keeps it (days since 1970-01-01) and ``adt`` shows its whole day. One
    missing date makes the span, the median and so every date of the visit
    missing. ``n_crf_date`` and ``diff`` are recomputed on the new dates:
    snapped or missing visits have one date, others keep theirs.

    After C8 and C13 a visit holds a form once per date, and only dates that its own forms had, so its
    rows fit in one array: one shuffle, and nothing is joined back.
    """
    return snapped_rows(snap_visits(visit_rows(visits, ("avisitn_original",)), snap_days), snap_days)


def visit_rows(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Visits: one row per subject and visit number with its form rows (``adt``, ``crf``, ``extra``) in ``rows``.

    Input is a C8 table (a form once per visit) or a C13 table (once per visit and date).
    """
    visits = rows.groupBy(*sort_keys(rows, VISIT)).agg(F.collect_list(F.struct("adt", "crf", *extra)).alias("rows"))
    return visits.select(*VISIT, "rows")


def _forms_on(date: Column) -> Column:
    """The forms of a visit's rows that have this date."""
    return F.filter("rows", lambda r: r["adt"].eqNullSafe(date))["crf"]


def forms_of_visits(visits: DataFrame) -> DataFrame:
    """The ``visit_forms`` of ``visit_rows``: a visit's rows are dealt to its dates, without a shuffle."""
    dates = F.transform(F.array_distinct(F.col("rows")["adt"]), lambda d: F.struct(d.alias("adt"), _forms_on(d).alias("forms")))
    entries = visits.select(*VISIT, F.inline(dates))
    return entries.select(*VISIT_DATE, "forms", _n_forms(F.col("forms")).alias("n_crf_date"))


def corrected_visits(corrections: DataFrame) -> DataFrame:
    """The visits that a correction takes a form from or moves one to."""
    visits = corrections.select("study", "sjid", F.explode(F.array("avisitn", "avisitn_new")).alias("avisitn"))
    return visits.distinct()


def correct_visits(visits: DataFrame, corrections: DataFrame, corrected: DataFrame) -> DataFrame:
    """C12 and C13 on ``visit_rows`` of a C8 table; ``corrected`` are the ``corrected_visits``.

    A visit that no correction names keeps its rows in C12, and a form is there once, so C13 keeps them too:
    only the rows of the other visits are spread, moved and collected again.
    """
    rows = forms_of(forms_of_visits(join_on_keys(visits, corrected, VISIT, how="left_semi")))
    moved = visit_rows(drop_collided_forms(apply_corrections(rows, corrections)))
    return join_on_keys(visits, corrected, VISIT, how="left_anti").unionByName(moved)


def snap_visits(visits: DataFrame, snap_days: int = SNAP_DAYS) -> DataFrame:
    """C14 on ``visit_rows``: adds ``__span`` (days between the visit's dates) and, up to ``snap_days``, ``__median``.

    Both are missing if one date is: the sorted dates then begin with it.
    """
    days = F.sort_array(F.col("rows")["adt"])
    visits = visits.select(*VISIT, "rows", days.alias("__days"))
    days, size = F.col("__days"), F.size("__days")
    middle = [day_number(F.get(days, F.floor((size - i) / 2).cast("int"))) for i in (0, 1)]
    span = day_number(F.get(days, size - 1)) - day_number(F.get(days, F.lit(0)))
    visits = visits.select(*VISIT, "rows", span.alias("__span"), ((middle[0] + middle[1]) / 2).alias("__median"))
    return visits.withColumn("__median", F.when(F.col("__span") <= F.lit(snap_days), F.col("__median")))


def snapped_rows(visits: DataFrame, snap_days: int = SNAP_DAYS) -> DataFrame:
    """The form rows of ``snap_visits``."""
    day = day_number("adt")
    per_visit = visits.select(
        *VISIT,
        "rows",
        "__span",
        "__median",
        _n_forms(F.col("rows")["crf"]).alias("__n_visit"),
        # The forms of each row's date; only visits that keep their dates need them.
        F.when(F.col("__span") > F.lit(snap_days), F.transform("rows", lambda r: _n_forms(_forms_on(r["adt"])))).alias("__n_dates"),
    )
    rows = per_visit.select(*VISIT, "__span", "__median", "__n_visit", "__n_dates", F.posexplode("rows").alias("__at", "__row"))
    rows = rows.select(*VISIT, "__row.*", F.get("__n_dates", "__at").alias("__n_date"), "__span", "__median", "__n_visit")
    span = F.col("__span")
    snapped, kept = span <= F.lit(snap_days), span > F.lit(snap_days)
    adt_day = F.when(snapped, F.col("__median")).when(kept, day)
    return rows.select(
        "study",
        "sjid",
        "avisitn",
        "avisitn_original",
        "crf",
        F.col("adt").alias("adt_before_median"),
        adt_day.alias("adt_day"),
        day_to_date(adt_day).alias("adt"),
        F.when(kept, F.col("__n_date")).otherwise(F.col("__n_visit")).alias("n_crf_date"),
        F.when(kept, span).when(snapped, F.lit(0.0)).cast("bigint").alias("diff"),
    )


def snapped_entries(visits: DataFrame, snap_days: int = SNAP_DAYS) -> DataFrame:
    """The ``conflicts.visit_entries`` of ``snap_visits``, with ``n_dates``: the entries of their visit.

    A visit that keeps its dates has an entry for each, any other has one; its rows are neither spread nor collected again.
    """
    kept = F.transform(
        F.array_distinct(F.col("rows")["adt"]), lambda d: F.struct(day_number(d).alias("adt_day"), _forms_on(d).alias("__forms"))
    )
    one = F.array(F.struct(F.col("__median").alias("adt_day"), F.col("rows")["crf"].alias("__forms")))
    dates = visits.select(*VISIT, F.when(F.col("__span") > F.lit(snap_days), kept).otherwise(one).alias("__dates"))
    entries = dates.select(*VISIT, F.size("__dates").alias("n_dates"), F.inline("__dates"))
    none = F.array(F.lit(None).cast("string"))
    return entries.select(
        *VISIT,
        "adt_day",
        F.sort_array(F.array_except("__forms", none)).alias("distinct_crfs"),
        F.get(F.sort_array("__forms"), F.lit(0)).isNull().alias("unnamed"),  # a missing form name sorts first
        "n_dates",
    )
