"""Flagging visits with more than one date.

Input is an ``OBS`` table with visit labels (``study, sjid, avisit, avisitn,
crf, adt``). Orders that the scripts take from the data ("first appearance")
are made explicit: forms sort by name, dates of a visit by their smallest
form name and then by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.functions import (
    cut_rank,
    cut_right,
    join_on_keys,
    joined_list,
    n_rows,
    nulls_last_key,
    poisoned,
    r_text_na,
)

LABELLED_VISIT = ("study", "sjid", "avisit", "avisitn")
VISIT_DATE = (*LABELLED_VISIT, "adt")
NULLABLE = ("avisit", "avisitn", "adt")

# Span bins (days) of the histogram, long and short variants.
SPAN_BREAKS = (0, 31, 90, 180, 1000, 2000, 3000, 1e18)
SPAN_BREAKS_SHORT = (0, 31, 90, 180, 3000)

# Fixed value: visit number of unscheduled visits.
UNSCHEDULED = -1.0


def date_summary(obs: DataFrame) -> DataFrame:
    """Per visit-date: rows, its forms with their row counts (sorted), smallest form name.

    The input of the flag table; pass it to the operators as ``summary`` when
    it is computed (or stored) once for several of them. Forms are (name,
    count) pairs, at most the form catalogue, however many rows a date holds.

    Rows are first counted per form, so a date with many rows of one form
    shuffles one row for it.
    """
    per_form = obs.groupBy(*VISIT_DATE, "crf").agg(n_rows().alias("rows"))
    return per_form.groupBy(*VISIT_DATE).agg(
        F.sum("rows").cast("bigint").alias("n"),
        F.array_sort(F.collect_list(F.struct("crf", "rows"))).alias("forms"),
        F.min("crf").alias("first_crf"),
    )


def date_counts(obs: DataFrame) -> DataFrame:
    """Per visit-date: rows and smallest form name (what C24-C26 need of the summary)."""
    return obs.groupBy(*VISIT_DATE).agg(n_rows().alias("n"), F.min("crf").alias("first_crf"))


def forms_text() -> Column:
    """The forms of a date as text, one name per row: the outputs' ``crf``, written by the last projection only."""
    repeated = F.transform("forms", lambda e: F.array_repeat(e["crf"], e["rows"].cast("int")))
    return F.array_join(F.flatten(repeated), ", ").alias("crf")


def form_summary(obs: DataFrame, text: bool = True) -> DataFrame:
    """``n`` rows and the forms per subject, visit and date.

    The forms are a comma list with one name per row, as the scripts have it or, without ``text``, the array
    ``forms`` of (name, rows) runs, whose size is bounded by the form catalogue.
    """
    return date_summary(obs).select(*VISIT_DATE, "n", forms_text() if text else "forms")


def form_runs(obs: DataFrame) -> DataFrame:
    """``form_summary`` without its text, one row per form of a date: ``crf`` and its ``rows``."""
    return form_summary(obs, text=False).select(*VISIT_DATE, "n", F.inline("forms"))


def _multi_date_visit_spans(summary: DataFrame) -> DataFrame:
    """Labelled visits with more than one distinct date, and their span in days."""
    span = F.datediff(F.max("adt"), F.min("adt")).cast("bigint")
    return (
        summary.groupBy(*LABELLED_VISIT)
        .agg(n_rows().alias("__dates"), poisoned(span, "adt").alias("diff"))
        .where(F.col("__dates") > 1)
        .drop("__dates")
    )


def _flags(summary: DataFrame) -> DataFrame:
    spans = _multi_date_visit_spans(summary)
    return join_on_keys(summary, spans, LABELLED_VISIT, ("avisit", "avisitn")).withColumn(
        "flagged", F.lit(True)
    )


def multi_date_visits(obs: DataFrame, summary: DataFrame | None = None, text: bool = True) -> DataFrame:
    """The flag table: every date of a visit that has several, with span and forms (C23; ``text`` as in ``form_summary``)."""
    flags = _flags(date_summary(obs) if summary is None else summary)
    return flags.select(*VISIT_DATE, "diff", "flagged", "n", forms_text() if text else "forms")


def span_histogram(
    obs: DataFrame, breaks: Sequence[float] = SPAN_BREAKS, summary: DataFrame | None = None
) -> DataFrame:
    """Flagged visits counted by span bin ``(lo, hi]``; spans outside all bins count as NULL."""
    spans = _multi_date_visit_spans(date_counts(obs) if summary is None else summary)
    return spans.groupBy(
        cut_rank("diff", breaks).alias("bin"), cut_right("diff", breaks).alias("six_months")
    ).agg(n_rows().alias("n"))


def _visit_flags(summary: DataFrame) -> DataFrame:
    """Per visit number and span: the distinct row counts of its dates as text."""
    first_seen = _flags(summary).groupBy("study", "sjid", "avisitn", "diff", "n").agg(
        F.min(F.struct("first_crf", *nulls_last_key("adt"))).alias("__seen")
    )
    return first_seen.groupBy("study", "sjid", "avisitn", "diff").agg(
        joined_list(F.collect_list(F.struct("__seen", F.col("n").cast("string").alias("v"))), "v").alias("n")
    ).withColumn("flagged", F.lit(True))


def visit_dates_flagged(
    obs: DataFrame, extra: Sequence[str] = (), summary: DataFrame | None = None
) -> DataFrame:
    """Every row with its visit's flags: ``n`` (distinct date counts as text), ``diff``, ``flagged``.

    Flags are made per labelled visit but attached by visit number, so labels
    sharing a number share (and multiply) their flags.
    """
    n_text = _visit_flags(date_counts(obs) if summary is None else summary)
    rows = obs.select(*VISIT_DATE, "crf", *extra)
    joined = join_on_keys(rows, n_text, ("study", "sjid", "avisitn"), ("avisitn",), how="left")
    return joined.select(*VISIT_DATE, "n", "diff", "crf", "flagged", *extra)


def residual_multi_date(flagged: DataFrame) -> DataFrame:
    """Scheduled visits that still hold more than one distinct row without the form."""
    return _several_rows(flagged.where(F.col("avisitn") != F.lit(UNSCHEDULED)).drop("crf").distinct())


def residual_of_dates(summary: DataFrame) -> DataFrame:
    """C26 from the per-date summary: the same rows as ``residual_multi_date`` of the flagged table.

    The flagged table without the form is its visit-dates with their flags, so
    the check needs one row per visit-date and never the rows themselves.
    """
    dates = summary.where(F.col("avisitn") != F.lit(UNSCHEDULED)).select(*VISIT_DATE)
    flags = _visit_flags(summary)
    rows = join_on_keys(dates, flags, ("study", "sjid", "avisitn"), how="left")
    return _several_rows(rows.select(*VISIT_DATE, "n", "diff", "flagged"))


def _several_rows(rows: DataFrame) -> DataFrame:
    keys = ("sjid", "avisit", "avisitn")
    many = rows.groupBy(*keys).agg(n_rows().alias("__k")).where(F.col("__k") > 1).drop("__k")
    return join_on_keys(rows, many, keys, ("avisit", "avisitn"), how="left_semi")


def visit_mode_summary(obs: DataFrame, mode: str = "hpf") -> DataFrame:
    """Per subject and visit label: the visit-mode values seen, in order of appearance.

    Order of appearance is by visit number, then date (missing last), then
    form name; a missing value shows as ``NA``.
    """
    first_seen = obs.groupBy("study", "sjid", "avisit", mode).agg(
        F.min(F.struct(*nulls_last_key("avisitn", "adt"), F.col("crf"))).alias("__seen")
    )
    return first_seen.groupBy("study", "sjid", "avisit").agg(
        joined_list(F.collect_list(F.struct("__seen", r_text_na(mode).alias("v"))), "v").alias(mode)
    )
