"""Stacking forms into the observation table, and per-form clean-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.functions import first_by, r_number_text
from visitline.sources.forms import FORM_RELABEL, in_scope, relabel

OBS_COLUMNS = ("study", "sjid", "avisit", "avisitn", "crf", "adt")

# Visit label of an as-needed visit.
AS_NEEDED = "PRN"


def _is_text(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "string"


def has_visit_number(df: DataFrame, col: str = "avisitn") -> Column:
    """Whether a row has a visit number: any text that isn't blank, readable or not, or a number."""
    return F.coalesce(F.trim(F.col(col)) != "", F.lit(False)) if _is_text(df, col) else F.col(col).isNotNull()


def visit_number(df: DataFrame, col: str = "avisitn") -> Column:
    """Visit number as DOUBLE; in a text source an empty or unreadable value gives NULL."""
    if _is_text(df, col):
        return F.expr(f"try_cast(nullif(trim({col}), '') as double)")
    return F.col(col).cast("double")


def visit_date(df: DataFrame, col: str = "adt") -> Column:
    """Assessment date as DATE; in a text source an empty or unreadable value gives NULL."""
    if _is_text(df, col):
        return F.try_to_date(F.trim(F.col(col)))
    return F.col(col).cast("date")


# What a rejected row keeps of its source, and why it was rejected (NULL for the other rows).
REJECT_COLUMNS = ("avisitn_text", "adt_text", "reason")


def reject_columns(df: DataFrame) -> dict[str, Column]:
    """``REJECT_COLUMNS`` of rows with text visit keys: a visit number or date that is there but can't be read."""
    text = {c: F.trim(F.col(c)) if c in df.columns and _is_text(df, c) else None for c in ("avisitn", "adt")}
    read = {"avisitn": visit_number, "adt": visit_date}
    bad = {c: (t != "") & read[c](df, c).isNull() for c, t in text.items() if t is not None}
    labels = {"avisitn": "visit number", "adt": "date"}
    none = F.lit(None).cast("string")
    reason = F.concat_ws(", ", *[F.when(b, F.lit(labels[c])) for c, b in bad.items()]) if bad else F.lit("")
    reason = F.nullif(reason, F.lit(""))
    shown = {f"{c}_text": F.when(reason.isNotNull(), F.nullif(t, F.lit(""))) if t is not None else none for c, t in text.items()}
    return {**shown, "reason": reason}


def stack_forms(
    forms: DataFrame,
    study: str | None = None,
    exclude: Sequence[str] = (),
    drop_as_needed: bool = False,
    require_visit_number: bool = False,
    relabels: Mapping[str, str] = FORM_RELABEL,
    extra: Sequence[str] = (),
    base_form: str | None = None,
    skip_codes: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """All forms of a study as one ``OBS`` table.

    ``forms`` holds every form's rows with the form name in ``crf`` (see
    ``sources.forms.load_forms`` / ``union_forms``). Rules, as in the study
    scripts: excluded forms and, where the study says so, code lists are dropped; as-needed visits are
    dropped (``avisit <> 'PRN'``, a missing label is dropped too) or rows
    without a visit number are dropped; form files are relabelled; ``study``
    is set to a constant when given, even if the source has one. The rows of
    ``base_form`` are neither excluded nor dropped for a missing visit number.

    Rows left whose visit number or date is text that can't be read are rejected: they are
    not in the result or, with ``rejects``, they are in it with ``REJECT_COLUMNS`` set, for
    ``accepted`` and ``rejected`` to tell apart. ``forms`` that have these columns already (typed
    when they were loaded) keep them.
    """
    base = F.col("crf").eqNullSafe(F.lit(base_form)) if base_form else F.lit(False)
    df = forms.where(in_scope("crf", exclude, skip_codes) | base)
    if drop_as_needed:
        df = df.where(F.col("avisit") != F.lit(AS_NEEDED))
    known = "reason" in df.columns
    if require_visit_number:
        named = has_visit_number(df)
        df = df.where(named | F.col("avisitn_text").isNotNull() | base if known else named | base)
    text = known or any(_is_text(df, c) for c in ("avisitn", "adt"))
    if text and not known:
        df = df.withColumns(reject_columns(df))
    df = df.withColumns({"avisitn": visit_number(df), "adt": visit_date(df), "crf": relabel("crf", relabels)})
    if study is not None:
        df = df.withColumn("study", F.lit(study))
    if not rejects:
        return (accepted(df) if text else df).select(*OBS_COLUMNS, *extra)
    if not text:
        df = df.withColumns({c: F.lit(None).cast("string") for c in REJECT_COLUMNS})
    return df.select(*OBS_COLUMNS, *extra, *REJECT_COLUMNS)


def accepted(stacked: DataFrame) -> DataFrame:
    """The rows of a table with ``REJECT_COLUMNS`` that were not rejected, without these columns."""
    return stacked.where(F.col("reason").isNull()).drop(*REJECT_COLUMNS)


def rejected(stacked: DataFrame) -> DataFrame:
    """The rejected rows: form, subject and label, the values as they came, and the reason."""
    rows = stacked.where(F.col("reason").isNotNull())
    # A value that was read is shown as it was read.
    number, date = F.coalesce("avisitn_text", r_number_text("avisitn")), F.coalesce("adt_text", F.col("adt").cast("string"))
    return rows.select("study", "crf", "sjid", "avisit", number.alias("avisitn"), date.alias("adt"), "reason")


def dedupe_form_rows(
    form: DataFrame,
    ignore: Sequence[str] = ("adt", "avisit", "avisitn", "visit_age", "visityear"),
) -> DataFrame:
    """Keep the first row of each set of rows equal on all but ``ignore``.

    "First" is the earliest date (missing last), then the lowest visit
    number, then the visit label. The pick is an aggregate, so one group of
    copies holding a large share of the form is reduced map-side.
    """
    ignored = [c for c in ignore if c in form.columns]
    content = [c for c in form.columns if c not in ignored]
    order = [c for c in ("adt", "avisitn", "avisit") if c in ignored]
    kept = first_by(form, content, order, ignored)
    return kept.select(*form.columns)


def dedupe_form_keys(form: DataFrame, keys: Sequence[str] = OBS_COLUMNS, copies: str | None = None) -> DataFrame:
    """Distinct visit keys of a form (C4); ``copies`` names a column for the rows that each stands for."""
    if copies is None:
        return form.select(*keys).distinct()
    return form.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies))


def duplicate_key_rows(form: DataFrame, keys: Sequence[str] = OBS_COLUMNS) -> DataFrame:
    """Rows of key groups that occur more than once (the guard after C4; empty when unique)."""
    counts = form.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def one_row_per_cell(form: DataFrame, ids: Sequence[str], key: str, value: str) -> DataFrame:
    """``ids``, ``key`` and ``value``; two rows with the same ids and key are an error that names them.

    The check is a filter, so no later projection or grouping makes Spark leave it out.
    """
    cells = form.groupBy(*ids, key).agg(F.count(F.lit(1)).alias("__rows"), F.min(value).alias(value))
    shown = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NA"))) for c in (*ids, key)]
    error = F.raise_error(F.concat(F.lit("several rows for one cell of "), F.concat_ws(", ", *shown)))
    return cells.where(F.when(F.col("__rows") > 1, error.cast("boolean")).otherwise(F.lit(True))).drop("__rows")


def pivot_form(
    form: DataFrame,
    ids: Sequence[str],
    key: str,
    value: str,
    values: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    smallest: bool = False,
) -> DataFrame:
    """Long to wide: one column per ``key`` value holding ``value``.

    Two rows with the same ids and key are an error that names the ids, as in the
    R reshape; with ``smallest`` they resolve to their smallest value. ``values`` fixes
    the output columns; without it Spark finds them first.
    """
    df = form.drop(*drop)
    if not smallest:
        df = one_row_per_cell(df, ids, key, value)
    grouped = df.groupBy(*ids)
    pivoted = grouped.pivot(key, list(values)) if values is not None else grouped.pivot(key)
    return pivoted.agg(F.min(value))


def wide_ids(form: DataFrame, ids: Sequence[str], key: str, value: str, drop: Sequence[str] = ()) -> DataFrame:
    """The ids of ``pivot_form``'s rows, under the same check, without finding or filling the value columns."""
    return one_row_per_cell(form.drop(*drop), ids, key, value).select(*ids).distinct()
