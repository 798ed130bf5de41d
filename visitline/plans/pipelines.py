"""The two study pipelines as lazily built stages.

*Flag pipeline*: stacked forms -> form summary -> multi-date visits (flags)
-> span histogram -> flagged visit table -> residual check, visit-mode
summary.

*Repair pipeline*: forms of subjects with a baseline age, stacked without
as-needed visits -> one date per form visit -> forms per date -> inconsistent
visits -> corrections -> applied -> collided forms dropped -> median snap
-> visit entries (lineage cut here: the conflicts and the clean table read
them; up to here the conflict queries keep a visit's form rows in one array) -> conflicts -> summary, shared forms, resolution -> clean visits -> counts, visit dates with age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitline.functions import sort_keys
from visitline.operators import ages as ages_ops
from visitline.operators import conflicts, flags, repair
from visitline.operators.stack import AS_NEEDED, dedupe_form_rows, stack_forms
from visitline.session import cut_lineage
from visitline.sources import fixtures
from visitline.sources.studies import STUDIES


def flag_obs(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Stacked forms for the flag pipeline: rows without a visit number are dropped."""
    return stack_forms(fixtures.obs(spark, sf_dir), require_visit_number=True, extra=extra)


def ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ages_ops.baseline_age(fixtures.registration(spark, sf_dir), fixtures.demographics(spark, sf_dir))


def stack_for_repair(forms: DataFrame, labels: bool = True) -> DataFrame:
    """Stacked forms for the repair pipeline: as-needed visits dropped, then repeated content (C3) per form.

    The visit label comes last in C3's order, so without ``labels`` (it is then missing) the same dates and visit numbers stay.
    """
    forms = forms.where(F.col("avisit") != F.lit(AS_NEEDED))
    if labels:
        return stack_forms(dedupe_form_rows(forms), exclude=STUDIES["CRCSCA"].exclude, drop_as_needed=True)
    kept = dedupe_form_rows(forms.drop("avisit")).withColumn("avisit", F.lit(None).cast("string"))
    return stack_forms(kept, exclude=STUDIES["CRCSCA"].exclude)


def repair_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack_for_repair(fixtures.raw_forms(spark, sf_dir))


FLAG_ORDER = (
    "form_summary",
    "multi_date_visits",
    "span_histogram",
    "visit_dates_flagged",
    "residual_multi_date",
)


def flag_stage(
    obs: DataFrame,
    upto: str,
    cut: bool = True,
    breaks: tuple[float, ...] = flags.SPAN_BREAKS,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Run the flag operators up to ``upto`` on a stacked table.

    With ``cut``, tables read more than once are written to the checkpoint
    folder first: the per-date summary (read by the spans and by the flag
    join) and the stacked table when the flagged table needs it again. Without
    the cuts the two reads were planned and run separately (exchange reuse did
    not apply in the measured plans). Where the form names are not needed the
    stored summary holds counts only.
    """
    if upto == "form_summary":
        return flags.form_summary(obs)
    if upto == "span_histogram":  # reads the summary once: nothing to cut
        return flags.span_histogram(obs, breaks)
    keep = (lambda df: cut_lineage(df)) if cut else (lambda df: df)
    if upto == "multi_date_visits":
        return flags.multi_date_visits(obs, keep(flags.date_summary(obs)))
    if upto == "visit_dates_flagged":
        obs = keep(obs)
        return flags.visit_dates_flagged(obs, extra, keep(flags.date_counts(obs)))
    if upto == "residual_multi_date":
        return flags.residual_of_dates(keep(flags.date_counts(obs)))
    raise ValueError(f"unknown stage {upto!r}; expected one of {FLAG_ORDER}")


def repair_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair input: stacked forms of subjects with a baseline age, without visit labels (C8 reads none)."""
    # C3 keeps subjects apart, so the subjects without an age may go first: the rows meet the ages' shuffle by subject,
    # which C3, C8 and C9 then need not repeat. Hashing the ages' side (one row per subject) spares the sort of all rows.
    with_age = ages_ops.subjects_with_age(fixtures.raw_forms(spark, sf_dir), ages(spark, sf_dir).hint("shuffle_hash"))
    return stack_for_repair(with_age, labels=False)


REPAIR_ORDER = (
    "one_date_per_form_visit",
    "forms_per_date",
    "inconsistent_visits",
    "visit_corrections",
    "apply_corrections",
    "drop_collided_forms",
    "snap_to_median",
)

# Read by more than one later stage: the visit entries behind C9, and the entries of shared dates and the correction pairs inside C11.
# The shared dates themselves and the corrections are stored for their size: Spark then broadcasts them instead of shuffling the rows.
# Cutting lineage there keeps each consumer's plan a scan of the cut instead of another copy of the chain.


def repair_stage(stacked: DataFrame, upto: str, cut: bool = True) -> DataFrame:
    """Run C8 ... ``upto`` on a stacked table.

    With ``cut``, what later steps read more than once is
    written to the checkpoint folder (an eager job each) before they are read
    again. Without cuts every aggregate-and-join step copies the plan above
    it, so the plan doubles per step: use ``cut=False`` only for short chains.

    C10 is not on the way to C11: corrections come from visit entries, of which only those with the
    most forms of a date are paired.
    """
    if upto not in REPAIR_ORDER:
        raise ValueError(f"unknown stage {upto!r}; expected one of {REPAIR_ORDER}")
    keep = cut_lineage if cut else (lambda df: df)
    c8 = repair.one_date_per_form_visit(stacked)
    if upto == "one_date_per_form_visit":
        return c8
    if upto == "forms_per_date":
        return repair.forms_per_date(c8)
    entries = keep(repair.visit_forms(c8))
    if upto == "inconsistent_visits":
        return repair.inconsistent_entries(entries)
    corrections = repair.fewest_corrections(keep(repair.correction_pairs(entries, keep)))
    if upto == "visit_corrections":
        return corrections
    # Corrections are few: stored, their size is known before the form rows would be shuffled and sorted to meet them.
    applied = repair.apply_corrections(repair.forms_of(entries), keep(corrections))
    if upto == "apply_corrections":
        return applied
    # C13, C14 and the visit entries all work within a visit: one shuffle of the form rows serves the three.
    applied = applied.repartition(*sort_keys(applied, repair.VISIT)) if cut else applied
    collided = repair.drop_collided_forms(applied)
    if upto == "drop_collided_forms":
        return collided
    return repair.snap_to_median(collided)


def repaired_entries(stacked: DataFrame, cut: bool = True) -> DataFrame:
    """The visit entries of C14, from a stacked table: C8 ... C14 on visits.

    Same as ``conflicts.visit_entries`` of ``repair_stage(stacked, "snap_to_median")``, with each entry's ``n_dates``. The form rows
    are collected into their visits once; C9 and C14 work inside a visit, and only visits that a correction names are spread for
    C12 and C13. So no form row is shuffled, sorted or collected again.
    """
    keep = cut_lineage if cut else (lambda df: df)
    visits = keep(repair.visit_rows(repair.one_date_per_form_visit(stacked)))
    corrections = keep(repair.fewest_corrections(keep(repair.visit_correction_pairs(visits, keep))))
    corrected = repair.correct_visits(visits, corrections, keep(repair.corrected_visits(corrections)))
    return repair.snapped_entries(repair.snap_visits(corrected))


def repaired_visits(spark: SparkSession, sf_dir: str, cut: bool = True) -> DataFrame:
    """The repaired visit table (C14 output); checkpointed when ``cut``."""
    visits = repair_stage(repair_input(spark, sf_dir), "snap_to_median", cut)
    return cut_lineage(visits) if cut else visits


CONFLICT_ORDER = (
    "conflict_rows",
    "conflict_summary",
    "conflict_shared_forms",
    "conflict_review",
    "resolve_conflicts",
    "clean_visits",
    "visit_counts",
    "visit_dates_with_age",
)


def conflict_stage(
    visits: DataFrame | None, subject_ages: DataFrame, upto: str, cut: bool = True, entries: DataFrame | None = None
) -> DataFrame:
    """Run C16 ... ``upto`` (C15-C21) on the repaired visit table, or on its visit ``entries`` (``repaired_entries``).

    Everything is read off the visit entries, so ``visits`` may come without a cut: with ``cut`` the entries
    are checkpointed, with the dates that several visits claim, and the conflict summary when a later stage reads it.
    """
    # The two kinds of conflict and the clean table read the entries; nothing else reads the visits.
    keep = cut_lineage if cut else (lambda df: df)
    entries = keep(conflicts.visit_entries(visits) if entries is None else entries)
    if upto == "conflict_rows":
        return conflicts.conflict_rows(visits, entries, keep)
    claimed = keep(conflicts.several_visits(entries))
    summary = conflicts.conflict_entries(entries, claimed=claimed)
    if upto == "conflict_summary":
        return summary
    summary = keep(summary)
    if upto == "conflict_shared_forms":
        return conflicts.conflict_shared_forms(summary)
    if upto == "conflict_review":
        return conflicts.conflict_review(conflicts.conflict_shared_forms(summary))
    resolved = conflicts.resolve_conflicts(summary)
    if upto == "resolve_conflicts":
        return resolved
    if upto == "visit_dates_with_age":  # reads no form names, so the entries of the clean table are not spread
        return conflicts.dates_with_age(keep(conflicts.clean_dates(entries, summary, resolved, claimed)), subject_ages)
    clean = conflicts.clean_visits(visits, summary, resolved, entries, claimed)
    if upto == "clean_visits":
        return clean
    if upto == "visit_counts":
        return conflicts.visit_counts(clean)
    raise ValueError(f"unknown stage {upto!r}; expected one of {CONFLICT_ORDER}")
