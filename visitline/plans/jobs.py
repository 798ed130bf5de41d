"""Study jobs: a folder of form files in, dated result tables out.

These are the batch entry points a study team runs: the flag job (visits
with several dates) and the repair job (visit numbers and dates repaired,
conflicts resolved, age at visit). Each reads the form catalogue, loads the
forms in scope, applies per-form preparation where a study needs it,
stacks them, runs the operators and writes dated tables.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitline.operators import ages as ages_ops
from visitline.operators import conflicts, flags
from visitline.operators.stack import (
    AS_NEEDED,
    accepted,
    dedupe_form_keys,
    dedupe_form_rows,
    has_visit_number,
    reject_columns,
    rejected,
    stack_forms,
    visit_date,
    visit_number,
    wide_ids,
)
from visitline.plans import pipelines
from visitline.session import configure, cut_lineage, job_scratch
from visitline.sources import forms as form_io
from visitline.sources import sinks
from visitline.sources.manifest import form_manifest, form_scope, source_of
from visitline.sources.studies import STUDIES, Study

Prepare = Callable[[DataFrame], DataFrame]


def _spread(drop: tuple[str, ...], key: str, value: str) -> Prepare:
    """A long-to-wide reshape of which only the ids are stacked (a second row for a cell is an error)."""

    def run(form: DataFrame) -> DataFrame:
        ids = [c for c in form.columns if c not in (*drop, key, value)]
        return wide_ids(form, ids, key, value, drop=drop)

    return run


# Per-form preparation of one study: two long-to-wide reshapes and one form
# reduced to its distinct visit keys, before stacking.
FACOMS_PREPARE: dict[str, Prepare] = {
    "clat1": _spread(("od100_1", "os100_2"), "acuity", "ou100_1"),
    "clatb": _spread(("ou25",), "seq_no", "ou125"),
    "mhxgen": lambda f: dedupe_form_keys(f, ("sjid", "avisit", "avisitn", "adt", "crf")),
}
PREPARE: dict[str, dict[str, Prepare]] = {"FACOMS": FACOMS_PREPARE}


EXTRA = ("hpf", "fpf")


def _visit_rows(form: DataFrame, study: Study, base: bool, prepare: Prepare | None, sjid: str) -> DataFrame:
    """Rows of forms of equal columns as visit keys of fixed types, with ``REJECT_COLUMNS`` where visit keys are text.

    Projecting before the forms are appended keeps unlike columns of the same name apart.
    """
    if prepare:
        if study.require_visit_number and not base and "avisitn" in form.columns:
            form = form.where(has_visit_number(form))  # the scripts filter before they reshape
        form = prepare(form)
    if not base:
        form = drop_repeats(form, study)
    typed = {
        "study": F.lit(study.name),
        "sjid": F.col("sjid").cast(sjid),
        "avisit": F.col("avisit").cast("string"),
        "avisitn": visit_number(form) if "avisitn" in form.columns else F.lit(None).cast("double"),
        "adt": visit_date(form) if "adt" in form.columns else F.lit(None).cast("date"),
        "crf": F.col("crf"),
    }
    extra = {c: F.col(c).cast("string") for c in EXTRA if c in form.columns}
    text = any(t == "string" for c, t in form.dtypes if c in ("avisitn", "adt"))
    return form.select(*[c.alias(k) for k, c in (typed | extra | (reject_columns(form) if text else {})).items()])


def _subject_type(used: list[Row]) -> str:
    """The type of ``sjid`` that holds the subjects of all forms."""
    kinds = {c.type for r in used for c in r.columns if c.name.lower() == "sjid"}
    if len(kinds) == 1:
        return kinds.pop()
    return "bigint" if kinds <= {"tinyint", "smallint", "int", "bigint"} else "string"


def load_study_forms(
    spark: SparkSession,
    folder: str,
    study: Study,
    fmt: str | None = None,
    suffix: str | None = None,
    options: Mapping[str, str] | None = None,
    prepare: Mapping[str, Prepare] | None = None,
    store: str | None = None,
) -> DataFrame:
    """Forms of a study folder, the base form first, each prepared and projected to its visit rows, then appended.

    File ending, format and options are by default the study's. Forms in scope and their columns come from
    the folder's manifest (kept at ``store`` between runs, if given). Forms of equal columns are read in one scan, told
    apart by their path; the base form and forms with a preparation have a scan each, so the plan grows
    with the number of different column lists, not of forms. Where visit numbers or dates are text, the
    rows have ``REJECT_COLUMNS``.
    """
    source = source_of(study, suffix, fmt, options)
    manifest = form_manifest(spark, folder, source, store)
    used = form_scope(manifest, study).where("used").collect()  # one row per form
    if not used:
        raise ValueError(f"no form of {folder} has a visit scheme and rows")
    prepare = PREPARE.get(study.name, {}) if prepare is None else prepare
    scans: dict[tuple, list[Row]] = {}
    for r in sorted(used, key=lambda r: (not r.base, r.crf)):
        alone = r.crf if r.base or r.crf in prepare else None
        scans.setdefault((not r.base, r.schema, alone), []).append(r)
    sjid = _subject_type(used)
    loaded = []
    for (_, schema, alone), rows in scans.items():
        reader = spark.read.format(source.format).options(**source.options).schema(StructType.fromJson(json.loads(schema)))
        df = reader.load([r.path for r in rows])
        crf = F.lit(rows[0].crf) if len(rows) == 1 else form_io.form_of_path(F.col("_metadata.file_path"), folder, source.suffix)
        df = df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns if c.lower() != "crf"], crf.alias("crf"))
        loaded.append(_visit_rows(df, study, rows[0].base, prepare.get(alone), sjid))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


def drop_repeats(forms: DataFrame, study: Study) -> DataFrame:
    """Repeated content (C3) of all forms but the base, after the as-needed visits, where the study asks for it."""
    if not study.dedupe_rows:
        return forms
    if study.drop_as_needed:
        forms = forms.where(F.col("avisit") != F.lit(AS_NEEDED))
    return dedupe_form_rows(forms)


def stack_study(forms: DataFrame, study: Study, extra: tuple[str, ...] = (), rejects: bool = False, copies: str | None = None) -> DataFrame:
    """The study's ``OBS`` table (C2), with C4 where the study asks for it.

    With ``rejects`` rejected rows are kept and marked (``stack.REJECT_COLUMNS``); ``copies`` names a column
    for the rows that each row stands for after C4 (1 elsewhere).
    """
    relabels = dict(study.relabels)
    base = study.base_form
    if base and study.base_label:
        relabels[base] = study.base_label
        base = study.base_label
    obs = stack_forms(
        forms,
        study=study.name,
        exclude=study.exclude,
        drop_as_needed=study.drop_as_needed,
        require_visit_number=study.require_visit_number,
        relabels=relabels,
        extra=extra,
        base_form=study.base_form,
        skip_codes=study.skip_codes,
        rejects=rejects,
    )
    if not study.distinct_keys:
        return obs.withColumn(copies, F.lit(1).cast("bigint")) if copies else obs
    # Base rows and rejected rows keep their repeats: each has a number of its own, in the same pass.
    own = F.col("crf") == F.lit(base)
    if rejects:
        own = own | F.col("reason").isNotNull()
    numbered = obs.withColumn("__own", F.when(own, F.monotonically_increasing_id()))
    return dedupe_form_keys(numbered, numbered.columns, copies).drop("__own")


def split_rejects(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a marked table, written in one pass (rows in = accepted + rejected)."""
    kind = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    table = cut_lineage(marked.withColumn("kind", kind), partition_by=("kind",))
    return accepted(table.where("kind = 'accepted'").drop("kind")), rejected(table.where("kind = 'rejected'"))


def _stacked(forms: DataFrame, study: Study, extra: tuple[str, ...] = (), copies: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The stacked table, written once, and the rejected rows if visit keys came as text."""
    if "reason" in forms.columns or any(t == "string" for c, t in forms.dtypes if c in ("avisitn", "adt")):
        return split_rejects(stack_study(forms, study, extra, rejects=True, copies=copies))
    return cut_lineage(stack_study(forms, study, extra, copies=copies)), None


def flag_study(forms: DataFrame, study: Study) -> dict[str, DataFrame]:
    """Flag outputs of one study: flags, histogram, flagged visit table, residual check, visit modes.

    Where they apply, also the rejected rows, and the visit keys that a form held more than once before C4
    (the scripts' guard). The stacked table and the per-date summary are each read by several
    outputs, so both are written to the checkpoint folder once.
    """
    extra = tuple(c for c in ("hpf", "fpf") if c in forms.columns)
    copies = "n_rows" if study.distinct_keys else None
    obs, rejects = _stacked(forms, study, extra, copies)
    out = {"rejects": rejects} if rejects is not None else {}
    if copies:
        out["duplicates"] = obs.where(F.col(copies) > 1)
        obs = obs.drop(copies)
    summary = cut_lineage(flags.date_summary(obs))
    out |= {
        "flags": flags.multi_date_visits(obs, summary),
        "histogram": flags.span_histogram(obs, study.breaks, summary),
        "visit_dates": flags.visit_dates_flagged(obs, extra, summary),
        "residual": flags.residual_of_dates(summary),
    }
    if "hpf" in extra:
        out["visit_modes"] = flags.visit_mode_summary(obs)
    return out


def repair_study(forms: DataFrame, registration: DataFrame, demographics: DataFrame, study: Study) -> dict[str, DataFrame]:
    """Repair outputs of one study: conflicts for review, clean visits, counts, visit dates with age.

    ``counts`` has the five counts before and after conflicts are resolved (``stage``).
    """
    rejects = None
    if "reason" in forms.columns:
        obs, rejects = _stacked(forms, study)
    else:
        obs = stack_study(forms, study)
    subject_ages = cut_lineage(ages_ops.baseline_age(registration, demographics))
    stacked = ages_ops.subjects_with_age(obs, subject_ages)
    visits = cut_lineage(pipelines.repair_stage(stacked, "snap_to_median"))
    summary = cut_lineage(conflicts.conflict_entries(conflicts.visit_entries(visits)))
    clean = cut_lineage(conflicts.clean_visits(visits, summary, conflicts.resolve_conflicts(summary)))
    out = {
        "ages": subject_ages,
        "conflicts": conflicts.conflict_review(conflicts.conflict_shared_forms(summary)),
        "clean_visits": clean,
        "counts": conflicts.staged_counts(visits, clean),
        "visit_dates": conflicts.visit_dates_with_age(clean, subject_ages),
    }
    return out if rejects is None else out | {"rejects": rejects}


REJECT_ORDER = ("study", "crf", "sjid", "avisit")


def run_flag_study(
    spark: SparkSession,
    folder: str,
    study_name: str,
    out_base: str,
    run_date: dt.date | None = None,
    **load_options,
) -> dict[str, str]:
    """Flag job: publish ``visit.flags.<study>`` and ``visit.dates.<study>`` and, where there are such, rejects and duplicates; returns their paths."""
    study = STUDIES[study_name]
    configure(spark)
    orders = {"flags": ("sjid", "avisitn"), "visit_dates": ("study", "sjid", "avisitn", "adt"), "rejects": REJECT_ORDER, "duplicates": ("sjid", "crf")}
    names = {"flags": "visit.flags", "visit_dates": "visit.dates", "rejects": "visit.rejects", "duplicates": "visit.duplicates"}
    with job_scratch(spark):
        out = flag_study(load_study_forms(spark, folder, study, **load_options), study)
        return {
            k: sinks.write_dated(out[k], f"{out_base}/{names[k]}.{study.name}", run_date, order=order) for k, order in orders.items() if k in out
        }


def run_repair_study(
    spark: SparkSession,
    folder: str,
    study_name: str,
    registration: DataFrame,
    demographics: DataFrame,
    out_base: str,
    run_date: dt.date | None = None,
    **load_options,
) -> dict[str, str]:
    """Repair job: publish visit dates with age, the conflicts for review, the counts and any rejects; returns their paths."""
    study = STUDIES[study_name]
    configure(spark)
    orders = {"visit_dates": ("sjid", "avisitn", "adt_day"), "conflicts": conflicts.REVIEW_ORDER, "counts": (), "rejects": REJECT_ORDER}
    names = {"visit_dates": "visit.dates", "conflicts": "visit.conflicts", "counts": "visit.counts", "rejects": "visit.rejects"}
    with job_scratch(spark):
        out = repair_study(load_study_forms(spark, folder, study, **load_options), registration, demographics, study)
        return {
            k: sinks.write_dated(out[k], f"{out_base}/{names[k]}.{study.name}", run_date, order=order) for k, order in orders.items() if k in out
        }


def normalise_study(spark: SparkSession, folder: str, out_folder: str, suffix: str, fmt: str | None = None, options: Mapping[str, str] | None = None) -> list[str]:
    """Every form of a folder with lower-case columns, written as Parquet and text copies; returns the stored names."""
    source = source_of(None, suffix, fmt, options)
    names = []
    for r in form_manifest(spark, folder, source).orderBy("crf").collect():  # one row per form
        reader = spark.read.format(source.format).options(**source.options).schema(StructType.fromJson(json.loads(r.schema)))
        names.append(sinks.write_normalised(form_io.normalise_columns(reader.load(r.path)), out_folder, r.crf))
    return names
