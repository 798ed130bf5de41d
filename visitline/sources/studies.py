"""Per-study settings of the five studies the rules were written for.

Each study differs only in where its forms come from (file suffix), which
form is the base, which forms have no visit scheme, how rows without a usable
visit are dropped, and the span bins of its histogram.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from visitline.operators.flags import SPAN_BREAKS, SPAN_BREAKS_SHORT
from visitline.sources.forms import FORM_RELABEL


@dataclass(frozen=True)
class Study:
    name: str
    suffix: str
    base_form: str | None
    exclude: tuple[str, ...] = field(default_factory=tuple)
    drop_as_needed: bool = False
    require_visit_number: bool = True
    breaks: tuple[float, ...] = SPAN_BREAKS
    base_label: str | None = None
    # Forms other than the base are reduced to distinct visit-key rows before stacking.
    distinct_keys: bool = False
    # Code lists (``..._codes``) are skipped.
    skip_codes: bool = False
    # File name -> form name.
    relabels: Mapping[str, str] = field(default_factory=dict)
    # Rows of a form that are equal but for visit and date are reduced to the first.
    dedupe_rows: bool = False


# Forms without a visit scheme, per study (case-sensitive names).
CRCSCA_EXCLUDE = (
    "age_at_onset", "conclusionofstudyparticipation", "dsn_names7301", "registration",
    "general_physical_exam", "covid_19_visit_impact_form", "deathrecord", "eligibility",
    "genetic_results", "physician_global_impression", "patient_global_impression",
    "concomitant_meds", "demographics", "demographics_supplement", "medical_history",
    "neurological_exam", "change_of_status",
)
EFACTS_EXCLUDE = ("SARA",)
FACHILD_EXCLUDE = (
    "concl", "conmed", "currcond", "icflog", "random", "famed", "facmstat", "invsig", "visstat",
)
FACOMS_EXCLUDE = (
    "concl", "conmed", "currcond", "icflog", "random", "famed", "facmstat", "famp", "screen",
    "pregoutc", "sig", "visstat", "mhcnsnsus",
)

UNIFAI_EXCLUDE = ("TimeZone", "AE", "MH", "SCO", "mfar")

# Fixture names of forms per study: the base, a relabelled form, a code list and an excluded form among them.
FIXTURE_FORMS = {
    "CRCSCA": {"crf2": "_9hpt", "crf3": "visit_codes", "crf4": "demographics"},
    "EFACTS": {"crf1": "sara", "crf2": "_9hpt", "crf3": "visit_codes", "crf4": "SARA"},
    "FACHILD": {"crf1": "faneuro", "crf2": "_9hpt", "crf3": "visit_codes", "crf4": "conmed"},
    "FACOMS": {"crf1": "faneuro", "crf2": "_9hpt", "crf3": "visit_codes", "crf4": "screen"},
    "UNIFAI": {"crf1": "mfar", "crf2": "_9hpt", "crf3": "visit_codes", "crf4": "AE"},
}

# ``suffix`` is what follows the form name in a study's file names; the binary formats of three studies are converted to Parquet.
STUDIES = {
    "CRCSCA": Study("CRCSCA", ".parquet", None, CRCSCA_EXCLUDE, drop_as_needed=True, require_visit_number=False, relabels=FORM_RELABEL, dedupe_rows=True),
    "EFACTS": Study("EFACTS", "_export8_20220706_temp.csv", "sara", EFACTS_EXCLUDE, skip_codes=True),
    "FACHILD": Study("FACHILD", ".parquet", "faneuro", FACHILD_EXCLUDE, breaks=SPAN_BREAKS_SHORT, relabels=FORM_RELABEL),
    "FACOMS": Study("FACOMS", ".parquet", "faneuro", FACOMS_EXCLUDE, relabels=FORM_RELABEL),
    "UNIFAI": Study("UNIFAI", ".txt", "mfar", UNIFAI_EXCLUDE, base_label="fars", distinct_keys=True, skip_codes=True),
}
