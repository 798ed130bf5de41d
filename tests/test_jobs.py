"""Study jobs end to end on small form folders (flat parquet files, as converted datasets land)."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from study_helpers import day

from pyspark.sql import functions as F

from visitline.plans import jobs
from visitline.session import checkpoint_dir
from visitline.sources.studies import STUDIES


def put(folder, name, **cols):
    pq.write_table(pa.table(cols), str(folder / f"{name}.parquet"))


def test_flag_job_writes_flags_and_visit_dates(spark, tmp_path):
    folder = tmp_path / "FACOMS"
    folder.mkdir()
    put(folder, "faneuro", SJID=[1, 1, 2], AVISIT=["V1", "V1", "V1"], AVISITN=["1", "1", "1"], ADT=[day(0), day(40), day(3)])
    put(folder, "clat1", SJID=[1, 1], AVISIT=["V1", "V1"], AVISITN=["1", "1"], ADT=[day(0), day(0)],
        ACUITY=["100", "125"], OU100_1=[0.5, 0.6], OD100_1=[1.0, 2.0], OS100_2=[3.0, 4.0])
    put(folder, "mhxgen", SJID=[2, 2, 2], AVISIT=["V1"] * 3, AVISITN=["1"] * 3, ADT=[day(3)] * 3, TERM=["a", "b", "c"])
    put(folder, "conmed", SJID=[1], AVISIT=["V1"], AVISITN=["1"], ADT=[day(9)])  # excluded
    put(folder, "random", NOTE=["no visit columns"])  # excluded and has no keys
    paths = jobs.run_flag_study(spark, str(folder), "FACOMS", str(tmp_path / "out"), dt.date(2026, 1, 2))
    flags = spark.read.parquet(paths["flags"]).collect()
    assert sorted((r.sjid, r.adt, r.diff, r.n) for r in flags) == [(1, day(0), 40, 2), (1, day(40), 40, 1)]
    dates = spark.read.parquet(paths["visit_dates"]).collect()
    # clat1's two acuity rows became one row; mhxgen's three rows became one.
    assert sorted(r.crf for r in dates) == ["clat1", "faneuro", "faneuro", "faneuro", "mhxgen"]
    assert {r.study for r in dates} == {"FACOMS"}
    assert {(r.sjid, r.n) for r in dates} == {(1, "2, 1"), (2, None)}


def test_repair_job_writes_visit_dates_with_age(spark, tmp_path):
    folder = tmp_path / "CRCSCA"
    folder.mkdir()
    put(folder, "sara", SJID=[1, 1, 1], AVISIT=["BL", "V1", "PRN"], AVISITN=[0.0, 1.0, 2.0], ADT=[day(0), day(100), day(150)], SCORE=[5.0, 6.0, 7.0])
    # The "_9hpt" form is stored as "nhpt" (Spark never reads files named "_...").
    put(folder, "nhpt", SJID=[1, 1], AVISIT=["BL", "V1"], AVISITN=[0.0, 1.0], ADT=[day(4), day(100)], TIME=[9.0, 8.0])
    put(folder, "registration", SJID=[1], AVISIT=["BL"], AVISITN=[0.0], ADT=[day(0)])  # excluded form
    reg = spark.createDataFrame([("CRCSCA", 1, 30.0, None)], "study string, sjid long, start_age double, registration_age double")
    dem = spark.createDataFrame([(1, 29.0, "1/1/2020")], "sjid long, ageatregistration double, dm_date string")
    path = jobs.run_repair_study(spark, str(folder), "CRCSCA", reg, dem, str(tmp_path / "out"), dt.date(2026, 1, 2))["visit_dates"]
    got = sorted((r.avisitn, r.adt, round(r.age, 4)) for r in spark.read.parquet(path).collect())
    # Baseline dates 4 days apart snap to their median; PRN is dropped; age grows from 30.
    assert got == [(0.0, day(2), 30.0), (1.0, day(100), round(30 + 98 / 365.25, 4))]


def test_study_settings_are_complete():
    assert set(STUDIES) == {"CRCSCA", "EFACTS", "FACHILD", "FACOMS", "UNIFAI"}
    assert STUDIES["FACHILD"].breaks[-1] == 3000
    assert {"TimeZone", "AE", "MH", "SCO"} <= set(STUDIES["UNIFAI"].exclude)
    assert {n for n, s in STUDIES.items() if s.skip_codes} == {"EFACTS", "UNIFAI"}
    assert {n for n, s in STUDIES.items() if s.relabels} == {"CRCSCA", "FACHILD", "FACOMS"}
    assert all(s.exclude for s in STUDIES.values())


def test_base_form_is_loaded_by_name_and_unfiltered(spark, tmp_path):
    """UNIFAI: the base file is excluded as a form but loaded as base, keeps rows without a visit number and is relabelled."""
    folder = tmp_path / "UNIFAI"
    folder.mkdir()
    put(folder, "mfar", SJID=[1, 1], AVISIT=["V1", "Unscheduled"], AVISITN=["1", ""], ADT=[day(0), day(5)], SCORE=[1.0, 2.0])
    put(folder, "ataxia", SJID=[1, 1], AVISIT=["V1", "V2"], AVISITN=[1.0, None], ADT=[day(0), day(9)], SCORE=["a", "b"])  # unlike types
    for name in ("AE", "MH", "SCO", "TimeZone", "ataxia_codes"):
        put(folder, name, SJID=[1], AVISIT=["V1"], AVISITN=["1"], ADT=[day(90)])
    study = STUDIES["UNIFAI"]
    rows = jobs.stack_study(jobs.load_study_forms(spark, str(folder), study, suffix=".parquet"), study).collect()
    assert sorted((r.crf, r.avisit) for r in rows) == [("ataxia", "V1"), ("fars", "Unscheduled"), ("fars", "V1")]


def test_repair_job_counts_before_and_after_resolution(spark, tmp_path):
    folder = tmp_path / "CRCSCA"
    folder.mkdir()
    # Visit 1 has two dates, 100 days apart: the one with more forms stays.
    for name, dates in (("sara", [day(0), day(100)]), ("fars", [day(0), None])):
        put(folder, name, SJID=[1, 1], AVISIT=["V1", "V1b"], AVISITN=[1.0, 1.0], ADT=dates, X=[name, name + "2"])
    put(folder, "extra", SJID=[1], AVISIT=["V1"], AVISITN=[1.0], ADT=[day(100)], X=["e"])
    reg = spark.createDataFrame([("CRCSCA", 1, 30.0, None)], "study string, sjid long, start_age double, registration_age double")
    dem = spark.createDataFrame([(1, 29.0, "1/1/2020")], "sjid long, ageatregistration double, dm_date string")
    out = jobs.run_repair_study(spark, str(folder), "CRCSCA", reg, dem, str(tmp_path / "out"), dt.date(2026, 1, 2))
    counts = {r.stage: (r.total_rows, r.unique_dates) for r in spark.read.parquet(out["counts"]).collect()}
    assert counts == {"repaired": (3, 2), "resolved": (1, 1)}


def test_normalised_folder_feeds_the_jobs(spark, tmp_path):
    """A study folder is normalised, and the flag and repair jobs read what was written (folders of part files)."""
    raw, clean = tmp_path / "raw", tmp_path / "clean"
    raw.mkdir()
    put(raw, "sara", SJID=[1, 1, 1], AVISIT=["BL", "V1", "V2"], AVISITN=[0.0, 1.0, 2.0], ADT=[day(0), day(100), day(130)], X=["p", "q", "q"])
    put(raw, "nhpt", SJID=[1, 1], AVISIT=["BL", "V1"], AVISITN=[0.0, 1.0], ADT=[day(4), day(100)], X=["r", "s"])
    assert jobs.normalise_study(spark, str(raw), str(clean), ".parquet") == ["nhpt", "sara"]
    study = STUDIES["CRCSCA"]
    loaded = jobs.load_study_forms(spark, str(clean), study)
    # The second "q" row of sara repeats the first one's content: the earliest date stays.
    assert sorted((r.crf, r.avisit) for r in loaded.collect()) == [("nhpt", "BL"), ("nhpt", "V1"), ("sara", "BL"), ("sara", "V1")]
    scratch = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(scratch.iterdir())
    flags = jobs.run_flag_study(spark, str(clean), "CRCSCA", str(tmp_path / "out"), dt.date(2026, 1, 2))
    assert spark.read.parquet(flags["flags"]).count() == 2
    reg = spark.createDataFrame([("CRCSCA", 1, 30.0, None)], "study string, sjid long, start_age double, registration_age double")
    dem = spark.createDataFrame([(1, 29.0, "1/1/2020")], "sjid long, ageatregistration double, dm_date string")
    out = jobs.run_repair_study(spark, str(clean), "CRCSCA", reg, dem, str(tmp_path / "out2"), dt.date(2026, 1, 2))
    assert {k: spark.read.parquet(p).count() for k, p in out.items()} == {"visit_dates": 2, "conflicts": 0, "counts": 2}
    assert set(scratch.iterdir()) == before  # the jobs remove what they cut


def test_known_age_wins_a_tie(spark):
    from visitline.operators.ages import baseline_age

    reg = spark.createDataFrame([("S", 1, None, 30.0), ("S", 1, 28.0, None)], "study string, sjid long, start_age double, registration_age double")
    dem = spark.createDataFrame([(1, 29.0, "1/1/2020")], "sjid long, ageatregistration double, dm_date string")
    assert [r.start_age for r in baseline_age(reg, dem).collect()] == [28.0]


def test_partition_sizing_has_no_upper_cap():
    from visitline.session import scale_conf

    assert scale_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == str(100 * 2**40 // 2**28)


def test_distinct_key_study_keeps_base_rows(spark):
    forms = spark.createDataFrame(
        [(1, "V1", 1.0, day(0), "mfar")] * 2 + [(1, "V1", 1.0, day(0), "ataxia")] * 3,
        "sjid long, avisit string, avisitn double, adt date, crf string",
    ).withColumn("study", F.lit("x"))
    out = jobs.stack_study(forms, STUDIES["UNIFAI"]).collect()
    assert sorted(r.crf for r in out) == ["ataxia", "fars", "fars"]
