"""Study folders in their own formats: manifest, one scan per column list, rejected rows, guards."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from study_helpers import day

from visitline.plans import jobs
from visitline.sources import manifest
from visitline.sources.studies import STUDIES


def put(folder, name, **cols):
    pq.write_table(pa.table(cols), str(folder / name))


def text(folder, name, header, *rows, sep="\t"):
    (folder / name).write_text("\n".join(sep.join(r) for r in (header, *rows)) + "\n")


HEAD = ("SJID", "AVISIT", "AVISITN", "ADT")


def test_sources_follow_the_file_ending():
    of = lambda **kw: tuple(manifest.source_of(**kw))
    assert of(study=STUDIES["FACOMS"]) == (".parquet", "parquet", {})
    assert of(study=STUDIES["EFACTS"])[1:] == ("csv", {"header": "true"})
    assert of(study=STUDIES["UNIFAI"])[1:] == ("csv", {"header": "true", "sep": "\t"})
    assert of(study=STUDIES["UNIFAI"], suffix=".parquet")[1:] == ("parquet", {})
    assert of(suffix=".txt", options={"sep": ";"})[2] == {"header": "true", "sep": ";"}
    assert of(suffix=".dat", fmt="csv") == (".dat", "csv", {})
    with pytest.raises(ValueError, match="no known format"):
        manifest.source_of(suffix=".dat")


def test_manifest_of_a_folder(spark, tmp_path):
    folder = tmp_path / "EFACTS"
    folder.mkdir()
    end = STUDIES["EFACTS"].suffix
    text(folder, f"sara{end}", HEAD, ("1", "V1", "1", "2020-01-01"), ("1", "V2", "", "2020-01-02"), sep=",")
    text(folder, f"SARA{end}", HEAD, ("1", "V1", "1", "2020-01-01"), sep=",")
    text(folder, f"adl_codes{end}", HEAD, ("1", "V1", "1", "2020-01-01"), sep=",")
    text(folder, f"sites{end}", ("NAME", "SJID"), ("a", "1"), sep=",")
    text(folder, f"later{end}", HEAD, sep=",")
    (folder / "notes.txt").write_text("not a form")
    parts = folder / f"fars{end}"
    parts.mkdir()
    for i in range(3):
        text(parts, f"part-{i}.csv", HEAD, (str(i), "V1", "1", "2020-01-01"), sep=",")
    found = manifest.form_manifest(spark, str(folder), manifest.source_of(STUDIES["EFACTS"]))
    rows = {r.crf: r for r in manifest.form_scope(found, STUDIES["EFACTS"]).collect()}
    assert {n: (r.rows, r.files, r.reason, r.base) for n, r in rows.items()} == {
        "sara": (2, 1, None, True),
        "SARA": (1, 1, "excluded", False),
        "adl_codes": (1, 1, "code list", False),
        "sites": (1, 1, "no visit keys", False),
        "later": (0, 1, "empty", False),
        "fars": (3, 3, None, False),
    }
    assert [(c.name, c.type) for c in rows["sites"].columns] == [("NAME", "string"), ("SJID", "string")]
    assert all(r.used == (r.reason is None) and r.format == "csv" and r.bytes > 0 for r in rows.values())


def test_stored_manifest_reads_only_changes(spark, tmp_path, monkeypatch):
    folder = tmp_path / "FACOMS"
    folder.mkdir()
    source, store = manifest.source_of(STUDIES["FACOMS"]), str(tmp_path / "kept" / "manifest")
    put(folder, "faneuro.parquet", SJID=[1], AVISIT=["V1"])
    put(folder, "sara.parquet", SJID=[1, 2], AVISIT=["V1", "V1"])
    asked = []
    read = manifest._schemas
    monkeypatch.setattr(manifest, "_schemas", lambda s, o, paths: asked.append(sorted(Path(p).name for p in paths)) or read(s, o, paths))
    ask = lambda: {r.crf: r.rows for r in manifest.form_manifest(spark, str(folder), source, store).collect()}
    assert ask() == {"faneuro": 1, "sara": 2}
    assert ask() == {"faneuro": 1, "sara": 2}
    put(folder, "sara.parquet", SJID=[1, 2, 3], AVISIT=["V1"] * 3, EXTRA=["x"] * 3)
    put(folder, "new.parquet", SJID=[1], AVISIT=["V1"])
    assert ask() == {"faneuro": 1, "sara": 3, "new": 1}
    (folder / "faneuro.parquet").unlink()
    assert ask() == {"sara": 3, "new": 1}
    assert asked == [["faneuro.parquet", "sara.parquet"], ["new.parquet", "sara.parquet"]]
    assert {r.crf for r in spark.read.parquet(store).collect()} == {"sara", "new"}


def test_forms_of_equal_columns_are_one_scan(spark, tmp_path):
    folder = tmp_path / "FACHILD"
    folder.mkdir()
    for i in range(30):
        put(folder, f"form{i}.parquet", SJID=[i], AVISIT=["V1"], AVISITN=[1.0], ADT=[day(i)], SCORE=[0.5])
    put(folder, "faneuro.parquet", SJID=[1], AVISIT=["V1"], AVISITN=[None], ADT=[day(0)])
    put(folder, "text_ids.parquet", SJID=["x"], AVISIT=["V1"], AVISITN=["2"], ADT=["2020-01-09"], HPF=["home"])
    forms = jobs.load_study_forms(spark, str(folder), STUDIES["FACHILD"])
    scans = forms._jdf.queryExecution().optimizedPlan().toString().count("Relation ")
    assert scans == 3
    got = {(r.crf, r.sjid, r.avisitn, r.adt, r.hpf) for r in forms.collect()}
    # Subjects are text in one form, so in all.
    assert got == {(f"form{i}", str(i), 1.0, day(i), None) for i in range(30)} | {("faneuro", "1", None, day(0), None), ("text_ids", "x", 2.0, day(8), "home")}


def test_every_study_loads_with_its_defaults(spark, tmp_path):
    for name, study in STUDIES.items():
        folder = tmp_path / name
        folder.mkdir()
        base = study.base_form or "sara"
        if study.suffix == ".parquet":
            put(folder, f"{base}.parquet", SJID=[1], AVISIT=["V1"], AVISITN=["1"], ADT=[day(0)])
            put(folder, "fars.parquet", SJID=[1], AVISIT=["V1"], AVISITN=["1"], ADT=[day(50)])
        else:
            sep = "\t" if study.suffix == ".txt" else ","
            for form, date in ((base, "2020-01-01"), ("ataxia", "2020-02-20")):
                text(folder, form + study.suffix, HEAD, ("1", "V1", "1", date), sep=sep)
        if study.base_form:
            paths = jobs.run_flag_study(spark, str(folder), name, str(tmp_path / "out"), dt.date(2026, 1, 2))
            assert [r.diff for r in spark.read.parquet(paths["flags"]).collect()] == [50, 50], name
        else:
            rows = jobs.stack_study(jobs.load_study_forms(spark, str(folder), study), study).collect()
            assert sorted((r.crf, r.avisitn) for r in rows) == [("fars", 1.0), ("sara", 1.0)]


def test_rejected_rows_of_a_job(spark, tmp_path):
    """Rows in = rows out + rejects; blank visit numbers are dropped by rule, repeats are counted."""
    folder = tmp_path / "UNIFAI"
    folder.mkdir()
    text(folder, "mfar.txt", HEAD, ("1", "V1", "1", "2020-01-01"), ("1", "V1", "1", "2020-01-01"), ("1", "V2", "?", "2020-01-05"))
    text(
        folder, "ataxia.txt", HEAD,
        ("1", "V1", "1", "2020-01-01"), ("1", "V1", "1", "2020-01-01"), ("1", "V2", "2a", "2020-01-05"), ("1", "V3", " ", "2020-01-05"),
        ("1", "V4", "4", "05.01.2020"), ("1", "V4", "4", "05.01.2020"), ("2", "V1", "1", ""),
    )
    paths = jobs.run_flag_study(spark, str(folder), "UNIFAI", str(tmp_path / "out"), dt.date(2026, 1, 2))
    rows = [(r.crf, r.sjid, r.avisit, r.adt) for r in spark.read.parquet(paths["visit_dates"]).collect()]
    assert sorted(rows, key=str) == sorted([("fars", "1", "V1", day(0))] * 2 + [("ataxia", "1", "V1", day(0)), ("ataxia", "2", "V1", None)], key=str)
    rejects = sorted(map(tuple, spark.read.parquet(paths["rejects"]).collect()))
    assert rejects == [
        ("UNIFAI", "ataxia", "1", "V2", "2a", "2020-01-05", "visit number"),
        ("UNIFAI", "ataxia", "1", "V4", "4", "05.01.2020", "date"),
        ("UNIFAI", "ataxia", "1", "V4", "4", "05.01.2020", "date"),
        ("UNIFAI", "fars", "1", "V2", "?", "2020-01-05", "visit number"),
    ]
    copies = [(r.crf, r.sjid, r.n_rows) for r in spark.read.parquet(paths["duplicates"]).collect()]
    assert copies == [("ataxia", "1", 2)]
    # 10 rows in the files, one without a visit number; one row is a second copy.
    assert 10 == 1 + len(rows) + len(rejects) + sum(n - 1 for *_, n in copies)


def cells(folder, values, numbers=("1", "1")):
    put(folder, "faneuro.parquet", SJID=[1], AVISIT=["V1"], AVISITN=["1"], ADT=[day(0)])
    put(folder, "clat1.parquet", SJID=[7, 7], AVISIT=["V1", "V1"], AVISITN=list(numbers), ADT=[day(0), day(0)],
        ACUITY=["100", "100"], OU100_1=values, OD100_1=[1.0, 2.0], OS100_2=[3.0, 4.0])


def test_second_row_of_a_cell_fails_the_job(spark, tmp_path):
    """The reshape's check reaches the stacked table, whose columns are only the visit keys."""
    folder = tmp_path / "FACOMS"
    folder.mkdir()
    cells(folder, [0.5, 0.6])
    forms = jobs.load_study_forms(spark, str(folder), STUDIES["FACOMS"])
    with pytest.raises(Exception, match="several rows for one cell of sjid=7, avisit=V1, avisitn=1, adt=2020-01-01, crf=clat1, acuity=100"):
        forms.count()
    with pytest.raises(Exception, match="several rows for one cell"):
        jobs.run_flag_study(spark, str(folder), "FACOMS", str(tmp_path / "out"), dt.date(2026, 1, 2))
    assert not (tmp_path / "out" / "visit.flags.FACOMS" / "run_date=2026-01-02").exists()
    # Rows without a visit number are dropped before the reshape, as in the scripts.
    cells(folder, [0.5, 0.6], ("", ""))
    assert [r.crf for r in jobs.load_study_forms(spark, str(folder), STUDIES["FACOMS"]).collect()] == ["faneuro"]
    cells(folder, [0.5, 0.6], ("1", "2"))
    assert sorted(r.crf for r in jobs.load_study_forms(spark, str(folder), STUDIES["FACOMS"]).collect()) == ["clat1", "clat1", "faneuro"]


def test_reshape_needs_no_pass_of_its_own(spark, tmp_path):
    """Loading plans the reshaped form without a job over its rows (finding the wide columns would be one)."""
    folder = tmp_path / "FACOMS"
    folder.mkdir()
    cells(folder, [0.5, 0.6], ("1", "2"))
    plan = jobs.load_study_forms(spark, str(folder), STUDIES["FACOMS"])._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" in plan and "pivotfirst" not in plan.lower()
