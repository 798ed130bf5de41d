"""Form folders, catalogue, stacking, sinks and the streaming form source."""

from __future__ import annotations

import datetime as dt

import pytest
from study_helpers import day

from pyspark.sql import functions as F

from visitline.operators import stack
from visitline.sources import forms, sinks
from visitline.sources.studies import STUDIES


def write_form(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / name))


def form_folder(spark, tmp_path):
    folder = tmp_path / "study"
    folder.mkdir()
    # Upper-case columns, as the converted datasets arrive; one form has an extra column.
    schema = "SJID long, AVISIT string, AVISITN string, ADT date"
    write_form(spark, folder, "sara.parquet", [(1, "Baseline", "0", day(0)), (1, "PRN", "3", day(9))], schema)
    write_form(spark, folder, "SARA.parquet", [(1, "Baseline", "0", day(1))], schema)
    write_form(spark, folder, "_9hpt.parquet", [(1, "Visit 1", "1", day(40)), (1, "Visit 1", " ", day(41))], schema)
    write_form(spark, folder, "adl_codes.parquet", [(9, "x", "1", day(0))], schema)
    write_form(
        spark,
        folder,
        "clat1.parquet",
        [(1, "Visit 1", "1", day(40), "100", 0.5)],
        "SJID long, AVISIT string, AVISITN string, ADT date, ACUITY string, OU100_1 double",
    )
    return folder


def test_normalise_lowercases_names(spark):
    df = spark.createDataFrame([(1, 2)], "AbC long, XYZ long")
    assert forms.normalise_columns(df).columns == ["abc", "xyz"]


def test_catalogue_of_a_folder(spark, tmp_path):
    folder = form_folder(spark, tmp_path)
    # Forms are folders of part files here (Spark never lists names starting with "_").
    listed = forms.list_form_files(spark, str(folder), ".parquet", exclude=STUDIES["EFACTS"].exclude, skip_codes=True).collect()
    assert sorted((r.crf, r.path) for r in listed) == [(n, f"{folder}/{n}.parquet") for n in ("clat1", "sara")]
    everything = forms.list_form_files(spark, str(folder), ".parquet").collect()
    assert {r.crf for r in everything} == {"SARA", "adl_codes", "clat1", "sara"}
    assert {r.crf for r in forms.load_forms(spark, str(folder), exclude=("SARA",)).select("crf").distinct().collect()} == {"adl_codes", "clat1", "sara"}


def test_load_and_stack_forms(spark, tmp_path):
    folder = form_folder(spark, tmp_path)
    loaded = forms.union_forms(
        {name: spark.read.parquet(str(folder / f"{name}.parquet")) for name in ("sara", "SARA", "_9hpt", "adl_codes", "clat1")}
    )
    assert "ou100_1" in loaded.columns and "sjid" in loaded.columns
    efacts = STUDIES["EFACTS"]
    out = stack.stack_forms(
        loaded.withColumn("study", loaded.sjid.cast("string")),
        study=efacts.name,
        exclude=efacts.exclude,
        skip_codes=efacts.skip_codes,
        require_visit_number=efacts.require_visit_number,
    ).collect()
    got = sorted((r.crf, r.avisit, r.avisitn, r.study) for r in out)
    assert got == [
        ("clat1", "Visit 1", 1.0, "EFACTS"),
        ("nhpt", "Visit 1", 1.0, "EFACTS"),  # relabelled; the blank visit number is dropped
        ("sara", "Baseline", 0.0, "EFACTS"),  # SARA (upper case) is excluded, sara is not
        ("sara", "PRN", 3.0, "EFACTS"),
    ]
    crcsca = stack.stack_forms(loaded.withColumn("study", loaded.sjid.cast("string")), drop_as_needed=True)
    assert "PRN" not in {r.avisit for r in crcsca.collect()}


def test_load_forms_single_scan(spark, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    for name, extra in (("sara", 1.0), ("fars_codes", 2.0)):
        spark.createDataFrame([(1, "Visit 1", 1.0, day(0), extra)], "SJID long, AVISIT string, AVISITN double, ADT date, X double").coalesce(
            1
        ).write.parquet(str(tmp_path / "tmp" / name))
        part = next((tmp_path / "tmp" / name).glob("part-*.parquet"))
        part.rename(folder / f"{name}.parquet")
    df = forms.load_forms(spark, str(folder), skip_codes=True)
    assert {r.crf for r in df.collect()} == {"sara"}
    assert "avisitn" in df.columns


def test_pivot_and_key_guard(spark):
    form = spark.createDataFrame(
        [(1, "V1", "100", 0.5, 9.0), (1, "V1", "125", 0.7, 9.0), (2, "V1", "100", 0.4, 9.0)],
        "sjid long, avisit string, acuity string, ou100_1 double, od100_1 double",
    )
    wide = stack.pivot_form(form, ["sjid", "avisit"], "acuity", "ou100_1", values=["100", "125"], drop=["od100_1"])
    assert sorted(map(tuple, wide.collect())) == [(1, "V1", 0.5, 0.7), (2, "V1", 0.4, None)]
    twice = form.union(form.limit(1).withColumn("ou100_1", F.lit(0.9)))
    with pytest.raises(Exception, match="several rows for one cell of sjid=1, avisit=V1"):
        stack.pivot_form(twice, ["sjid", "avisit"], "acuity", "ou100_1", values=["100", "125"], drop=["od100_1"]).collect()
    assert stack.duplicate_key_rows(form, ["sjid", "avisit", "acuity"]).count() == 0
    assert stack.duplicate_key_rows(form, ["sjid", "avisit"]).count() == 1


def test_dedupe_form_rows_keeps_earliest(spark):
    form = spark.createDataFrame(
        [("S", 1, "V2", 2.0, day(5), 7.0), ("S", 1, "V1", 1.0, day(0), 7.0), ("S", 1, "V1", 1.0, None, 8.0)],
        "study string, sjid long, avisit string, avisitn double, adt date, score double",
    )
    got = sorted(map(tuple, stack.dedupe_form_rows(form).collect()), key=lambda r: r[-1])
    assert got == [("S", 1, "V1", 1.0, day(0), 7.0), ("S", 1, "V1", 1.0, None, 8.0)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S", 1, 2.0)], "study string, sjid long, avisitn double")
    assert sinks.write_normalised(df, str(tmp_path), "form") == "form"
    assert sinks.write_normalised(df.toDF("STUDY", "SJID", "AVISITN"), str(tmp_path), "_9hpt") == "nhpt"
    assert spark.read.parquet(str(tmp_path / "nhpt.parquet")).columns == ["study", "sjid", "avisitn"]
    assert spark.read.parquet(str(tmp_path / "form.parquet")).count() == 1
    text = spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "form.txt"))
    assert text.columns == ["study", "sjid", "avisitn"]
    path = sinks.write_dated(df, str(tmp_path / "visit.dates"), dt.date(2026, 1, 2), partition_by=("study",))
    assert path.endswith("run_date=2026-01-02")
    back = spark.read.parquet(str(tmp_path / "visit.dates"))
    assert {(r.study, str(r.run_date)) for r in back.collect()} == {("S", "2026-01-02")}


def test_stream_forms(spark, tmp_path):
    from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

    from visitline.streaming import stream_forms

    folder = tmp_path / "landing"
    folder.mkdir()
    spark.createDataFrame([(1, "Visit 1", 1.0, day(0), "S")], "SJID long, AVISIT string, AVISITN double, ADT date, STUDY string").coalesce(
        1
    ).write.parquet(str(tmp_path / "tmp"))
    next((tmp_path / "tmp").glob("part-*.parquet")).rename(folder / "sara.parquet")
    schema = StructType(
        [
            StructField("SJID", LongType()),
            StructField("AVISIT", StringType()),
            StructField("AVISITN", DoubleType()),
            StructField("ADT", DateType()),
            StructField("STUDY", StringType()),
        ]
    )
    stream = stream_forms(spark, str(folder), schema)
    seen = []
    q = (
        stream.writeStream.foreachBatch(lambda b, _: seen.extend(b.collect()))
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    assert [(r.crf, r.sjid, r.avisitn) for r in seen] == [("sara", 1, 1.0)]


def test_load_form_by_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"SJID": [1], "AVISIT": ["V1"], "AVISITN": [1.0], "ADT": [day(0)]}), str(tmp_path / "fars.parquet"))
    df = forms.load_form(spark, str(tmp_path), "fars")
    assert df.columns == ["sjid", "avisit", "avisitn", "adt", "crf"]
    assert [r.crf for r in df.collect()] == ["fars"]


def test_text_sources_parse_visit_numbers_and_dates(spark):
    forms = spark.createDataFrame(
        [
            ("S", 1, "V1", " 1 ", "2020-01-05", "a"), ("S", 1, "V2", "", "2020-02-01", "a"), ("S", 1, "V3", "3", " ", "a"), ("S", 1, "V4", "1a", "2020-01-06", "a"),
            ("S", 1, "V5", "5", "n/a", "a"), ("S", 1, "V6", "x", "y", "base"), ("S", 1, "V7", None, None, "base"), ("S", 1, "V8", None, "2020-01-05", "a"),
        ],
        "study string, sjid long, avisit string, avisitn string, adt string, crf string",
    )
    options = {"require_visit_number": True, "base_form": "base"}
    out = sorted(map(tuple, stack.stack_forms(forms, **options).collect()), key=repr)
    assert out == [("S", 1, "V1", 1.0, "a", day(4)), ("S", 1, "V3", 3.0, "a", None), ("S", 1, "V7", None, "base", None)]
    # What can't be read is rejected, not dropped: rows with a visit number = stacked rows + rejected rows.
    marked = stack.stack_forms(forms, rejects=True, **options)
    assert sorted(map(tuple, stack.accepted(marked).collect()), key=repr) == out
    assert sorted(map(tuple, stack.rejected(marked).collect())) == [
        ("S", "a", 1, "V4", "1a", "2020-01-06", "visit number"),
        ("S", "a", 1, "V5", "5", "n/a", "date"),
        ("S", "base", 1, "V6", "x", "y", "visit number, date"),
    ]
    # Without the rule a blank number stays, and an unreadable one is rejected all the same.
    assert {r.avisit for r in stack.stack_forms(forms).collect()} == {"V1", "V2", "V3", "V7", "V8"}
