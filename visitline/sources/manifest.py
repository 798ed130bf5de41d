"""Form manifest: what a study folder holds, one row per form.

A form is a file, or a folder of part files, named after it (``forms.form_of_path``). The manifest has its files,
format, columns with types and number of rows, so the catalogue rules, the key check, the skipping of empty forms and
the readers' schemas all come from one small table, and forms of equal columns can be read in one scan.

Listing and counting are one Spark job each, over all forms: file names and sizes only, then footers (Parquet) or
lines (text). A form's columns come from one of its footers or header lines, read by a Spark job of its own; these
jobs run side by side, and only for forms that are new or changed since a stored manifest (same number
of files, bytes and last change: not read again).
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitline.sources.forms import form_of_path, in_scope
from visitline.sources.sinks import exists, publish
from visitline.sources.studies import Study

MANIFEST_SCHEMA = (
    "crf string, path string, format string, files bigint, bytes bigint, modified timestamp, rows bigint, "
    "columns array<struct<name:string,type:string>>, schema string"
)
#: Forms whose columns are read at the same time.
READERS = 16

# How files of an ending are read (formats of the study folders).
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    ".parquet": ("parquet", {}),
    ".csv": ("csv", {"header": "true"}),
    ".txt": ("csv", {"header": "true", "sep": "\t"}),
}


class Source(NamedTuple):
    """How the files of a folder are named and read."""

    suffix: str
    format: str
    options: dict[str, str]


def source_of(study: Study | None = None, suffix: str | None = None, fmt: str | None = None, options: Mapping[str, str] | None = None) -> Source:
    """The study's file ending, and format and options by that ending, unless given."""
    suffix = (study.suffix if study else ".parquet") if suffix is None else suffix
    by_ending = next((v for k, v in FORMATS.items() if suffix.endswith(k)), None)
    if fmt is None and by_ending is None:
        raise ValueError(f"no known format for files ending in {suffix!r}: give one")
    if fmt is None or (by_ending and fmt == by_ending[0]):
        return Source(suffix, by_ending[0], {**by_ending[1], **(options or {})})
    return Source(suffix, fmt, dict(options or {}))


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``crf, path, files, bytes, modified`` of every form: a listing, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    named = found.select(form_of_path("path", folder, suffix).alias("crf"), "length", "modificationTime").where("crf is not null")
    forms = named.groupBy("crf").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
    )
    return forms.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("crf"), F.lit(suffix)))


def count_rows(spark: SparkSession, folder: str, source: Source, paths: list[str]) -> DataFrame:
    """``crf, rows`` of the forms at ``paths`` in one job; of Parquet files only the footers are read."""
    schema = StructType([]) if source.format == "parquet" else "first string"
    files = spark.read.format(source.format).options(**source.options).schema(schema).load(paths)
    by_file = files.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return by_file.groupBy(form_of_path("path", folder, source.suffix).alias("crf")).agg(F.sum("rows").alias("rows"))


def _schemas(spark: SparkSession, source: Source, paths: list[str]) -> list[StructType]:
    """The columns of each form; a form without a column (an empty text file) has none."""

    def read(path: str) -> StructType:
        return spark.read.format(source.format).options(**source.options).load(path).schema

    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(read, paths))


def form_manifest(spark: SparkSession, folder: str, source: Source, store: str | None = None) -> DataFrame:
    """The manifest of ``folder`` (``MANIFEST_SCHEMA``); with ``store`` it is kept there and only changes are read."""
    known = {}
    if store and exists(spark, store):
        known = {(r.crf, r.path, r.format, r.files, r.bytes, r.modified): r for r in spark.read.schema(MANIFEST_SCHEMA).parquet(store).collect()}
    rows, new = [], []
    for r in sorted(list_files(spark, folder, source.suffix).collect(), key=lambda r: r.crf):  # one row per form
        old = known.get((r.crf, r.path, source.format, r.files, r.bytes, r.modified))
        if old:
            rows.append(tuple(old))
        else:
            new.append(r)
    if new:
        paths = [r.path for r in new]
        counts = {r.crf: r.rows for r in count_rows(spark, folder, source, paths).collect()}
        for r, schema in zip(new, _schemas(spark, source, paths), strict=True):
            columns = [(f.name, f.dataType.simpleString()) for f in schema]
            rows.append((r.crf, r.path, source.format, r.files, r.bytes, r.modified, counts.get(r.crf, 0), columns, schema.json()))
    manifest = spark.createDataFrame(sorted(rows), MANIFEST_SCHEMA)
    if store and (new or len(rows) != len(known)):
        publish(lambda path: manifest.coalesce(1).write.parquet(path), spark, store)
    return manifest


def form_scope(manifest: DataFrame, study: Study, required: tuple[str, ...] = ("sjid", "avisit")) -> DataFrame:
    """The manifest with ``base``, ``used`` and, for forms that aren't used, the ``reason``.

    The base form is found by name, in another letter case if need be, and is used even where its own file is
    excluded. Forms without the ``required`` columns (in any letter case) have no visit scheme; forms without rows add nothing.
    """
    base = F.lit(False)
    if study.base_form:
        alike = manifest.where(F.lower("crf") == study.base_form.lower())
        name = alike.agg(F.max(F.when(F.col("crf") == study.base_form, F.col("crf"))).alias("exact"), F.min("crf").alias("any")).first()
        base = F.col("crf").eqNullSafe(F.lit(name["exact"] or name["any"]))
    names_of = F.transform("columns", lambda c: F.lower(c["name"]))
    keys = F.size(F.array_intersect(names_of, F.array(*[F.lit(c) for c in required]))) == len(required)
    out = manifest.withColumn("base", base)
    reason = (
        F.when(~F.col("base") & ~in_scope("crf", study.exclude), "excluded")
        .when(~F.col("base") & ~in_scope("crf", (), study.skip_codes), "code list")
        .when(~keys, "no visit keys")
        .when(F.col("rows") == 0, "empty")
    )
    out = out.withColumn("reason", reason).withColumn("used", F.col("reason").isNull())
    return out.select(*manifest.columns, "base", "used", "reason")
