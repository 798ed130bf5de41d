"""Form catalogue, form loading and column normalisation.

A study arrives as a folder of forms. The scripts list the folder, drop code
lists and non-visit forms, load each remaining form, tag its rows with the form
name and append them one by one. Here a form is a file or a folder of part
files: its name is the first path segment below the study folder.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VISIT_KEYS = ("study", "sjid", "avisit", "avisitn", "crf", "adt")

# Form relabels used by the studies (file name -> form name).
FORM_RELABEL = {"_9hpt": "nhpt"}


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def form_name(file_name: str | Column, suffix: str) -> Column:
    """Form name from a file name: strip a literal ``suffix`` at the end."""
    col = F.col(file_name) if isinstance(file_name, str) else file_name
    pattern = F.lit(r"\Q" + suffix + r"\E$")
    return F.regexp_replace(col, pattern, F.lit(""))


def form_of_path(path: str | Column, folder: str, suffix: str) -> Column:
    """Form name from a file's path: the first segment below ``folder``, if it ends in ``suffix`` (else NULL).

    A form may be one file or a folder of part files.
    """
    col = F.col(path) if isinstance(path, str) else path
    below = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", folder).rstrip("/") + "/"
    segment = F.split_part(F.substring_index(col, below, -1), F.lit("/"), F.lit(1))
    return F.when(F.contains(col, F.lit(below)) & segment.endswith(suffix), form_name(segment, suffix))


def in_scope(form: str | Column, exclude: Iterable[str] = (), skip_codes: bool = False) -> Column:
    """Catalogue rule: not excluded (case-sensitive), not a code list."""
    col = F.col(form) if isinstance(form, str) else form
    cond = ~col.isin(*list(exclude)) if exclude else F.lit(True)
    if skip_codes:
        cond = cond & ~col.contains("_codes")
    return cond


def relabel(form: str | Column, mapping: Mapping[str, str] = FORM_RELABEL) -> Column:
    col = F.col(form) if isinstance(form, str) else form
    out = col
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out


def form_catalogue(
    forms: DataFrame,
    form_col: str = "crf",
    exclude: Sequence[str] = (),
    skip_codes: bool = False,
) -> DataFrame:
    """Distinct form names in scope (one row per form)."""
    return forms.select(F.col(form_col).alias("crf")).distinct().where(in_scope("crf", exclude, skip_codes))


def list_form_files(
    spark: SparkSession,
    folder: str,
    suffix: str,
    exclude: Sequence[str] = (),
    skip_codes: bool = False,
) -> DataFrame:
    """Catalogue of a folder: ``crf, path`` for every in-scope file ending in ``suffix``.

    A form is a file, or a folder of part files. ``binaryFile`` lists files in
    parallel and never reads their content here, because only ``path`` is
    selected. Like every Spark file source it skips names starting with ``_`` or
    ``.``; ``sinks.write_normalised`` stores such forms under their study name.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    named = files.select(form_of_path("path", folder, suffix).alias("crf")).where("crf is not null").distinct()
    return named.where(in_scope("crf", exclude, skip_codes)).withColumn(
        "path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("crf"), F.lit(suffix))
    )


def load_form(
    spark: SparkSession,
    folder: str,
    name: str,
    fmt: str = "parquet",
    suffix: str = ".parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One form of a study folder by name, with lower-case columns and its ``crf``."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return normalise_columns(reader.load(f"{folder.rstrip('/')}/{name}{suffix}")).withColumn("crf", F.lit(name))


def load_forms(
    spark: SparkSession,
    folder: str,
    fmt: str = "parquet",
    suffix: str = ".parquet",
    exclude: Sequence[str] = (),
    skip_codes: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All forms of a folder in one scan, with a ``crf`` column and lower-case names.

    Forms with different columns are merged by name (missing columns are
    NULL). The catalogue filter reads only the file-name metadata column, so
    it is evaluated per file, not per value.
    """
    reader = spark.read.format(fmt).option("pathGlobFilter", f"{{*{suffix},part-*}}").option("recursiveFileLookup", "true")
    if fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = normalise_columns(reader.load(folder))
    name = form_of_path(F.col("_metadata.file_path"), folder, suffix)
    return df.withColumn("crf", name).where(F.col("crf").isNotNull() & in_scope("crf", exclude, skip_codes))


def union_forms(forms: Mapping[str, DataFrame], required: Sequence[str] = ("sjid", "avisit")) -> DataFrame:
    """Append separately loaded forms by column name, tagging each with its name.

    Forms without the ``required`` columns have no visit scheme and are
    skipped (a schema check, no data is read). Missing columns are NULL.
    """
    tagged = []
    for name, df in forms.items():
        df = normalise_columns(df)
        if all(c in df.columns for c in required):
            tagged.append(df.withColumn("crf", F.lit(name)))
    if not tagged:
        raise ValueError(f"no form has the columns {list(required)}")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
