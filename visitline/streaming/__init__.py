"""Streaming entry points.

The source scripts are batch-only: every input is a finished folder of form
files and every output is a whole table. The operators here are plain
DataFrame transformations, so the stateless steps (form stacking,
``stack.stack_forms``) also run unchanged on a ``readStream`` of a form
folder; the grouped rules need the whole study and stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitline.operators.stack import stack_forms
from visitline.sources.forms import form_of_path, normalise_columns


def stream_forms(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    fmt: str = "parquet",
    suffix: str = ".parquet",
    **stack_options,
) -> DataFrame:
    """Form files landing in ``folder`` as a stream of stacked ``OBS`` rows."""
    raw = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("pathGlobFilter", f"{{*{suffix},part-*}}")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    forms = normalise_columns(raw).withColumn("crf", form_of_path(F.col("_metadata.file_path"), folder, suffix))
    return stack_forms(forms, **stack_options)
