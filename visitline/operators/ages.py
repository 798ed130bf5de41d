"""Baseline age per subject and age at each visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitline.functions import (
    day_number,
    first_by,
    join_on_keys,
    nulls_last_key,
    own_shuffle,
    poisoned,
)

SUBJECT = ("study", "sjid")
DAYS_PER_YEAR = 365.25


def baseline_age(registration: DataFrame, demographics: DataFrame) -> DataFrame:
    """``study, sjid, start_age, dm_age_used``.

    Registration rows get the subject's demographics (left join on ``sjid``);
    one row per subject is kept (earliest demographics date, then age at
    registration, start age and registration age, a missing one last each). The age falls back from start age to
    registration age to age at registration; when both of the first two are
    missing, the demographics date is kept as the date the age refers to.
    Subjects without an age, or with an age of 1 or less, are removed.
    """
    dem = demographics.select("sjid", "ageatregistration", "dm_date").distinct()
    joined = registration.join(dem, "sjid", "left").withColumn(
        "dm_day", F.try_to_date("dm_date", "M/d/yyyy")
    )
    first = first_by(
        joined,
        SUBJECT,
        nulls_last_key("dm_day", "ageatregistration", "start_age", "registration_age"),
        ["start_age", "registration_age", "ageatregistration", "dm_date"],
    )
    first_two = F.coalesce("start_age", "registration_age")
    return (
        first.select(
            *SUBJECT,
            F.coalesce(first_two, F.col("ageatregistration")).alias("start_age"),
            F.when(first_two.isNull(), F.try_to_date("dm_date", "M/d/yyyy")).alias("dm_age_used"),
        )
        .where(F.col("start_age") > 1)
    )


def with_age_at_visit(obs: DataFrame, ages: DataFrame) -> DataFrame:
    """Rows of subjects with an age, plus ``age_bl``, ``time`` and ``age``.

    ``time`` is years since the subject's first date; it is missing for every
    row of a subject with one missing date (R's ``min`` with NA).
    """
    # Per-subject first date and baseline age are joined on the small side, so
    # the observation rows cross one join only.
    first = obs.groupBy(*SUBJECT).agg(poisoned(F.min(day_number("adt")), "adt").alias("__first"))
    bl = ages.select(*SUBJECT, F.col("start_age").alias("age_bl")).where(F.col("age_bl").isNotNull())
    per_subject = own_shuffle(join_on_keys(first, bl, SUBJECT), SUBJECT)
    rows = join_on_keys(obs, per_subject, SUBJECT)
    time = (day_number("adt") - F.col("__first")) / F.lit(DAYS_PER_YEAR)
    return rows.withColumn("time", time).withColumn("age", F.col("age_bl") + F.col("time")).drop("__first")


def subjects_with_age(obs: DataFrame, ages: DataFrame) -> DataFrame:
    """Rows of subjects that have a baseline age (the filter part of C7)."""
    return join_on_keys(obs, own_shuffle(ages.select(*SUBJECT), SUBJECT), SUBJECT, how="left_semi")
