from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from visitline.session import configure

    session = (
        SparkSession.builder.master("local[4]")
        .appName("visitline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session


OBS_SCHEMA = "study string, sjid bigint, avisit string, avisitn double, crf string, adt date"


@pytest.fixture
def obs_of(spark):
    """Build an ``OBS`` frame from ``(avisitn, crf, adt)`` or ``(avisit, avisitn, crf, adt)`` tuples."""

    def make(rows, sjid: int = 1, study: str = "S"):
        full = []
        for r in rows:
            if len(r) == 3:
                avisitn, crf, adt = r
                avisit = f"Visit {int(avisitn)}"
            else:
                avisit, avisitn, crf, adt = r
            full.append((study, sjid, avisit, float(avisitn), crf, adt))
        return spark.createDataFrame(full, OBS_SCHEMA)

    return make
