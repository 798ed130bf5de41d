from __future__ import annotations

import pytest
from llm_helpers import DOCS
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("visitline-llm-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def docs_of(spark):
    def make(rows, schema=DOCS, **extra):
        """``(doc_id, text, lang, source)`` rows, with columns that clash with the operators' own names."""
        full = [(*r, len(r[1] or "")) for r in ((*r, *(None,) * (4 - len(r))) for r in rows)]
        df = spark.createDataFrame(full, schema)
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(7) for c in ("score", "size", "node", "rank", "value", "_n", "bin", "copies", "fingerprint", "_score")})

    return make
