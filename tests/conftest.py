from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cdcmart.session import build_session  # noqa: E402

SAMPLE_FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sample(spark):
    from cdcmart.sources.sample import Sample

    return Sample(spark, SAMPLE_FOLDER)


@pytest.fixture
def crowded(spark, monkeypatch):
    """Treat every table as large and every repeated key as hot."""
    from cdcmart.operators import skew

    monkeypatch.setattr(skew, "SAMPLE", 1)
    monkeypatch.setattr(skew, "SEEN", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)
