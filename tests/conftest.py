import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("gridspark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def bronze_of(spark, *rows):
    """Bronze from (extracted_at, payload) pairs; the payload is an object or text."""
    import json

    return spark.createDataFrame(
        [
            (at, "https://grid.example.org/x", p if p is None or isinstance(p, str) else json.dumps(p))
            for at, p in rows
        ],
        "extracted_at string, source_url string, payload string",
    )


def mix_payload(zone="DE", granularity="hourly", **item):
    item = {"datetime": "2026-04-16T12:00:00Z", "updatedAt": "2026-04-16T12:05:00Z", **item}
    return {"zone": zone, "temporalGranularity": granularity, "unit": "MW", "data": [item]}


def flow_payload(imports, exports, zone="FR", **item):
    item = {
        "datetime": "2026-04-16T12:00:00Z",
        "updatedAt": "2026-04-16T12:05:00Z",
        "import": imports,
        "export": exports,
        **item,
    }
    return {"zone": zone, "temporalGranularity": "hourly", "unit": "MW", "data": [item]}
