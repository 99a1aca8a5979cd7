import json
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    """A session in a zone with daylight saving: no result may depend on it."""
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def land(tmp_path):
    """Write dicts as JSON lines and return the folder."""

    def write(name, rows, part=0):
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True, exist_ok=True)
        lines = "\n".join(json.dumps(r, ensure_ascii=False) for r in rows)
        (folder / f"part-{part:03d}.json").write_text(lines)
        return str(folder)

    return write


def utc(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def completed_rows(spark):
    """Rows of the completed-task table from partial dicts."""
    from effortlens import schema

    def build(*rows):
        names = [f.name for f in schema.COMPLETED_TASKS]
        full = []
        for row in rows:
            base = {"inserted_at": datetime(2024, 1, 1), "is_subtask": False, **row}
            full.append(tuple(base.get(n) for n in names))
        return spark.createDataFrame(full, schema.COMPLETED_TASKS)

    return build
