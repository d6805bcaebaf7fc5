from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    warehouse = tempfile.mkdtemp(prefix="strata-wh-")
    s = build_session(
        "strata-tests",
        profile="mvp",
        master="local[4]",
        extra_conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": warehouse,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def ndjson(tmp_path):
    """Write lines (dicts are JSON-encoded, strings written verbatim) to a fresh folder."""

    counter = {"n": 0}

    def write(lines, name=None):
        counter["n"] += 1
        d = tmp_path / (name or f"src{counter['n']}")
        d.mkdir(parents=True, exist_ok=True)
        with open(d / "part-0.json", "w") as fh:
            for line in lines:
                fh.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
        return str(d)

    return write
