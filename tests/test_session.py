"""Submitted settings win over the library's defaults."""

import os
import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]
READ_BACK = """
from martwright.session import build_session
spark = build_session()
print("GOT", spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.ansi.enabled"))
spark.stop()
"""


def _read_back(submit: str) -> list[str]:
    env = os.environ | {"PYTHONPATH": str(ROOT), "PYSPARK_SUBMIT_ARGS": f"{submit} pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", READ_BACK], env=env, capture_output=True, text=True, timeout=300)
    return out.stdout.split("GOT ")[1].split()


def test_submitted_settings_are_kept():
    got = _read_back("--master local[2] --conf spark.sql.shuffle.partitions=321 --conf spark.sql.ansi.enabled=false")
    assert got == ["local[2]", "321", "false"]


def test_defaults_of_a_plain_local_run():
    assert _read_back("")[1:] == ["8", "true"]
