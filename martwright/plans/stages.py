"""Stored stages of a run, each proven by a fingerprint, so that a broken run
goes on where it broke.

A stage is a table in a folder of its own. While it is written, its rows are
counted and hashed in the same pass (``observe``); what is read back must have
the same fingerprint, and only then is the stage entered in the run's manifest, by
one rename. A later run with the same manifest and the same inputs reads a stage
again if its files still have that fingerprint, and builds it otherwise. The
fingerprint (rows, sum and exclusive-or of row hashes) does not depend on order
or on files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.session import path_exists

#: Times that a stage is written until what is read back agrees with what was written.
ATTEMPTS = 3


def _measures(columns: list[str]) -> list[Column]:
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum"),
        F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor"),
    ]


def fingerprint(df: DataFrame) -> dict:
    """{rows, sum, xor} of the table's rows; equal for equal bags of rows."""
    return df.agg(*_measures(df.columns)).first().asDict()


class Stages:
    """The stages of one run below ``folder``. ``inputs`` names the state of what
    the run reads; with other inputs nothing of an earlier run is taken over."""

    def __init__(self, spark: SparkSession, folder: str, inputs: str = ""):
        self.spark, self.folder, self.inputs = spark, folder.rstrip("/"), inputs
        self.reused: list[str] = []

    def _entry_path(self, name: str) -> str:
        return f"{self.folder}/_manifest/{name}"

    def _entry(self, name: str) -> dict | None:
        if not path_exists(self.spark, self._entry_path(name)):
            return None
        lines = self.spark.read.text(self._entry_path(name)).collect()  # one line
        return json.loads(lines[0][0]) if lines else None

    def _enter(self, name: str, entry: dict) -> None:
        """Replace the stage's entry: written beside it, then renamed."""
        new = f"{self.folder}/_manifest/_next-{uuid.uuid4().hex[:12]}"
        self.spark.createDataFrame([(json.dumps(entry),)], "line string").coalesce(1).write.text(new)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        place = path(self._entry_path(name))
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(place, True)
        if not fs.rename(path(new), place):
            raise OSError(f"stage {name} could not be entered in {self.folder}")

    def _proven(self, name: str) -> DataFrame | None:
        entry = self._entry(name)
        if entry is None or entry["inputs"] != self.inputs or not path_exists(self.spark, entry["path"]):
            return None
        stored = self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(entry["path"])
        return stored if fingerprint(stored) == entry["fingerprint"] else None

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None, order_by: tuple[str, ...] = ()
    ) -> DataFrame:
        """The stage's table: as proven by an earlier run, else built and stored."""
        found = self._proven(name)
        if found is not None:
            self.reused.append(name)
            return found
        for _ in range(ATTEMPTS):
            df = build()
            path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
            seen = Observation()
            rows = df.repartitionByRange(*order_by) if order_by else df  # AQE sizes the ranges
            # above the ranges: finding their bounds reads what is below them a second time
            rows = rows.observe(seen, *_measures(df.columns))
            writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
            writer.parquet(path)
            stored = self.spark.read.schema(df.schema).parquet(path)
            # a stage run twice by a lost executor may be observed twice: then it is written again
            proof = fingerprint(stored)
            if proof == seen.get:
                self._enter(name, {"path": path, "inputs": self.inputs, "schema": df.schema.jsonValue(), "fingerprint": proof})
                return stored
        raise OSError(f"stage {name}: what was read back is not what was written")
