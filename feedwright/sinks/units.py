"""L2: append tables whose loads are units that can be repeated.

An append can't be undone by its own path, so a load that fails after its write and runs again would
double its rows. Here a load is a *unit* (operator and window, see ``unit_key``) with its own folder::

    <table>/load_unit=<key>@<publication>/[<partition>=<value>/...]

It is written below ``<table>/_staged`` (which readers skip) and published by one rename of that folder, all partitions at once.
The folder names are the manifest: of each unit the greatest publication counts, so a repeated load replaces its own rows only.
Publication numbers are claimed by exclusive creation, so two runs of one unit can't take the same.

Cost: a listing of one level per read, one rename per load. Older publications are deleted after the rename; staged
leftovers of failed runs after ``LEFTOVER_SECONDS``.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.sources import storage

#: The folder column that plain readers of the table see.
UNIT = "load_unit"

#: Staged folders that old belong to runs that died.
LEFTOVER_SECONDS = 24 * 3600

_FOLDER = re.compile(rf"^{UNIT}=(.+)@(\d+)$")

#: Comparison operators as parts of a folder name.
_OPERATORS = {">": "gt", ">=": "ge", "<": "lt", "<=": "le", "=": "eq", "<>": "ne", "between": "in"}


def unit_key(operator: str, from_date, end_date) -> str:
    """The unit of a delta window: a load with the same operator and dates is the same unit."""
    op = _OPERATORS[operator.strip().lower()]
    return f"{op}-{from_date:%Y%m%d}-{end_date:%Y%m%d}" if op == "in" else f"{op}-{from_date:%Y%m%d}"


class UnitTable:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def folders(self) -> dict[str, str]:
        """Unit to the folder that is published for it."""
        found: dict[str, tuple[int, str]] = {}
        for name in storage.names(self.spark, self.path):
            if m := _FOLDER.match(name):
                found[m[1]] = max(found.get(m[1], (0, "")), (int(m[2]), name))
        return {key: name for key, (_, name) in sorted(found.items())}

    def manifest(self) -> DataFrame:
        """``(unit, folder, bytes)`` of every published unit."""
        rows = [(key, name, storage.total_bytes(self.spark, f"{self.path}/{name}")) for key, name in self.folders().items()]
        return self.spark.createDataFrame(rows, "unit string, folder string, bytes long")

    def read(self, schema, units: list[str] | None = None) -> DataFrame:
        """The rows of the published units (or of the named ones), without the unit column."""
        folders = self.folders()
        paths = [f"{self.path}/{name}" for key, name in folders.items() if units is None or key in units]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path).format(self.fmt).load(paths)
        return rows.drop(UNIT)

    def load(self, df: DataFrame, unit: str, partition_cols: list[str], compression: str | None = None) -> str:
        """Write ``df`` as the unit and publish it; the unit's earlier rows are replaced. Returns the unit's folder."""
        staged = f"{self.path}/_staged/{unit}-{uuid.uuid4().hex}"
        if partition_cols:
            df = df.hint("rebalance", *partition_cols)
        w = df.write.format(self.fmt).mode("errorifexists").partitionBy(*partition_cols)
        try:
            (w.option("compression", compression) if compression else w).save(staged)
        except BaseException:
            storage.delete(self.spark, staged)
            raise
        return self._publish(staged, unit)

    def _publish(self, staged: str, unit: str) -> str:
        self._adopt()
        number = 0
        for name in storage.names(self.spark, self.path):
            if (m := _FOLDER.match(name)) and m[1] == unit:
                number = max(number, int(m[2]))
        while True:
            number += 1
            if storage.create_new(self.spark, f"{self.path}/_claims/{unit}@{number}", ""):
                break
        folder = f"{UNIT}={unit}@{number}"
        storage.rename(self.spark, staged, f"{self.path}/{folder}")
        self._clean(unit, number)
        return f"{self.path}/{folder}"

    def _adopt(self) -> None:
        """Rows that were appended before the table had units become the unit ``before``."""
        names = [n for n in storage.names(self.spark, self.path) if n[:1] not in "_." and not _FOLDER.match(n)]
        if not names:
            return
        staged = f"{self.path}/_staged/before"
        storage.make_folder(self.spark, staged)
        for name in names:
            storage.rename(self.spark, f"{self.path}/{name}", f"{staged}/{name}")
        storage.rename(self.spark, staged, f"{self.path}/{UNIT}=before@1")

    def _clean(self, unit: str, number: int) -> None:
        for name in storage.names(self.spark, self.path):
            if (m := _FOLDER.match(name)) and m[1] == unit and int(m[2]) < number:
                storage.delete(self.spark, f"{self.path}/{name}")
        for name in storage.names(self.spark, f"{self.path}/_claims"):
            key, _, n = name.rpartition("@")
            if key == unit and n.isdigit() and int(n) < number:
                storage.delete(self.spark, f"{self.path}/_claims/{name}")
        for name in storage.names(self.spark, f"{self.path}/_staged"):
            if storage.age_seconds(self.spark, f"{self.path}/_staged/{name}") > LEFTOVER_SECONDS:
                storage.delete(self.spark, f"{self.path}/_staged/{name}")

    def drop_partitions(self, col: str, values: list[str]) -> None:
        """Delete first-level partitions in every unit (retention)."""
        for folder in self.folders().values():
            for v in values:
                storage.delete(self.spark, f"{self.path}/{folder}/{col}={v}")

    def partition_values(self, col: str) -> list[str]:
        return sorted({v for f in self.folders().values() for v in storage.partition_values(self.spark, f"{self.path}/{f}", col)})
