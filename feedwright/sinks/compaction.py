"""Compaction of one partition folder by bin packing over its file sizes.

Only small files are rewritten: first-fit decreasing puts them into groups of at most the target size, a group of one file stays as it is, and
large files are never read. Every group is one task that reads its files and writes one (no shuffle).

The switch from old to new files survives a crash: the new files are written below a hidden folder of the partition, then a journal file names
old and new ones. From then on the new state holds; ``finish`` carries it out (move the new files in, delete the old ones,
delete the journal) and may be called again at any time, which every load of the partition does first.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from feedwright.sources import storage

_JOURNAL = "_compaction-"


def groups(files: dict[str, int], target: int) -> list[list[str]]:
    """First-fit decreasing: names of the files that become one, each group within ``target`` bytes and of two files at least."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(files.items(), key=lambda f: (-f[1], f[0])):
        if 2 * size > target:            # large enough to stay
            continue
        for i, (full, names) in enumerate(bins):
            if full + size <= target:
                bins[i] = (full + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def finish(spark: SparkSession, folder: str) -> None:
    """Carry out the journals that a compaction has left."""
    folder = folder.rstrip("/")
    for name in storage.names(spark, folder):
        if not name.startswith(_JOURNAL):
            continue
        journal = json.loads(storage.read_small(spark, f"{folder}/{name}") or "{}")
        for new in journal.get("new", ()):
            if storage.exists(spark, f"{folder}/{journal['staged']}/{new}"):
                storage.rename(spark, f"{folder}/{journal['staged']}/{new}", f"{folder}/{new}")
        for old in journal.get("old", ()):
            storage.delete(spark, f"{folder}/{old}")
        if journal:
            storage.delete(spark, f"{folder}/{journal['staged']}")
        storage.delete(spark, f"{folder}/{name}")


def compact_folder(spark: SparkSession, folder: str, target: int, fmt: str = "parquet", compression: str = "zstd") -> int:
    """Compact one folder; returns the number of files that were replaced."""
    folder = folder.rstrip("/")
    finish(spark, folder)
    packed = groups(storage.file_sizes(spark, folder), target)
    if not packed:
        return 0
    mark = uuid.uuid4().hex
    staged = f"_staged-{mark}"
    one = [spark.read.format(fmt).load([f"{folder}/{name}" for name in names]).coalesce(1) for names in packed]
    (reduce(DataFrame.unionByName, one).write.format(fmt).mode("errorifexists").option("compression", compression).save(f"{folder}/{staged}"))
    new = sorted(storage.file_sizes(spark, f"{folder}/{staged}"))
    old = [name for names in packed for name in names]
    storage.create_new(spark, f"{folder}/{_JOURNAL}{mark}.json", json.dumps({"staged": staged, "new": new, "old": old}))
    finish(spark, folder)
    return len(old)
