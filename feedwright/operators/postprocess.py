"""Post-processors applied after a load, as ``DataFrame -> DataFrame``
functions chained with ``df.transform``. A switch is given as ``name`` or
``name:argument``; a dict maps switches to arguments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _trim(df: DataFrame, _arg=None) -> DataFrame:
    return df.select([F.trim(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")
                      for c, t in df.dtypes])


def _upper(df: DataFrame, arg: str) -> DataFrame:
    return df.withColumn(arg, F.upper(F.col(arg)))


def _lower(df: DataFrame, arg: str) -> DataFrame:
    return df.withColumn(arg, F.lower(F.col(arg)))


def _drop(df: DataFrame, arg: str) -> DataFrame:
    return df.drop(*[c.strip() for c in arg.split(",")])


def _rename(df: DataFrame, arg: str) -> DataFrame:
    old, new = arg.split("=")
    return df.withColumnRenamed(old.strip(), new.strip())


def _dedupe(df: DataFrame, arg: str) -> DataFrame:
    """One row per key: the greatest row (deterministic). An aggregate, so a hot
    key is combined map-side instead of sorted in one task."""
    keys = [c.strip() for c in arg.split(",")]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    return (df.groupBy(*keys).agg(F.max_by(row, row).alias("_r"))
            .select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in rest]))


POSTPROCESSORS: dict[str, Callable[..., DataFrame]] = {
    "trim": _trim, "upper": _upper, "lower": _lower, "drop": _drop, "rename": _rename, "dedupe": _dedupe,
}


def parse_switches(opts) -> list[tuple[str, str | None]]:
    if not opts:
        return []
    if isinstance(opts, dict):
        return [(k, v) for k, v in opts.items()]
    if isinstance(opts, str):
        opts = [o for o in opts.split(";") if o.strip()]
    out = []
    for o in opts:
        name, _, arg = o.strip().partition(":")
        out.append((name.strip(), arg or None))
    return out


def apply_postprocessors(df: DataFrame, opts) -> DataFrame:
    for name, arg in parse_switches(opts):
        fn = POSTPROCESSORS.get(name)
        if fn is None:
            raise ValueError(f"unknown post-processor {name!r}")
        df = df.transform(fn, arg)
    return df
