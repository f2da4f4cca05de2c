"""M5: table validation — profile a raw and a refined table and compare them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedwright.operators.profile import compare_profiles, null_profile
from feedwright.sources.scans import scan_raw, scan_refined


def validate_tables(raw: DataFrame, refined: DataFrame, from_date=None, end_date=None,
                    part_col: str | None = None, load_col: str = "loaddate") -> DataFrame:
    """Profile both sides (A1/A2 scans, E3) and compare them."""
    raw_side = scan_raw(raw, from_date, load_col) if from_date else raw
    ref_side = scan_refined(refined, part_col, from_date, end_date) if from_date else refined
    return compare_profiles(null_profile(raw_side), null_profile(ref_side))
