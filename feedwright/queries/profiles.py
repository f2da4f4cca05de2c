"""Null profiles and the raw-versus-refined validation."""

from __future__ import annotations

from feedwright.operators.profile import null_profile
from feedwright.plans.validate import validate_tables
from feedwright.queries import register
from feedwright.queries.duck import (
    LINEITEM_COLS, LINEITEM_RAW, LINEITEM_REFINED, ORDERS_COLS, ORDERS_NULLS, compare_sql, profile_sql,
)
from feedwright.sources import derive
from feedwright.sources.tables import read_table


@register("null_profile_lineitem", profile_sql(LINEITEM_RAW, LINEITEM_COLS))
def null_profile_lineitem(spark, sf_dir):
    return null_profile(derive.lineitem_raw(read_table(spark, sf_dir, "lineitem")))


@register("null_profile_orders", profile_sql(ORDERS_NULLS, ORDERS_COLS))
def null_profile_orders(spark, sf_dir):
    return null_profile(derive.orders_with_nulls(read_table(spark, sf_dir, "orders")))


_REFINED_COLS = [c for c in LINEITEM_COLS if c != "l_returnflag"] + ["load_tag"]


@register("validate_raw_refined", compare_sql(profile_sql(LINEITEM_RAW, LINEITEM_COLS),
                                              profile_sql(LINEITEM_REFINED, _REFINED_COLS)))
def validate_raw_refined(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return validate_tables(derive.lineitem_raw(li), derive.lineitem_refined(li))
