"""Rows the reports leave out: partial loads, test accounts and listed customers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.rows import without_matches
from haulmetry.functions.text import ilike_any, json_text, none_ilike

# Spelling of test and stand-in accounts, small-business customer types,
# and the comment that marks a cancelled demand.
TEST_NAMES = ("%testing%",)
ALTERNATE_NAMES = ("%alternat%", "%testing%")
CANCELLATION_TEST_NAMES = ("%testing%", "%alternate%")
SMALL_BUSINESS = ("SME", "SME_HP")
DEMAND_CANCELLED = "DEMAND CANCELLED"
LOAD = "partial_load"


def full_load_demands(demands: DataFrame) -> DataFrame:
    """Demands whose metadata does not flag a partial load; unreadable metadata drops the row.

    The flag of a table that ``with_load`` has made is not parsed again.
    """
    flag = F.col(LOAD) if LOAD in demands.columns else json_text(F.col("metadata"), "ptl")
    return demands.where(flag != "true")


def with_load(demands: DataFrame) -> DataFrame:
    """Demands with the text that flags a partial load. Write them where several jobs read it."""
    return demands.withColumn(LOAD, json_text(F.col("metadata"), "ptl"))


def without_partial_comments(
    df: DataFrame, comments: DataFrame, patterns: Iterable[str], key: str = "demand_id"
) -> DataFrame:
    """Leave out demands that carry a partial-load comment."""
    marked = comments.where(ilike_any(F.col("remarks"), patterns)).select(F.col("demand_id").alias(key))
    return without_matches(df, marked, [key])


def without_cancelled_comments(df: DataFrame, comments: DataFrame, key: str = "demand_id") -> DataFrame:
    """Leave out demands that carry the cancellation comment."""
    marked = comments.where(F.col("remarks") == DEMAND_CANCELLED).select(F.col("demand_id").alias(key))
    return without_matches(df, marked, [key])


def real_consigners(consigners: DataFrame, test_names: Iterable[str] = TEST_NAMES) -> DataFrame:
    """Customers whose name is present and not a test spelling."""
    return consigners.where(none_ilike(F.col("name"), test_names))


def exclude_partial_and_test(
    demands: DataFrame,
    consigners: DataFrame,
    comments: DataFrame,
    partial_patterns: Iterable[str],
    excluded_customers: Iterable[str] = (),
    test_names: Iterable[str] = ALTERNATE_NAMES,
) -> DataFrame:
    """All four exclusions on demands."""
    kept = full_load_demands(demands)
    listed = list(excluded_customers)
    if listed:
        kept = kept.where(~F.col("consigner_user_code").isin(*listed))
    named = real_consigners(consigners, test_names).select(F.col("code").alias("consigner_user_code"))
    kept = kept.join(named, "consigner_user_code", "left_semi")
    return without_partial_comments(kept, comments, partial_patterns, key="id").select(*demands.columns)
