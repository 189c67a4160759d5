"""Questions the star schema answers. Facts are counted per key before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions import season_of_month
from portolan.operators import valid_or_other
from portolan.operators.lookup import lookup_join
from portolan.sources import STATE_CODES


def _of_year(fact: DataFrame, year: int | None) -> DataFrame:
    return fact if year is None else fact.filter(F.col("date_year") == year)


def _is_summary(fact: DataFrame) -> bool:
    return "travellers" in fact.columns


def _travellers(fact: DataFrame) -> Column:
    return F.sum("travellers") if _is_summary(fact) else F.count("*")


def travel_patterns(
    fact: DataFrame,
    modes: DataFrame,
    visas: DataFrame,
    regions: DataFrame,
    year: int | None = None,
) -> DataFrame:
    """Travellers by mode, purpose, country of residence and season of arrival.

    Codes without a name keep a null name. ``year`` prunes partitions of the fact table.
    ``fact`` may be the stored summary (``summaries.refresh_summary``) instead.
    """
    month = F.col("month") if _is_summary(fact) else F.month("arr_date")
    counted = _of_year(fact, year).groupBy(
        "mode", "visa_code", "res_code", month.alias("month")
    ).agg(_travellers(fact).alias("travellers"))
    named = counted
    # Modes and visas are fixed lists of a few rows; regions are measured.
    for key, names, label in (("mode", modes, "travel_mode"), ("visa_code", visas, "travel_purpose")):
        listed = names.select(F.col("code").cast(counted.schema[key].dataType).alias(key), label)
        named = named.join(F.broadcast(listed), key, "left")
    residences = regions.select(F.col("cit_res_code").cast(counted.schema["res_code"].dataType).alias("res_code"), "cit_res_name")
    named = lookup_join(named, residences, ["res_code"], "left")
    return named.groupBy(
        "travel_mode",
        "travel_purpose",
        F.col("cit_res_name").alias("origin"),
        season_of_month("month").alias("season"),
    ).agg(F.sum("travellers").alias("travellers"))


def destination_profile(
    fact: DataFrame, demographics: DataFrame, year: int | None = None
) -> DataFrame:
    """Travellers per state of stay beside the state's population make-up.

    States off the list are counted together under ``99``, which has no demographics.
    ``fact`` may be the stored summary instead.
    """
    state = F.col("state_code") if _is_summary(fact) else valid_or_other("addr", STATE_CODES)
    counted = (
        _of_year(fact, year).groupBy(state.alias("state_code")).agg(_travellers(fact).alias("travellers"))
    )
    population = F.col("total_population")
    return counted.join(demographics, "state_code", "left").select(
        "state_code",
        "state_name",
        "travellers",
        "total_population",
        F.try_divide(F.col("travellers") * 1000, population).alias("travellers_per_1000"),
        F.try_divide(F.col("foreign_born_population"), population).alias("foreign_born_share"),
        "median_age",
        "household_size_avg",
    )
