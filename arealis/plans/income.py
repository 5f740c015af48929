"""How concentrated income is over regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.operators.stats import histogram, share_of_total, weighted_total

# Fixed value: weeks in a year, for weekly medians.
WEEKS = 52.25


def income_totals(df: DataFrame, median: str, population: str) -> DataFrame:
    """Total income and total population."""
    return weighted_total(df, median, population, WEEKS)


def income_shares(df: DataFrame, median: str, population: str, total: float | None = None) -> DataFrame:
    """Per region: its share of all income (percent), yearly median, population."""
    income = F.col(median) * F.col(population) * WEEKS
    return share_of_total(df, income, total, "proportion").select(
        "region_id", "proportion", (F.col(median) * WEEKS).alias("median_income"), F.col(population).alias("population")
    )


def income_histogram(df: DataFrame, median: str, population: str, lo: float = 0.0, hi: float = 1e9, n: int = 19) -> DataFrame:
    """Regions per income bucket."""
    return histogram(df, F.col(median) * F.col(population) * WEEKS, lo, hi, n)


def income_report(df: DataFrame, median: str, population: str, hi: float = 1e9, n: int = 19) -> dict[str, DataFrame]:
    """The three tables of the report, each its own plan."""
    return {
        "totals": income_totals(df, median, population),
        "shares": income_shares(df, median, population),
        "histogram": income_histogram(df, median, population, 0.0, hi, n),
    }
