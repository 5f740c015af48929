"""A statistic given by an equation over other statistics."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.operators.dictionary import REGION_ID
from arealis.operators.stats import join_profiles

ALLOWED = re.compile(r"(?:[a-z]+\d+|\d+(?:\.\d+)?|[-+*/()])+")
STAT_ID = re.compile(r"[a-z]+\d+")


def equation_ids(equation: str) -> list[str]:
    """Statistic ids of an equation; anything but ids, numbers, ``+ - * /`` and
    parentheses is refused."""
    text = re.sub(r"\s+", "", equation.lower())
    if not ALLOWED.fullmatch(text) or "--" in text or "/*" in text:
        raise ValueError(f"not an equation of statistics: {equation!r}")
    return sorted(set(STAT_ID.findall(text)))


def stat_equation(read_table: Callable[[str], DataFrame], stats: DataFrame, equation: str, name: str = "value") -> DataFrame:
    """``region_id`` and the equation's value.

    The dictionary says which profile table holds each id; only the columns the
    equation names are read. Division by zero raises.
    """
    ids = equation_ids(equation)
    if not ids:
        raise ValueError("the equation names no statistic")
    wanted = stats.filter(F.lower("sequential_id").isin(ids)).select(F.lower("sequential_id"), F.lower("table_number"))
    home = {r[0]: r[1] for r in wanted.collect()}  # at most one row per id in the equation
    unknown = [i for i in ids if i not in home]
    if unknown:
        raise ValueError(f"unknown statistics: {unknown}")
    tables: dict[str, list[str]] = {}
    for i in ids:
        tables.setdefault(home[i], []).append(i)
    parts = [read_table(t).select(REGION_ID, *columns) for t, columns in sorted(tables.items())]
    return join_profiles(parts).select(REGION_ID, F.expr(re.sub(r"\s+", "", equation.lower())).alias(name))


def equation_view(view: str, bdy: DataFrame, bdy_key: str, read_table: Callable[[str], DataFrame], stats: DataFrame, equation: str, name: str = "value") -> DataFrame:
    """Make the named view of ``bdy`` with an equation's value: every region, NULL where
    a statistic is missing. Returns its rows."""
    values = stat_equation(read_table, stats, equation, name)
    if name in bdy.columns:
        raise ValueError(f"the boundaries already have a column {name!r}")
    bdy.join(values, bdy[bdy_key] == values[REGION_ID], "left").select(*[bdy[f"`{c}`"] for c in bdy.columns], values[name]).createOrReplaceTempView(view)
    return bdy.sparkSession.table(view)
