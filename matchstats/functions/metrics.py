"""Column expressions over wide metric tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.registry import LOWER_IS_BETTER, RATIOS, columns_for
from matchstats.schema import MINUTES

CALC_MODES = ("total", "per_game", "per_90")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Percentage, 0 where there is nothing to divide by."""
    return F.when(denominator > 0, numerator / denominator * 100.0).otherwise(F.lit(0.0))


def ratio_text(name: str) -> str:
    """A registered ratio as SQL."""
    numerator, terms = RATIOS[name]
    whole = " + ".join(f"`{t}`" for t in terms)
    return f"CASE WHEN {whole} > 0 THEN `{numerator}` / ({whole}) * 100D ELSE 0D END"


def with_ratios(df: DataFrame, category: str, metrics: Iterable[str]) -> DataFrame:
    """Replace the plain metric columns by the category's full column list, ratios included."""
    metrics = list(metrics)
    other = [f"`{c}`" for c in df.columns if c not in metrics]
    shown = columns_for(category, metrics)
    return df.selectExpr(*other, *[f"{ratio_text(c)} AS `{c}`" if c in RATIOS else f"`{c}`" for c in shown])


def calc_value(value: Column, games: Column, minutes: Column, mode: str) -> Column:
    """A total as it is, per game, or per 90 minutes; 0 when there is no game or minute."""
    if mode == "total":
        return value
    if mode == "per_game":
        return F.when(games > 0, value / games).otherwise(F.lit(0.0))
    if mode == "per_90":
        return F.when(minutes > 0, value * 90.0 / minutes).otherwise(F.lit(0.0))
    raise ValueError(f"unknown calculation mode {mode!r}; use one of {CALC_MODES}")


def apply_calc_mode(df: DataFrame, columns: Iterable[str], mode: str) -> DataFrame:
    """Rescale the metric columns; ratios stay as they are."""
    if mode == "total":
        return df
    games, minutes = F.col("games"), F.col("minutes")
    return df.withColumns(
        {
            c: calc_value(F.col(c), games, minutes, mode)
            for c in columns
            if c not in RATIOS and c != MINUTES
        }
    )


def best_flags(a: Column, b: Column, metric: Column) -> tuple[Column, Column]:
    """Which of two values wins; neither on a tie."""
    negative = metric.isin(*LOWER_IS_BETTER)
    return F.when(negative, a < b).otherwise(a > b), F.when(negative, b < a).otherwise(b > a)


_CONDITIONS = {
    ">=": lambda v, t: v >= t,
    ">": lambda v, t: v > t,
    "<=": lambda v, t: v <= t,
    "<": lambda v, t: v < t,
    "=": lambda v, t: v == t,
    "==": lambda v, t: v == t,
}


def condition(value: Column, operator: str, threshold: float) -> Column:
    """The comparison a streak is counted on."""
    if operator not in _CONDITIONS:
        raise ValueError(f"unknown condition {operator!r}; use one of {sorted(_CONDITIONS)}")
    return _CONDITIONS[operator](value, F.lit(float(threshold)))
