"""Guarded weights of correlated axes and the signals made with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The axes' base weights and their priorities (the lower one goes).
BASE = {"upside": 0.25, "downside": 0.25, "bm": 0.25, "persistence": 0.25}
PRIORITY = {"downside": 4, "bm": 3, "persistence": 2, "upside": 1}


def guarded(pairs: Sequence[tuple[str, str, float]], base: dict[str, float] = BASE, priority: dict[str, int] = PRIORITY, most: float = 0.7, cap: float = 0.25) -> dict[str, float]:
    """Weights after the guard. pairs: (a, b, rho) of a handful of axes, aggregated before.

    Of each pair beyond ``most``, strongest first, the axis of lower priority gets nothing. A pair is passed over only if its loser is out
    already, so an axis that is out can still push out others. What stays is capped, and scaled to add up to 1.
    """
    weights = dict(base)
    for a, b, rho in sorted(pairs, key=lambda p: (-abs(p[2]), p[0], p[1])):
        if abs(rho) > most:
            weights[min((a, b), key=lambda x: (priority[x], x))] = 0.0
    capped = {k: min(v, cap) for k, v in weights.items()}
    total = sum(capped.values())
    return {k: v / total for k, v in capped.items()} if total > 0 else dict(base)


def signal(weights: dict[str, float]) -> Column:
    """Axes (0 to 100) around 50: up, less down, plus fit and persistence, by their weights, within +-1."""
    sign = {"upside": 1, "downside": -1, "bm": 1, "persistence": 1}
    total = sum(weights.values()) or 1.0
    out = F.lit(0.0)
    for axis, w in weights.items():
        out = out + sign[axis] * w * (F.col(axis) - 50) / 50
    return F.greatest(F.least(out / total, F.lit(1.0)), F.lit(-1.0))


def shifted(axes: DataFrame, shifts: dict[str, float]) -> DataFrame:
    """Axes moved by a factor of the day's macro score, within 0 to 100."""
    return axes.withColumns({a: F.greatest(F.least(F.col(a) + s * F.col("macro"), F.lit(100.0)), F.lit(0.0)) for a, s in shifts.items()})


def filing_signal() -> Column:
    """Orders less rights issues and lawsuits plus half of guidance, per document, within +-1."""
    n = F.col("docs_order") - F.col("docs_rights_issue") - F.col("docs_lawsuit") + 0.5 * F.col("docs_guidance")
    return F.greatest(F.least(n / F.greatest("docs", F.lit(1)), F.lit(1.0)), F.lit(-1.0))
