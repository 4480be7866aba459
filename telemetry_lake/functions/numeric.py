"""Rounding, division and limits, as SQL text in and SQL text out.

Text keeps a projection of fifty derived columns one call to the JVM; pass it to ``F.expr`` or
``selectExpr``.

Partial aggregates merge in whatever order tasks finish, so the last bits of a distributed average
move between runs.  Rounding such a value straight to two places flips ties at random; snapping it
to a finer grid first does not.
"""

from __future__ import annotations

GUARD_DIGITS = 3


def _scale(digits: int) -> str:
    return f"{10**digits}D"


def snap(value: str, digits: int) -> str:
    """Nearest point of the 10^-digits grid; infinities and NaN stay, large values to the last bit or so."""
    return f"(rint(({value}) * {_scale(digits)}) / {_scale(digits)})"


def round_to(value: str, digits: int) -> str:
    """Half-away-from-zero rounding, in doubles throughout.

    The value is first brought to whole thousandths of the last digit, so a tie is a tie.
    """
    fine = f"rint(({value}) * {_scale(digits + GUARD_DIGITS)})"
    return f"(round({fine} / {10**GUARD_DIGITS}D, 0) / {_scale(digits)})"


def ratio(top: str, bottom: str) -> str:
    """``top / bottom`` as double, NULL where ``bottom`` is zero."""
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0D))"


def clip(value: str, low: str, high: str) -> str:
    """Limit to [low, high]; NULL stays NULL (greatest/least alone would skip it)."""
    return f"CASE WHEN ({value}) IS NOT NULL THEN greatest({low}, least({high}, {value})) END"


def imply(condition: str) -> str:
    """A condition on a missing reading counts as not met."""
    return f"coalesce({condition}, false)"
