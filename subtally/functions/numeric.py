"""SQL expressions for ratios and rounding whose edge cases have to match other engines."""

from __future__ import annotations


def ratio(numerator: str, denominator: str) -> str:
    """IEEE division: x/0 is infinite and 0/0 is NaN, where ANSI Spark would raise; NULL stays NULL."""
    n, d = f"cast({numerator} AS double)", f"cast({denominator} AS double)"
    return (
        f"CASE WHEN {d} <> 0 THEN {n} / {d} WHEN {d} = 0 AND {n} = 0 THEN double('NaN') "
        f"WHEN {d} = 0 THEN signum({n}) * double('Infinity') END"
    )


def round_scaled(value: str, digits: int) -> str:
    """Round a double by scaling first, so 1.005 gives 1.0; Spark's own ``round`` gives 1.01."""
    scale = float(10**digits)
    return f"round(cast({value} AS double) * double({scale}), 0) / double({scale})"


def round_half_even(value: str, digits: int) -> str:
    scale = float(10**digits)
    return f"rint(cast({value} AS double) * double({scale})) / double({scale})"


def finite(value: str) -> str:
    """NULL in place of NaN and the infinities."""
    return f"if(isnan({value}) OR abs({value}) = double('Infinity'), NULL, {value})"
