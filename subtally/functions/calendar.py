"""SQL expressions for month arithmetic on DATE columns that hold the first day of a month."""

from __future__ import annotations


def month_of(ts: str) -> str:
    return f"trunc({ts}, 'MM')"


def months_between(start: str, end: str) -> str:
    """Whole months from one month to another."""
    return f"((year({end}) - year({start})) * 12 + month({end}) - month({start}))"


def month_range(start: str, end: str) -> str:
    """All months from start to end inclusive; NULL when start is later (``sequence`` raises)."""
    return f"if({start} <= {end}, sequence({start}, {end}, INTERVAL 1 MONTH), NULL)"
