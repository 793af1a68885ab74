"""Scalar column functions used by the operators (P01-P03, P06, P07,
P15-P19, M19). All return ``Column`` objects; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from matchlab.schemas import LABEL_MAP

__all__ = [
    "col_of", "parse_date", "parse_bool", "to_int", "result_code", "goal_diff",
    "day_number", "pair_a", "pair_b", "flip_result", "label_code", "label_text",
    "pct_text", "day_month", "result_text", "neutral_default",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String -> DATE; malformed text gives null (ANSI-safe)."""
    return F.try_to_date(col_of(c), fmt)


def parse_bool(c) -> Column:
    """P02: 'TRUE'/'FALSE' (any case) -> boolean; anything else null."""
    return col_of(c).try_cast("boolean")


def to_int(c) -> Column:
    """Numeric or text -> int, truncating; bad values null."""
    return col_of(c).try_cast("int")


def result_code(home, away) -> Column:
    """P06: 'W'/'D'/'L' from the home side. Null when a score is null
    (callers drop null scores first)."""
    h, a = col_of(home), col_of(away)
    return (F.when(h > a, F.lit("W")).when(h == a, F.lit("D"))
            .when(h < a, F.lit("L")))


def goal_diff(home, away) -> Column:
    """P07."""
    return col_of(home) - col_of(away)


def day_number(c) -> Column:
    """Days since 1970-01-01: the integer order key of calendar frames
    (time-zone free, unlike epoch seconds)."""
    return F.unix_date(col_of(c))


def pair_a(x, y) -> Column:
    """Alphabetically first team of a pair."""
    return F.least(col_of(x), col_of(y))


def pair_b(x, y) -> Column:
    return F.greatest(col_of(x), col_of(y))


def flip_result(c) -> Column:
    """W<->L, D stays."""
    r = col_of(c)
    return F.when(r == "W", "L").when(r == "L", "W").otherwise(r)


def label_code(c) -> Column:
    """W/D/L -> 0/1/2 (double, as MLlib wants)."""
    r = col_of(c)
    expr = None
    for k, v in LABEL_MAP.items():
        expr = (F.when(r == k, F.lit(float(v))) if expr is None
                else expr.when(r == k, F.lit(float(v))))
    return expr


def label_text(c) -> Column:
    """P19 inverse: 0/1/2 -> W/D/L."""
    x = col_of(c).cast("int")
    expr = None
    for k, v in LABEL_MAP.items():
        expr = F.when(x == v, F.lit(k)) if expr is None else expr.when(x == v, F.lit(k))
    return expr


def pct_text(c, digits: int = 1) -> Column:
    """0.4567 -> '45.7%'. Rounded half up as a whole number first, so the
    text doesn't depend on how an engine rounds or formats binary ties."""
    scale = 10 ** digits
    t = F.floor(col_of(c) * float(100 * scale) + 0.5).cast("bigint")
    return F.format_string(f"%d.%0{digits}d%%", F.floor(t / scale).cast("bigint"), t % scale)


def day_month(c) -> Column:
    """Date -> 'dd MMM'."""
    return F.date_format(col_of(c), "dd MMM")


def result_text(result, home, away) -> Column:
    """M19: 'X Wins' / 'Draw' for a W/D/L code."""
    r = col_of(result)
    return (F.when(r == "W", F.concat(col_of(home), F.lit(" Wins")))
            .when(r == "L", F.concat(col_of(away), F.lit(" Wins")))
            .when(r == "D", F.lit("Draw")))


def neutral_default(stem: str, unknown_rate: float, unknown_other: float) -> Column:
    """Default for a team without form data: rate columns get
    ``unknown_rate``, all others ``unknown_other``."""
    return F.lit(float(unknown_rate if "rate" in stem else unknown_other))
