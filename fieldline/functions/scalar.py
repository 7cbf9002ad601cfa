"""Scalar Column expressions. All JVM-side built-ins: no Python UDFs anywhere."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldline.functions.constants import NAN_STRINGS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den with a zero (or NULL) denominator giving NULL, never an ANSI error."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den), F.lit(0)).cast("double"))


def non_empty(c: str | Column) -> Column:
    """Terminal-event predicate: present and not the empty string."""
    c = col(c)
    return c.isNotNull() & (c != F.lit(""))


def null_safe_greatest(a: Column, b: Column) -> Column:
    """Element-wise maximum that propagates NULL like numpy's maximum propagates NaN."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def line_to_prob(line: str | Column) -> Column:
    """American money line -> implied win probability; line 0 -> 0.5.

    (1 - sgn) / 2 + sgn * 100 / (|line| + 100)
    """
    line = col(line).cast("double")
    sgn = F.signum(line)
    return (F.lit(1.0) - sgn) / F.lit(2.0) + sgn * (F.lit(100.0) / (F.abs(line) + F.lit(100.0)))


def mid_probability(prob_home: str | Column, prob_visitor: str | Column) -> Column:
    """Average of the home probability and one minus the visitor probability."""
    return (col(prob_home) + (F.lit(1.0) - col(prob_visitor))) / F.lit(2.0)


def team_obp(h, bb, ab) -> Column:
    """On-base rate of a team log: (h + bb) / (bb + ab); no HBP or SF in the source."""
    return safe_div(col(h) + col(bb), col(bb) + col(ab))


def yyyymmdd(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyyMMdd")


def game_key(date_text: str | Column, game_num: str | Column) -> Column:
    """Integer key ``yyyymmdd`` followed by the game number of the day."""
    return F.concat(col(date_text).cast("string"), col(game_num).cast("string")).cast("long")


def roster_hash(ids: str | Column) -> Column:
    """MD5 of the ids sorted as text and joined by '|'."""
    as_text = F.transform(col(ids), lambda x: x.cast("string"))
    return F.md5(F.array_join(F.array_sort(as_text), "|"))


def lenient_number(c: str | Column, to: str = "double") -> Column:
    """Cast text to a number; anything unparsable becomes NULL instead of an ANSI error."""
    return F.try_cast(col(c), to) if hasattr(F, "try_cast") else col(c).try_cast(to)


def lenient_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse a date with an explicit format; unparsable text becomes NULL."""
    return F.try_to_date(col(c).cast("string"), fmt)


def null_if_nan(c: str | Column, data_type: str) -> Column:
    """NaN and NaN-like text -> NULL; other values unchanged."""
    c = col(c)
    if data_type in ("double", "float"):
        return F.when(~F.isnan(c), c)
    if data_type == "string":
        return F.when(~c.isin(NAN_STRINGS), c)
    return c


def format_timestamp(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def key_text(*parts: str | Column, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[col(p).cast("string") for p in parts])
