"""Text, number and null rules shared by the operators. Every function builds a Column; none runs Python per row.

A missing column reads as '', and a null text as NULL_TEXT, because the rules were written for text forms of nulls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velonet.functions.geometry import let

#: How a null reads where a rule looks at text. 'nan' is the other usual form.
NULL_TEXT = "None"


def txt(df: DataFrame, name: str, null_text: str = NULL_TEXT) -> Column:
    """A column's text; absent columns are '', nulls are null_text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(null_text)) if name in df.columns else F.lit("")


def opt(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column, or null if the table has none of that name."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def low(c: Column) -> Column:
    return F.lower(strip(c))


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def contains_any(c: Column, parts: Iterable[str]) -> Column:
    """Null counts as not containing."""
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return F.coalesce(out, F.lit(False))


def among(c: Column, values: Iterable) -> Column:
    """isin() that is false, not null, for null."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def lookup(c: Column, table: Mapping[str, str], default: Column) -> Column:
    """The table's value for c, by one literal map."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), default)


def has_traffic_sign(value: Column, sign: str) -> Column:
    """Whether a coded sign list names the sign: 'DE:' and the sign anywhere, or the bare sign as a part after some 'DE:'."""
    parts = F.transform(F.split(value, ","), lambda x: F.trim(x))
    hit = value.contains(f"DE:{sign}") | (value.contains("DE:") & F.array_contains(parts, sign))
    return F.coalesce(hit, F.lit(False))


def round1(c: Column) -> Column:
    """One decimal of the number that the double is, not of its shortest text: 0.15 (a bit less) gives 0.1; halves go to the even.

    Ten times x is 8x + 2x, both exact; `off` is what their sum lost to rounding. Each value is bound where it is used more than once:
    Columns would repeat their expressions, and c's whole text rule with them."""

    def tenth(c: Column, ten: Column) -> Column:
        x = F.abs(c)
        part = ten - x * 8
        off = (x * 8 - (ten - part)) + (x * 2 - part)

        def pick(n: Column) -> Column:
            past = (ten - n - 0.5) + off
            up = F.when((past > 0) | ((past == 0) & (F.pmod(n, F.lit(2.0)) == 1)), 1.0).otherwise(0.0)
            return F.when(c < 0, -(n + up) / 10).otherwise((n + up) / 10)

        return F.when(x < 9e14, let(F.floor(ten).cast("double"), pick)).otherwise(c)

    return let(c, lambda c: let(F.abs(c) * 8 + F.abs(c) * 2, lambda ten: tenth(c, ten)))


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"


def number(c: Column) -> Column:
    """A text's number, null if it is none; other types as doubles."""
    return let(low(c.cast("string")), lambda t: F.when(t.rlike(NUMBER), t.try_cast("double")))


def whole(c: Column) -> Column:
    """The nearest whole number, halves to the even one."""
    return F.bround(c).cast("int")


def parse_width(value: Column, kind: str = "string") -> Column:
    """Metres with one decimal from texts like '2.5 m' or '3 meter'; the first of a ;-list. What is no number is null, and so is
    zero in a column of numbers (kind), where it stands for nothing given."""
    if kind != "string":
        x = value.cast("double")
        return F.when((x != 0) & ~F.isnan(x), round1(x))
    t = F.lower(strip(value))
    for unit in ("m", "eter", "tres"):
        t = F.replace(t, F.lit(unit), F.lit(""))
    return round1(number(strip(F.substring_index(t, ";", 1))))


def merge_key(c: Column, kind: str) -> Column:
    """The text form under which values count as equal when segments are merged; nulls are one value."""
    if kind in ("double", "float"):
        t = F.format_string("%.1f", round1(c.cast("double")))
    elif kind == "string":
        t = strip(c)
    else:
        t = c.cast("string")
    return F.when(c.isNull(), F.lit("NULL")).otherwise(t)


def last_two(c: Column) -> Column:
    """District code: the last two characters."""
    return F.right(c.cast("string"), F.lit(2))


def epoch_day(seconds: Column) -> Column:
    """dd.MM.yyyy of Unix seconds, in UTC whatever the session's time zone."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "dd.MM.yyyy")


def same_value(actual: Column, expected: Column) -> Column:
    """Type-tolerant equality of texts: words for true and false, numbers by value, else the text itself."""
    yes, no = ("true", "1", "yes", "ja"), ("false", "0", "no", "nein")
    a, e = low(actual), low(expected)
    as_bool = a.isin("true", "false") & e.isin(*yes, *no)
    as_number = a.try_cast("double").isNotNull() & e.try_cast("double").isNotNull()
    return F.coalesce(F.when(as_bool, a.isin(*yes) == e.isin(*yes)).when(as_number, a.try_cast("double") == e.try_cast("double")).otherwise(actual == expected), F.lit(False))
