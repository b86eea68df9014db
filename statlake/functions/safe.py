"""Casts that test the text first.

A failing ``try_cast`` raises and catches inside the engine, which costs far
more than the cast itself; on feeds full of ``-`` and blanks that dominates the
scan. These helpers check the form and then cast text that is known to be good.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def digits_to_int(c: Column) -> Column:
    """Int of a text that is either digits (nine at most) or empty."""
    return F.nullif(c, F.lit("")).cast("int")


def to_int(c: Column) -> Column:
    """Int of a plain integer in range, else null."""
    n = F.when(c.rlike("^[+-]?[0-9]{1,10}$"), c).cast("bigint")
    return F.when(n.between(-2147483648, 2147483647), n).cast("int")


def to_double(c: Column) -> Column:
    low = F.lower(c)
    special = (F.when(low.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
               .when(low.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
               .when(low.isin("-inf", "-infinity"), F.lit(float("-inf"))))
    plain = c.rlike(NUMBER)
    return F.when(plain, F.when(plain, c).cast("double")).otherwise(special)


def double_to_int(n: Column) -> Column:
    return F.when((n > -2147483649.0) & (n < 2147483648.0), n).cast("int")


def to_bigint(c: Column, n: Column) -> Column:
    """Exact for plain integers, through the double value otherwise."""
    whole = F.when(c.rlike("^[+-]?[0-9]{1,18}$"), c).cast("bigint")
    wide = F.when(c.rlike("^[+-]?[0-9]{19,38}$"), c).cast("decimal(38,0)")
    in_range = wide.between(F.lit("-9223372036854775808").cast("decimal(38,0)"), F.lit("9223372036854775807").cast("decimal(38,0)"))
    other = F.when(~c.rlike("^[+-]?[0-9]+$") & (F.abs(n) < 9.2e18), n).cast("bigint")
    return F.coalesce(whole, F.when(in_range, wide).cast("bigint"), other)


def to_timestamp(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{4}-[0-9]{2}"), c).try_cast("timestamp")


def to_date(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{4}-[0-9]{2}"), c).try_cast("date")
