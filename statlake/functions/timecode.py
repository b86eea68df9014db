"""Time codes of statistics feeds (``2020Q1``, ``FY2020``, ``令和2年`` ...).

The parser reduces a code to its *shape* (every digit becomes ``9``) with one
``translate``; each known notation is then an equality test on the shape plus
substrings at fixed positions. No regular expression runs for the regular
notations, and the whole parser is one codegen-friendly expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statlake.functions.safe import digits_to_int

FULL_WIDTH = "０１２３４５６７８９"
ASCII = "0123456789"


def ascii_digits(c: Column) -> Column:
    return F.translate(c, FULL_WIDTH, ASCII)


def strip(c: Column) -> Column:
    """Trim all Unicode white space, U+3000 included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


# Fixed values. Shape -> (type, position of the year, month, day and period digit,
# months per period, month the sort key starts with); 0 where there is none.
NOTATIONS = {
    "9999": ("year", 1, 0, 0, 0, 0, 1),
    "9999Q9": ("quarter", 1, 0, 0, 6, 3, 1), "9999-Q9": ("quarter", 1, 0, 0, 7, 3, 1),
    "9999-99": ("month", 1, 6, 0, 0, 0, 1), "999999": ("month", 1, 5, 0, 0, 0, 1),
    "9999-99-99": ("day", 1, 6, 9, 0, 0, 1), "99999999": ("day", 1, 5, 7, 0, 0, 1),
    "9999FY": ("fiscal_year", 1, 0, 0, 0, 0, 4), "FY9999": ("fiscal_year", 3, 0, 0, 0, 0, 4),
    "FY9999FY": ("fiscal_year", 3, 0, 0, 0, 0, 4),
    "9999CY": ("calendar_year", 1, 0, 0, 0, 0, 1), "CY9999": ("calendar_year", 3, 0, 0, 0, 0, 1),
    "CY9999CY": ("calendar_year", 3, 0, 0, 0, 0, 1),
    "9999H9": ("half_year", 1, 0, 0, 6, 6, 1),
}
# The year before the first year of each era.
ERAS = {"令和": 2018, "平成": 1988}

FIELDS = ["time_original", "time_year", "time_month", "time_quarter", "time_type", "time_sort_key"]


def _notation(shape: Column) -> Column:
    names = ["kind", "y", "m", "d", "p", "step", "first"]
    entries = [x for k, v in NOTATIONS.items()
               for x in (F.lit(k), F.struct(*[F.lit(u).alias(n) for n, u in zip(names, v)]))]
    return F.try_element_at(F.create_map(*entries), shape)


def computed_once(df: DataFrame, columns: list[Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Append columns through ``inline`` of a one-element array.

    The generator keeps the optimizer from copying the expressions into every
    later use (a filter on a parsed field would otherwise repeat the parser),
    and it stays inside whole-stage code generation.
    """
    kept = [F.col(c) for c in df.columns if c not in drop]
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def with_time(df: DataFrame, column: str) -> DataFrame:
    """Add the six time fields of a code column.

    Table-driven and staged: the shape selects a notation, the notation says
    where the parts are. Steps stay small enough for the JIT compiler.
    """
    kept = [F.col(c) for c in df.columns]
    text = strip(F.nullif(F.col(column), F.lit("")))
    read = computed_once(df, [text.alias("_text"), F.upper(ascii_digits(text)).alias("_code")])
    code, note = F.col("_code"), F.col("_note")
    read = computed_once(read, [_notation(F.translate(code, ASCII, "9" * 10)).alias("_note")])

    def part(name, length):
        return F.when(note[name] > 0, code.substr(note[name], F.lit(length))).cast("int")

    plain = F.when(note.isNotNull(), code.substr(note["y"], F.lit(4))).otherwise(
        F.regexp_extract(code, "([0-9]{4})", 1))
    era = F.when(note.isNull(), digits_to_int(
        F.regexp_extract(code, "^(?:" + "|".join(ERAS) + ")([0-9]{1,9})年?$", 1)))
    parts = computed_once(read, [digits_to_int(plain).alias("_year"), era.alias("_era"), part("m", 2).alias("_m"),
                                 part("d", 2).alias("_d"), part("p", 1).alias("_p")])
    m, d, p = F.col("_m"), F.col("_d"), F.col("_p")
    fits = (F.coalesce(m.between(1, 12), F.lit(True)) & F.coalesce(d.between(1, 31), F.lit(True))
            & F.coalesce((p > 0) & (p * note["step"] <= 12), F.lit(True)))
    before = F.lit(None).cast("int")
    for name, year in ERAS.items():
        before = F.when(code.startswith(name), year).otherwise(before)
    kind = F.when(note.isNotNull() & fits, note["kind"]).when(F.col("_era").isNotNull(), "japanese_year").otherwise("unknown")
    staged = computed_once(parts, [
        kind.alias("_kind"), F.when(F.col("_era").isNotNull(), F.col("_era") + before).otherwise(F.col("_year")).alias("_y"),
        F.when(fits, F.coalesce(m, (p - 1) * note["step"] + 1)).alias("_start")], ("_year", "_era"))
    kind, year, start = F.col("_kind"), F.col("_y"), F.col("_start")
    key = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"),
                      F.lpad(F.coalesce(start, note["first"], F.lit(1)).cast("string"), 2, "0"),
                      F.lpad(F.coalesce(d, F.lit(1)).cast("string"), 2, "0"))
    loose = F.when(F.coalesce(year, F.lit(0)) != 0, F.concat(year.cast("string"), F.lit("-01-01"))).otherwise(F.col("_text"))
    out = computed_once(staged, [
        F.col("_text").alias("time_original"), year.alias("time_year"),
        F.when(kind.isin("month", "day"), m).alias("time_month"),
        F.when(start.isNotNull(), ((start + 2) / 3).cast("int")).alias("time_quarter"), kind.alias("time_type"),
        F.when(kind == "unknown", loose).otherwise(key).alias("time_sort_key")],
        ("_text", "_code", "_note", "_m", "_d", "_p", "_kind", "_y", "_start"))
    return out.select(*kept, *FIELDS)


def loose_year(c: Column) -> Column:
    """First run of four digits anywhere, 2020 if there is none."""
    return F.coalesce(digits_to_int(F.regexp_extract(ascii_digits(c), "([0-9]{4})", 1)), F.lit(2020))


def loose_quarter(c: Column) -> Column:
    return F.coalesce(digits_to_int(F.regexp_extract(ascii_digits(F.upper(c)), "Q([1-4])", 1)), F.lit(0))


def loose_month(c: Column) -> Column:
    """``dddd-dd``, then eight digits, then six; any two digits pass as a month."""
    d = ascii_digits(c)
    size = F.length(d)

    def first(pattern, worth_trying):
        return digits_to_int(F.when(worth_trying, F.regexp_extract(d, pattern, 1)))
    return F.coalesce(first("[0-9]{4}-([0-9]{2})", d.contains("-")), first("[0-9]{4}([0-9]{2})[0-9]{2}", size >= 8),
                      first("[0-9]{4}([0-9]{2})", size >= 6), F.lit(0))


def year_bounds(start: str | None, end: str | None) -> Column:
    """A raw time range as a condition on the ``year`` partition column, so that scans prune."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col("year") >= int(start[:4]))
    if end:
        cond = cond & (F.col("year") <= int(end[:4]))
    return cond
