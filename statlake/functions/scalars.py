"""Value parsing, casts, naming and small scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from statlake import rules
from statlake.functions.safe import double_to_int, to_bigint, to_double, to_int, to_timestamp
from statlake.functions.timecode import ascii_digits, strip


def _number(c: Column) -> Column:
    """Double for text that is a plain decimal number, else null."""
    t = ascii_digits(strip(c))
    return to_double(F.when(t.contains("_"), F.regexp_replace(t, "(?<=[0-9])_(?=[0-9])", "")).otherwise(t))


def parse_value(c: Column) -> Column:
    """Observation value; anything that is not a number becomes 0.0."""
    return F.coalesce(_number(F.translate(c, ",", "")), F.lit(0.0))


def cast_value(c: Column, target: str) -> Column:
    """Typed cast of a text value; failures become null."""
    n = _number(F.translate(c, ",", ""))
    if target == "INT":
        return double_to_int(n)
    if target == "BIGINT":
        return to_bigint(F.translate(c, ",", ""), n)
    if target == "DOUBLE":
        return n
    if target == "BOOLEAN":
        return F.lower(c).isin("true", "1", "yes")
    return c.cast("string")


def infer_scalar_type(c: Column) -> Column:
    d = ascii_digits(c)
    return (F.when(d.rlike("^-?[0-9]+$"), "INT")
            .when(d.rlike(r"^-?[0-9]+[.][0-9]+$"), "DOUBLE")
            .when(d.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), "TIMESTAMP")
            .otherwise("STRING"))


def normalize_name(c: Column) -> Column:
    """Column name from free text: ASCII letters, digits and single underscores."""
    ascii_only = F.regexp_replace(c, r"[^\x00-\x7F]+", "")
    word = F.lower(F.regexp_replace(ascii_only, "[^a-zA-Z0-9_]", "_"))
    word = F.trim(F.regexp_replace(word, "_+", "_"), F.lit("_"))
    return F.when(word == "", "column").otherwise(word)


def normalize_field(c: Column) -> Column:
    """``@cat01`` to ``category_01``; other fields lose the ``@`` and case."""
    bare = F.regexp_replace(c, "^@+", "")
    return F.lower(F.regexp_replace(bare, "^cat([0-9]+)$", "category_$1"))


def normalize_dimension(c: Column) -> Column:
    """Same for dimension ids of the metadata, where ``tab`` holds the indicator."""
    number = F.regexp_extract(c, "^cat(0[1-9]|10)$", 1)
    return (F.when(c == "tab", "indicator")
            .when(number != "", F.concat(F.lit("category_"), number))
            .otherwise(c))


def field_description(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in rules.FIELD_DESCRIPTIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, c), F.concat(F.lit("フィールド: "), c))


# --- words and classes ----------------------------------------------------------

def has_any(c: Column, words: list[str]) -> Column:
    """True if the text contains one of the (metacharacter-free) words."""
    return c.rlike("|".join(words))


def first_class(c: Column, table, default: str) -> Column:
    """Name of the first entry of an ordered word table that occurs in the text."""
    out = None
    for name, words in table:
        hit = has_any(c, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def landing_domain(title: Column) -> Column:
    return first_class(F.lower(F.coalesce(title, F.lit(""))), rules.DOMAIN_WORDS_LANDING, "generic")


def listing_domain(title: Column) -> Column:
    return first_class(F.coalesce(title, F.lit("")), rules.DOMAIN_WORDS_LISTING, "generic")


def catalog_domain(title: Column, search_keyword: Column) -> Column:
    both = F.concat_ws("\n", F.lower(title), F.lower(search_keyword))
    return first_class(both, rules.DOMAIN_WORDS_CATALOG, "other")


def update_frequency(title: Column) -> Column:
    return first_class(title, rules.FREQUENCY_WORDS, "irregular")


def listing_priority(title: Column, updated: Column) -> Column:
    points = (F.lit(5) + F.when(has_any(title, rules.CORE_STATISTICS_WORDS), 3).otherwise(0)
              + F.when(has_any(title, rules.FREQUENT_WORDS), 2).otherwise(0)
              + F.when(updated >= rules.RECENT_FROM, 1).otherwise(0))
    return F.least(F.lit(10), points)


def importance(priority: Column) -> Column:
    return F.when(priority >= 8, "high").when(priority >= 5, "medium").otherwise("low")


def selection_score(title: Column, updated: Column) -> Column:
    """Freshness, coverage and frequency points of a dataset for a domain selection."""
    year = to_int(F.substring(updated, 1, 4))
    low = F.lower(title)
    points = F.lit(0)
    for word, p in reversed(rules.FREQUENCY_POINTS):
        points = F.when(low.contains(word), p).otherwise(points)
    return (F.greatest(F.coalesce((year - 2020) * 10, F.lit(0)), F.lit(0))
            + F.when(has_any(low, rules.COVERAGE_WORDS), 20).otherwise(0) + points).cast("double")


def candidate_score(title: Column, description: Column, size: Column, *, prefer_time: bool = True,
                    diverse_sizes: bool = True, min_records: int = 100, max_records: int | None = None) -> Column:
    score = F.lit(0)
    if prefer_time:
        timely = has_any(F.lower(title), rules.TIME_WORDS) | has_any(F.lower(description), rules.TIME_WORDS)
        score = score + F.when(timely, 10).otherwise(0)
    if diverse_sizes:
        score = score + (F.when(size.between(1000, 100000), 5)
                         .when((size >= 100) & (size < 1000), 3)
                         .when(size > 100000, 2).otherwise(0))
    score = score - F.when(size < min_records, 100).otherwise(0)
    if max_records:
        score = score - F.when(size > max_records, 50).otherwise(0)
    return score + F.when((F.length(title) > 10) & (F.length(description) > 50), 2).otherwise(0)


# --- errors ----------------------------------------------------------------------

def error_type(message: Column, class_name: Column | None = None) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    cls = F.lower(F.coalesce(class_name, F.lit(""))) if class_name is not None else F.lit("")
    out = None
    for name, words, class_words in rules.ERROR_WORDS:
        hit = has_any(text, words)
        if class_words:
            hit = hit | has_any(cls, class_words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown_error")


def is_retryable(kind: Column) -> Column:
    return kind.isin(rules.RETRYABLE_ERRORS)


def retry_delay(attempt: Column, base: float = 1.0, maximum: float = 60.0) -> Column:
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(maximum)))


# --- tags and names ----------------------------------------------------------------

def tags(domain: Column, source: str, column_count: Column) -> Column:
    return F.array_compact(F.array(
        F.when(domain != "", F.concat(F.lit("domain:"), domain)),
        F.lit(f"source:{source}"), F.lit("official"),
        F.when(column_count > 10, F.lit("rich_schema"))))


def dynamic_table_name(dataset_id: Column) -> Column:
    return F.concat(F.lit("dataset_"), F.replace(dataset_id, F.lit("-"), F.lit("_")))


def domain_table_name(domain: Column) -> Column:
    return F.concat(domain, F.lit("_data"))


def table_location(root: str, domain: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), domain, F.lit("/"))


def transformed_path(root: str, domain: Column, dataset_id: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/processed/"), domain, F.lit("/"), dataset_id, F.lit(".json"))


# --- landed text -------------------------------------------------------------------

def text_of(v: Column, path: str) -> Column:
    """Text at a path of a VARIANT where the node is either text or ``{"$": text}``."""
    inner = F.try_variant_get(v, f'{path}["$"]', "string")
    plain = F.when(F.schema_of_variant(F.coalesce(F.try_variant_get(v, path, "variant"),
                                                  F.parse_json(F.lit("null")))).startswith("OBJECT"),
                   F.lit(None)).otherwise(F.try_variant_get(v, path, "string"))
    return F.coalesce(inner, plain, F.lit(""))


def growth_percent(now: Column, before: Column, digits: int = 2) -> Column:
    """Percent change; null where there is nothing to compare with or it is zero."""
    return F.round(F.try_divide(now - before, before) * 100, digits)


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text to a timestamp, null if it is not one."""
    return to_timestamp(c)
