"""Tokens, keyword extraction and keyword scores as array expressions.

Each works inside one row: no explode, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from statlake import rules

TOKEN_BREAK = r"(?U)[、。・\s]+"
TOKEN_BREAK_BRACKETS = r"(?U)[、。・\s（）()]+"


def literal_array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def tokens(c: Column, pattern: str = TOKEN_BREAK) -> Column:
    """Distinct tokens of two or more characters, in order of appearance."""
    parts = F.split(F.coalesce(c, F.lit("")), pattern)
    return F.array_distinct(F.filter(parts, lambda t: F.length(t) >= 2))


def english_keywords(words: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in rules.ENGLISH_KEYWORDS.items() for x in kv])
    return F.array_compact(F.transform(words, lambda w: F.try_element_at(known, w)))


def filter_keywords(words: Column) -> Column:
    kept = F.array_except(words, literal_array(rules.KEYWORD_STOPWORDS))
    return F.filter(kept, lambda w: F.length(w).between(2, 20))


def keyword_score(word: Column, statistics_name: Column, title: Column) -> Column:
    low, n = F.lower(word), F.length(word)
    return (F.when(F.lower(statistics_name).contains(low), 10).otherwise(0)
            + F.when(F.lower(title).contains(low), 5).otherwise(0)
            + F.when(n.between(3, 6), 5).when(n.between(2, 8), 3).when(n > 8, 1).otherwise(0)
            + F.when(word.isin(rules.CATEGORY_KEYWORDS), 5).otherwise(0)
            + F.when(word.rlike(r"^[\x00-\x7F]*$"), 2).otherwise(0))


def extract_keywords(stat_name: Column, statistics_name: Column, title: Column, main_category: Column,
                     sub_category: Column, organization: Column, limit: int = 15) -> Column:
    """Best keywords of a dataset; equal scores are ordered by keyword."""
    whole = F.filter(F.array(main_category, sub_category, organization), lambda w: w.isNotNull() & (w != ""))
    words = F.array_distinct(F.concat(tokens(stat_name), tokens(statistics_name), tokens(title), whole))
    words = filter_keywords(F.array_distinct(F.concat(words, english_keywords(words))))
    ranked = F.array_sort(F.transform(words, lambda w: F.struct(
        (-keyword_score(w, F.coalesce(statistics_name, F.lit("")), F.coalesce(title, F.lit("")))).alias("s"),
        w.alias("w"))))
    return F.transform(F.slice(ranked, 1, limit), lambda x: x["w"])


def simple_keywords(texts: list[Column], whole: list[Column], dimension_names: Column | None = None,
                    limit: int = 20) -> Column:
    """Sorted keywords without technical codes such as ``F1101``."""
    split = F.flatten(F.array(*[tokens(t, TOKEN_BREAK_BRACKETS) for t in texts]))
    split = F.filter(split, lambda t: F.length(t).between(2, 20) & ~t.rlike("^[A-Z][0-9]+"))
    parts = [split, F.filter(F.array(*whole), lambda w: w.isNotNull() & (F.length(w) >= 2))]
    if dimension_names is not None:
        parts.append(F.filter(dimension_names, lambda w: (F.length(w) >= 2) & ~w.rlike("^[A-Z]　")))
    words = F.array_except(F.concat(*parts), literal_array(rules.SIMPLE_KEYWORD_STOPWORDS))
    return F.slice(F.array_sort(words), 1, limit)


def keyword_quality(title: Column, keywords: Column) -> Column:
    """struct(coverage, relevance, diversity, overall), two decimals."""
    low = F.lower(F.coalesce(title, F.lit("")))
    words = tokens(low)
    covered = F.size(F.filter(words, lambda w: F.exists(keywords, lambda k: F.lower(k).contains(w))))
    relevant = F.size(F.filter(keywords, lambda k: low.contains(F.lower(k))))
    coverage = F.coalesce(F.try_divide(covered, F.size(words)), F.lit(0.0))
    relevance = F.coalesce(F.try_divide(relevant, F.size(keywords)), F.lit(0.0))
    letters = F.filter(F.array_distinct(F.split(F.concat_ws("", keywords), "")), lambda ch: ch != "")
    diversity = F.least(F.size(letters) / F.lit(50.0), F.lit(1.0))
    overall = (coverage + relevance + diversity) / 3
    return F.struct(*[F.bround(v, 2).alias(n) for n, v in [
        ("coverage", coverage), ("relevance", relevance), ("diversity", diversity), ("overall", overall)]])


def catalog_keywords(title: Column, description: Column) -> Column:
    """Distinct tokens of title and description, sorted so that the result is repeatable."""
    return F.array_sort(F.array_distinct(F.concat(tokens(title), tokens(description))))


def ordered_matches(text: Column, table) -> Column:
    """Words of every entry of an ordered table whose key occurs in the text, flattened."""
    empty = F.array().cast("array<string>")
    return F.flatten(F.array(*[
        F.when(text.contains(key), literal_array(words)).otherwise(empty) for key, words in table]))


def expand_query(query: Column) -> Column:
    """The query, its tokens and the related words of its domains; ordered and distinct."""
    parts = F.filter(F.split(query, r"(?U)\s+"), lambda t: F.length(t) >= 2)
    return F.array_distinct(F.concat(F.array(query), parts, ordered_matches(query, rules.QUERY_EXPANSIONS)))


def suggest(query: Column, top_domains: Column) -> Column:
    """At most five other words for a query: by domain, else the largest domains, else fixed ones."""
    related = ordered_matches(query, rules.QUERY_SUGGESTIONS)
    popular = F.transform(top_domains, lambda d: F.concat(d, F.lit(rules.RELATED_DATA_SUFFIX)))
    words = (F.when(F.size(related) > 0, related)
             .when(F.size(popular) > 0, popular)
             .otherwise(literal_array(rules.FALLBACK_SUGGESTIONS)))
    return F.slice(F.array_distinct(words), 1, 5)


def char_ngrams(c: Column, sizes) -> Column:
    """Character n-grams of the whole text, one array element per occurrence.

    One pass per size: an empty match with a look-ahead at every character. The
    first look-ahead skips the second half of characters beyond the basic plane.
    """
    return F.concat(*[F.regexp_extract_all(c, F.lit(r"(?s)(?!\p{Cs})(?=(.{%d}))" % n), F.lit(1)) for n in sizes])
