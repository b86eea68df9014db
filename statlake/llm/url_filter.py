"""URL filter: rules first, then trust and distrust carried over the host graph.

Pages that a rule fits get the rule's verdict. For all others the host decides:
personalised PageRank carries trust from hosts with allowed pages along links, and
distrust goes from hosts with blocked pages against links (a host that links to blocked
hosts earns distrust). Both start from the share of the host's own pages that rules
allow or block. A host hands its trust out in parts of its own links, and takes distrust
in the same parts: it does not depend on how many others link to the same hosts.

Defined results: null urls and urls without ``://`` have empty host and path and no
rule; a host without rules and links is allowed; self links carry nothing; mass of
hosts without links is not handed on; repeated pages count as often as they occur;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import ascii_lower
from statlake.session import materialise

LINKED_HOST = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_host(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as ``struct(text, verdict)``; null if none fits."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def parsed_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    return parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: links between different hosts, counted before they are shuffled."""
    links = pages.select(url_host(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINKED_HOST), F.lit(1))).alias("dst"))
    return (links.withColumn("dst", ascii_lower(F.col("dst"))).filter("src != '' AND src != dst")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def host_scores(pages: DataFrame, edges: DataFrame, rules: tuple[Rule, ...] = RULES, damping: float = 0.85,
                tolerance: float = 1e-6, max_iterations: int | None = None) -> DataFrame:
    """``host, trust, distrust`` at the fixed point of the propagations, to within ``tolerance``.

    An iteration shrinks the sum of all changes of trust, and the largest change of distrust, by
    ``damping`` at least, which bounds their number; it is an error to pass the bound (or
    ``max_iterations``). Every iteration is written to the shared folder and read back, so a lost
    executor costs one iteration at most; only the largest change reaches the driver.
    """
    verdict = F.col("found.verdict")
    keep = 1.0 - damping
    seeds = (parsed_pages(pages, rules).filter("host != ''").groupBy("host")
             .agg((F.count_if(verdict == "allow") / F.count("*") * keep).alias("trust0"),
                  (F.count_if(verdict == "block") / F.count("*") * keep).alias("distrust0")))
    seeds = materialise(seeds, "url-seeds")
    links_out = materialise(edges.groupBy("src").agg(F.sum("links").alias("out")), "url-links-out")      # a plain side: the join can split a hub
    edges = materialise(edges.join(links_out, "src").select("src", "dst", (F.col("links") / F.col("out") * damping).alias("part")), "url-edges")
    if max_iterations is None:
        mass = seeds.agg(F.sum("trust0"), F.lit(1.0)).first()
        max_iterations = 2 + math.ceil(math.log(tolerance / max(x or 0.0 for x in mass)) / math.log(damping))
    zero = F.lit(0.0)
    scores = ("trust", "distrust")
    own = seeds.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust"))
    state = own
    for _ in range(max_iterations):
        old = state.select("host", *[zero.alias(c) for c in scores], *[F.col(c).alias(f"{c}_was") for c in scores])
        given = edges.join(state.select(F.col("host").alias("src"), "trust"), "src").select("dst", F.col("trust") * F.col("part"), zero, zero, zero)
        earned = edges.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").select("src", zero, F.col("distrust") * F.col("part"), zero, zero)
        new = materialise(
            old.union(own.select("*", zero, zero)).union(given).union(earned).groupBy("host")
            .agg(*[F.sum(c).alias(c) for c in (*scores, *[f"{c}_was" for c in scores])]), "url-scores")
        change = new.agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"{c}_was")) for c in scores]))).first()[0]
        state = new.select("host", *scores)
        if change is None or change <= tolerance:
            break
    else:
        raise RuntimeError("scores did not settle")
    return state


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, damping: float = 0.85) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page.

    A host is blocked if its distrust exceeds its trust and reaches ``threshold``
    times what a host with nothing but blocked pages holds by itself.
    """
    scores = host_scores(pages, host_edges(pages), rules, damping)
    blocked = scores.filter((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold * (1.0 - damping)))
    blocked = materialise(blocked.select("host", F.lit("block").alias("host_verdict")), "url-blocked")
    return (parsed_pages(pages, rules).join(blocked, "host", "left")
            .select("page_id", "host", "path", F.col("found.text").alias("rule"),
                    F.coalesce(F.col("found.verdict"), F.col("host_verdict"), F.lit("allow")).alias("verdict")))
