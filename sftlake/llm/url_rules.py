"""URL filters. Every rule is a regular expression over ``host + path`` together with the
literal tokens any match must hold; where a match holds one of several tokens, by alternatives
of the expression, the literal is the tuple of them. A rule is filed under its rarest literal, by
counts over all urls, and there under each alternative; a url's tokens fetch the rules filed under
them, and only those run their regex.

The rules form a bounded constant (``MAX_RULES``) with a slot per token hash, so a lookup
takes constant time inside the row: no join, no shuffle, no row key. Null, empty and repeated
urls and extra columns are kept as they are, except that columns named host, path, rule, pattern
or verdict are replaced; an empty table gives an empty result. ``read_rules`` reads rule files."""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.llm.common import letters_lower

MAX_RULES = 100_000
_INDEX = "array<array<struct<token:string,rule:string,regex:string,verdict:string,site:boolean,rank:int>>>"


@dataclass(frozen=True)
class Rule:
    """``site`` rules (host and path prefix) outrank patterns; the longest name wins among
    them, and the earlier rule among equals. Of the patterns, the first that fits decides."""

    name: str
    regex: str
    literals: tuple[str | tuple[str, ...], ...]
    verdict: str
    site: bool = False

    def alternatives(self) -> list[tuple[str, ...]]:
        """The literals, each as the tokens of which a match holds one."""
        return [(t,) if isinstance(t, str) else t for t in self.literals]


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the url's path starts with ``path``."""
    whole = re.split(r"[^a-z0-9]+", (host + path).lower())
    if re.search(r"[A-Za-z0-9]$", path):
        whole = whole[:-1]  # the last token of the prefix may go on in the url
    regex = r"^([^/]*\.)?" + _quoted(host) + _quoted(path)
    return Rule(host + path, regex, tuple(t for t in whole if t), verdict, True)


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", s)


def pattern_rule(name: str, regex: str, *literals: str | tuple[str, ...], verdict: str = "block") -> Rule:
    return Rule(name, regex, literals, verdict)


RULE_SCHEMA = "verdict string, host string, path string, name string, regex string, literals array<array<string>>"


def read_rules(spark: SparkSession, path: str | list[str]) -> list[Rule]:
    """Rules from JSON lines, in the order of files (by name) and lines. A line is a site rule,
    {"verdict", "host", "path"}, path "/" if missing, or a pattern, {"verdict", "name", "regex",
    "literals"}, literals being a list of lists of tokens: of each inner list a match holds
    one. Blank lines are skipped; a malformed line, a verdict other than allow and block, a
    pattern without literals and more than ``MAX_RULES`` rules are errors. No file, no rules."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"))
    rows = lines.select(place.alias("p"), F.from_json("value", RULE_SCHEMA, {"mode": "FAILFAST"}).alias("r")).limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules in {path}")
    return [_read_rule(r["r"]) for r in sorted(rows, key=lambda r: tuple(r["p"]))]


def _read_rule(r) -> Rule:
    if r["verdict"] not in ("allow", "block") or (r["host"] is None) == (r["regex"] is None):
        raise ValueError(f"a rule has a verdict and either a host or a regex: {r.asDict()}")
    if r["host"] is not None:
        return site_rule(r["host"].lower(), r["path"] or "/", r["verdict"])
    if not r["literals"] or not all(r["literals"]):
        raise ValueError(f"rule {r['name']!r} has no literal token")
    return pattern_rule(r["name"] or r["regex"], r["regex"], *[tuple(t.lower() for t in alt) for alt in r["literals"]], verdict=r["verdict"])


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path`` (empty for a null url or one without ``://``)."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(u)), r"^[^?#]*", 0)
    return df.withColumns({"host": letters_lower(host), "path": path})


def tokens(c: Column) -> Column:
    return F.array_distinct(F.split(F.lower(c), "[^a-z0-9]+"))


def literal_counts(df: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, int]:
    """How many urls hold each literal of the rules, over all rows; at most one row a literal."""
    words = sorted({t for r in rules for alt in r.alternatives() for t in alt})
    found = with_host_path(df.select(url), url).select(
        F.explode(F.array_intersect(tokens(F.concat("host", "path")), F.lit(words))).alias("token")
    )
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def _index(rules: list[Rule], counts: dict[str, int]) -> tuple[Column, int]:
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the constant index holds {MAX_RULES}")
    slots: list[list[dict]] = [[] for _ in range(max(16, 2 * len(rules)))]
    for rank, r in enumerate(rules):
        if not r.literals or not all(r.alternatives()):
            raise ValueError(f"rule {r.name!r} has no literal token")
        for token in min(r.alternatives(), key=lambda alt: (sum(counts.get(t, 0) for t in alt), alt)):
            slots[zlib.crc32(token.encode()) % len(slots)].append(
                {"token": token, "rule": r.name, "regex": r.regex, "verdict": r.verdict, "site": r.site, "rank": rank}
            )
    return F.from_json(F.lit(json.dumps(slots)), _INDEX), len(slots)


def url_filter(df: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Adds host, path, rule (the deciding site rule, else null), pattern (the deciding
    pattern, if no site rule fits) and verdict."""
    index, n = _index(rules, literal_counts(df, rules, url))
    out = with_host_path(df, url).withColumns({"__index": index, "__tokens": tokens(F.concat("host", "path"))})
    fits = (
        "filter(flatten(transform(__tokens, t -> filter("
        f"element_at(__index, cast(pmod(crc32(cast(t as binary)), {n}) as int) + 1), r -> r.token = t))), "
        "r -> concat(host, path) rlike r.regex)"
    )
    out = out.withColumn("__fits", F.expr(fits))
    site = F.expr(
        "array_max(transform(filter(__fits, r -> r.site), r -> struct(length(r.rule) as l, -r.rank as k, r.rule as rule, r.verdict as verdict)))"
    )
    first = F.expr("array_min(transform(filter(__fits, r -> not r.site), r -> struct(r.rank as k, r.rule as rule, r.verdict as verdict)))")
    out = out.withColumns({"__site": site, "__first": first})
    return out.withColumns(
        {
            "rule": F.col("__site.rule"),
            "pattern": F.when(F.col("__site").isNull(), F.col("__first.rule")),
            "verdict": F.coalesce("__site.verdict", "__first.verdict", F.lit(default)),
        }
    ).drop("__index", "__tokens", "__fits", "__site", "__first")


SITE_RULES = [
    site_rule("org", "/", "allow"),
    site_rule("example.org", "/es/", "block"),
    site_rule("example.org", "/en/1", "block"),
    site_rule("com", "/fr/", "allow"),
    site_rule("com", "/de/", "block"),
]
#: A start set of patterns over host + path.
PATTERNS = [
    pattern_rule("gambling-host", r"^([^/]*[.-])?casino[.-]", "casino"),
    pattern_rule("betting-host", r"^([^/]*[.-])?(sports-)?bet(ting)?-win[.-]", "win"),
    pattern_rule("adult-host", r"^([^/]*[.-])?xxx[.-]", "xxx"),
    pattern_rule("adult-path", r"/(adult|nsfw)/xxx(/|$)", "xxx"),
    pattern_rule("ad-server", r"^(ads|adserver)\.[^/]*/(banner|click)(/|$)", ("ads", "adserver")),
    pattern_rule("login", r"/(account|user|wp-admin)/login(\.[a-z]+)?$", "login"),
    pattern_rule("cart", r"/cart/checkout(/|$)", "cart", "checkout"),
    pattern_rule("feed", r"/feed/(rss|atom)\.xml$", "feed", "xml"),
]
