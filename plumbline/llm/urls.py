"""URL filtering: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` plus the literal tokens that every address it
fits must contain. Each rule is filed under the one of its tokens that the fewest addresses have; an
address's tokens fetch candidate rules by an equi-join, and only candidates run their expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, UPPER, free_name
from plumbline.session import materialize

# Tokens of an address are maximal runs of these characters.
_TOKEN_CHARS = r"0-9A-Za-z_\x80-\x{10FFFF}"
_TOKEN = re.compile(r"[0-9A-Za-z_\x80-\U0010FFFF]+")
# Filed here: rules without any literal token. Every address looks here as well.
_NO_TOKEN = ""


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` matches from the start of host + path; the highest ``rank`` that matches wins.

    ``tokens`` are whole tokens of every address the pattern can match.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int
    listed: bool


def path_rule(verdict: str, rule: str) -> UrlRule:
    """A host and path prefix such as ``example.com/en/``: the host itself and all subdomains."""
    followed = re.sub(r"[0-9A-Za-z_\x80-\U0010FFFF]+$", "", rule)  # the last may go on in the address
    tokens = tuple(dict.fromkeys(_TOKEN.findall(followed)))
    return UrlRule(rule, verdict, r"([^/]*\.)?" + re.escape(rule), tokens, 1_000_000 + len(rule), True)


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Sequence[str]) -> UrlRule:
    """An expression of its own; a listed path rule that fits outranks every one of them."""
    return UrlRule(name, verdict, pattern, tuple(tokens), len(pattern), False)


# The contract's rules (fixed values).
LISTED_RULES = (
    path_rule("allow", "com/"),
    path_rule("block", "example.com/en/"),
    path_rule("allow", "www.example.com/en/"),
    path_rule("block", "net/es/"),
    path_rule("block", "net/fr/"),
)
# Patterns for addresses that no listed rule fits.
OWN_RULES = (
    pattern_rule("spam host", "block", r"([^/]*[.-])?spam([.-][^/]*)?(/.*)?$", ["spam"]),
    pattern_rule("casino host", "block", r"([^/]*[.-])?casino([.-][^/]*)?(/.*)?$", ["casino"]),
    pattern_rule("ad host", "block", r"ads\.[^/]+(/.*)?$", ["ads"]),
    pattern_rule("tracker host", "block", r"([^/]*\.)?tracker\.[^/]+(/.*)?$", ["tracker"]),
    pattern_rule("login page", "block", r"[^/]*/(.*/)?login(\W.*)?$", ["login"]),
    pattern_rule("feed page", "block", r"[^/]*/(.*/)?feed/?$", ["feed"]),
)
DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or for a text without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    found = F.instr(url, "://") > 0
    after = r"(?s)^.*?://"
    host = F.translate(F.regexp_extract(url, after + r"([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, after + r"[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(found, host).otherwise(empty), F.when(found, path).otherwise(empty)


def tokens_of(address: Column) -> Column:
    words = F.split(address, f"[^{_TOKEN_CHARS}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def index_rules(addresses: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """One row per rule with the ``token`` it is filed under.

    ``addresses`` has one row per address and token. Only counts of the rules' own tokens are kept.
    """
    spark = addresses.sparkSession
    filed = spark.createDataFrame(
        [(i, r.name, r.verdict, "(?s)^" + r.pattern, r.rank, r.listed) for i, r in enumerate(rules)],
        "rule_no int, name string, rule_verdict string, pattern string, rank int, listed boolean")
    literals = spark.createDataFrame(
        [(i, t) for i, r in enumerate(rules) for t in (r.tokens or (_NO_TOKEN,))],
        "rule_no int, token string")
    counts = addresses.join(literals.select("token").distinct(), "token", "left_semi") \
        .groupBy("token").agg(F.count(F.lit(1)).alias("seen"))
    rarest = literals.join(counts, "token", "left").groupBy("rule_no").agg(
        F.min_by("token", F.struct(
            F.coalesce("seen", F.lit(0)), -F.length("token"), F.col("token"))).alias("token"))
    return filed.join(rarest, "rule_no")


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule] = LISTED_RULES + OWN_RULES, url: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``pattern_name`` and ``verdict``.

    ``rule`` names the listed rule that decided, ``pattern_name`` the pattern; both null where the
    default verdict holds. Every row of ``pages`` comes back once, repeated rows included. Null, empty
    and malformed addresses have empty host and path and get the default. Columns of ``pages`` with
    the names of result columns are replaced. An empty table gives an empty result.
    """
    results = ["host", "path", "rule", "pattern_name", "verdict"]
    key, won_by = free_name(pages, "address"), free_name(pages, "won")
    host, path = host_and_path(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in results]
    placed = pages.select(*kept, host.alias("host"), path.alias("path")) \
        .withColumn(key, F.concat("host", "path"))
    # Copies of an address, however many, are judged once.
    distinct = placed.where(F.col(key) != "").select(F.col(key).alias("address")).distinct()
    words = tokens_of(F.col("address"))
    if any(not r.tokens for r in rules):
        words = F.array_append(words, F.lit(_NO_TOKEN))
    # Only tokens that some rule names are kept.
    named = {_NO_TOKEN} | {t for r in rules for t in r.tokens}
    addresses = materialize(distinct.select("address", F.explode(words).alias("token"))
                            .where(F.col("token").isin(*named)), "url-tokens")
    index = materialize(index_rules(addresses, rules), "url-rules")
    decided = addresses.join(index, "token") \
        .where(F.expr("address rlike pattern")) \
        .groupBy("address").agg(F.max_by(
            F.struct("name", "rule_verdict", "listed"),
            F.struct(F.col("rank"), -F.col("rule_no"))).alias(won_by))
    judged = placed.join(decided.withColumnRenamed("address", key), key, "left")
    won = F.col(won_by)
    return judged.select(
        *kept, "host", "path",
        F.when(won["listed"], won["name"]).alias("rule"),
        F.when(~won["listed"], won["name"]).alias("pattern_name"),
        F.coalesce(won["rule_verdict"], F.lit(default)).alias("verdict"))
