"""Filtering URLs by pattern rules that are indexed by their rarest literal token.

Of each rule some whole tokens are known that every URL it fits must have. How many URLs have
each of these tokens is counted over the whole table, and the rule is filed under the rarest.
A URL's tokens then fetch the rules filed under them, and only those run their expression.

The index is a constant of the plan: an array of buckets by checksum of the token, so looking
up a token reads one bucket. Rows are judged where they are read, without any shuffle. A rule
without a known token is a candidate for every URL. Rules are a list a person or a feed writes;
with n rules the plan has n small constants.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = r"[./_-]"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is searched in the host followed by the path. ``tokens`` are parts between
    separators that every fitting URL has. Of fitting rules the one of the highest rank wins,
    then the longest name, then the last name in order."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int = 0


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """Fits a host and its subdomains where the path of the URL starts with ``path``."""
    name = host + path
    tokens = re.split(_SEPARATORS, name)
    whole = tokens if re.search(f"{_SEPARATORS}$", name) else tokens[:-1]  # the last may go on
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    if not path:
        whole, pattern = tokens, rf"{pattern}(?:/|$)"
    return UrlRule(name, pattern, verdict, tuple(t for t in whole if t), 1)


def word_rule(verdict: str, word: str) -> UrlRule:
    """Fits a host that has this word between separators."""
    pattern = rf"^(?:[^/]*[._-])?{re.escape(word)}(?:[._-][^/]*)?(?:/|$)"
    return UrlRule(f"*{word}*", pattern, verdict, (word,))


RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
    *(word_rule("block", w) for w in ("adult", "casino", "porn", "spam", "xxx")),
)
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host, A-Z in lower case, and the path before ``?`` and ``#``."""
    has = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    after = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _tokens() -> Column:
    return F.array_distinct(F.split(F.concat("host", "path"), _SEPARATORS))


def token_counts(parsed: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How many of all URLs have each of these tokens; as many numbers as the rules have tokens."""
    wanted = F.array_intersect(_tokens(), F.array(*[F.lit(t) for t in tokens]))
    found = parsed.select(F.explode(wanted).alias("token")).groupBy("token").count().collect()
    return {t: 0 for t in tokens} | {row["token"]: row["count"] for row in found}


def rule_index(rules: Sequence[UrlRule], counts: dict[str, int]) -> list[list[dict]]:
    """Buckets of rules, each filed under its rarest token; the last bucket has those without."""
    size = 1
    while size < 2 * len(rules):
        size *= 2
    index: list[list[dict]] = [[] for _ in range(size + 1)]
    for rule in rules:
        filed = {"rank": rule.rank, "length": len(rule.name), "rule": rule.name,
                 "verdict": rule.verdict, "pattern": rule.pattern}
        if rule.tokens:
            token = min(rule.tokens, key=lambda t: (counts[t], t))
            index[zlib.crc32(token.encode()) % size].append({"token": token, **filed})
        else:
            index[-1].append({"token": "", **filed})
    return index


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule] = RULES, default: str = DEFAULT, url_column: str = "url"
) -> DataFrame:
    """The columns of ``pages`` but the URL, and host, path, rule and verdict of each row.

    A null URL, or one without ``://``, has an empty host and path. ``rule`` is the name of
    the winning rule of rank 1 or more, else null; the verdict is that of the winning rule, or
    ``default``. Columns that have the names of new ones are replaced. Repeated rows are judged alike; without rules everything gets ``default``.
    """
    url = F.col(f"`{url_column}`")
    keep = [c for c in pages.columns if c not in (url_column, "host", "path", "rule", "verdict")]
    parsed = pages.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], url.alias("_url"))
    host, path = host_and_path(F.col("_url"))
    parsed = parsed.withColumns({"host": host, "path": path})
    tokens = sorted({t for rule in rules for t in rule.tokens})
    counts = token_counts(parsed, tokens) if tokens else {}

    buckets = rule_index(rules, counts)
    entry = "token string, rank int, length int, rule string, verdict string, pattern string"
    index = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<{entry.replace(' ', ':').replace(',:', ',')}>>>")

    def fetched(token: Column) -> Column:
        bucket = F.get(index, F.pmod(F.crc32(token), F.lit(len(buckets) - 1)).cast("int"))
        return F.filter(bucket, lambda r: r["token"] == token)

    candidates = F.concat(F.flatten(F.transform(_tokens(), fetched)), F.get(index, F.lit(len(buckets) - 1)))
    target = F.concat("host", "path")
    fitting = F.filter(candidates, lambda r: F.regexp_like(target, r["pattern"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(*[r[n].alias(n) for n in ("rank", "length", "rule", "verdict")])))
    judged = parsed.withColumn("_best", best)
    return judged.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        F.when(F.col("_best.rank") >= 1, F.col("_best.rule")).alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
