"""URL filter: longest host and path rule first, else pattern rules found through a token index.

Pattern rules use the usual block-list notation: ``||`` anchors at the start of a host label, ``|`` at
the start or end, ``*`` matches anything, ``^`` a separator or the end, a leading ``@@`` makes an
exception. A rule's *literal tokens* are its runs of letters and digits that any matching URL must
hold as whole tokens. A rule is indexed by the literal token that is rarest in the corpus (counted
over all URLs), each URL fetches the rules of its own tokens, and only those run their regular
expression. A rule without a literal token is tried on every URL. Patterns see the URL with A-Z
lower-cased.

Only DataFrame functions run. The rules are a parameter, so the index is as large as that list.

Defined results: a NULL url or one without ``://`` has an empty host and path, no rule, and, as no
pattern applies to a missing url, the verdict ``allow`` (a url without ``://`` still meets the
patterns). Repeated rows repeat, a NULL page_id stays NULL, other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import empty_like, local_table

# Verdict, host, path.
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
PATTERN_RULES = (
    "||cheap-pills.",
    "||spam-farm.",
    "||casino.",
    "||casino-",
    "-casino.",
    "-casino-",
    "/casino/",
    "||bets.",
    "||bets-",
    "-bets.",
    "-bets-",
    "||betting.",
    "||betting-",
    "-betting.",
    "-betting-",
    "||adult.",
    "||adult-",
    "||ads.",
    "||ads-",
    "||adserver.",
    "||adserver-",
    "/viagra^",
    "/cialis^",
    "/payday-loans^",
    "/replica-watches^",
    "/wp-login.php^",
    "/login^",
    "/signup^",
    "/checkout^",
    "^sessionid=",
    "^phpsessid=",
    ".exe|",
    ".zip|",
    ".apk|",
    "/doubleclick.",
    "*xxx*porn*",
    "@@||health.*/viagra^",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "(?:[^a-z0-9_.%-]|$)"
TOKEN_GAP = "[^a-z0-9%]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def compile_rule(rule: str) -> tuple[str, str, list[str]]:
    """(``allow`` or ``block``, regular expression, literal tokens) of one pattern rule."""
    verdict = "allow" if rule.startswith("@@") else "block"
    body = rule.removeprefix("@@")
    host = body.startswith("||")
    begin = not host and body.startswith("|")
    body = body[2:] if host else body[1:] if begin else body
    end = body.endswith("|")
    body = body[:-1] if end else body
    marks = {"*": ".*", "^": SEPARATOR}
    regex = "".join(marks.get(c, re.escape(c)) for c in body)
    regex = ("^[a-z]+://(?:[^/?#]*[.])?" if host else "^" if begin else "") + regex + "$" * end
    tokens = []
    for found in re.finditer("[a-z0-9%]+", body):
        # A run touching a wildcard or an open end may be part of a longer token in the URL.
        before = body[found.start() - 1] if found.start() else "|" if host or begin else "*"
        after = body[found.end()] if found.end() < len(body) else "|" if end else "*"
        if "*" not in (before, after):
            tokens.append(found.group())
    return verdict, regex, sorted(set(tokens))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path, both empty where the url is NULL or holds no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(_url, locate('://', _url) + 3)"))
    host = lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule, else NULL."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    tried = [
        F.when(
            ((host == name) | host.endswith("." + name)) & path.startswith(start),
            F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, name, start in ordered
    ]
    return F.coalesce(*tried, F.lit(None).cast("struct<rule:string,verdict:string>"))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url; always with the empty one, under which tokenless rules stand."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(url, TOKEN_GAP)))


def rarest_tokens(urls: DataFrame, compiled: Sequence[tuple[str, str, list[str]]]) -> dict[str, int]:
    """Number of urls per literal token. At most one row per literal token reaches the driver."""
    literals = sorted({t for _, _, tokens in compiled for t in tokens})
    if not literals:
        return {}
    wanted = local_table(urls.sparkSession, {"token": (literals, pa.string())})
    counted = (
        urls.select(F.explode(tokens_of(F.col("url"))).alias("token"))
        .join(wanted, "token")
        .groupBy("token")
        .count()
    )
    return dict.fromkeys(literals, 0) | {r["token"]: r["count"] for r in counted.collect()}


def pattern_hits(urls: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Per lower-cased url that any pattern matches: ``blocked`` and ``excepted``."""
    compiled = [compile_rule(p) for p in patterns]
    if not compiled:
        return empty_like(urls, "url string, blocked boolean, excepted boolean")
    counts = rarest_tokens(urls, compiled)
    index = [
        (min(tokens, key=lambda t: (counts[t], t)) if tokens else "", verdict, regex)
        for verdict, regex, tokens in compiled
    ]
    columns = zip(("token", "kind", "regex"), zip(*index, strict=True), strict=True)
    indexed = local_table(urls.sparkSession, {n: (list(v), pa.string()) for n, v in columns})
    return (
        urls.select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
        .join(indexed, "token")
        .filter(F.expr("url rlike regex"))
        .groupBy("url")
        .agg(
            F.max(F.col("kind") == "block").alias("blocked"),
            F.max(F.col("kind") == "allow").alias("excepted"),
        )
    )


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
    patterns: Sequence[str] = PATTERN_RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict for every row."""
    from tidemark.operators.keysets import own_exchange

    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    host, path = url_parts(F.col("_url"))
    parts = base.select("page_id", "_url", host.alias("host"), path.alias("path"))
    judged = parts.select(
        "page_id",
        "host",
        "path",
        longest_rule(F.col("host"), F.col("path"), host_rules).alias("found"),
        lower_ascii(F.col("_url")).alias("url"),
    ).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.col("found.verdict").alias("ruled"),
        # A ruled url needs no pattern, and a NULL key joins nothing.
        F.when(F.col("found").isNull(), F.col("url")).alias("url"),
    )
    hits = own_exchange(pattern_hits(judged.select("url").filter("url IS NOT NULL"), patterns))
    blocked = F.coalesce(F.col("blocked") & ~F.col("excepted"), F.lit(False))
    return judged.join(hits, "url", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
    )
