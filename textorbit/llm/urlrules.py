"""URL filters: pattern rules indexed by their rarest literal token.

A rule's pattern names literal tokens (runs of letters and digits) that any matching URL must
contain whole. Each rule is filed under that token of its own which the fewest URLs have, counted
over all URLs. A URL's tokens fetch the rules filed under them, and only those run their regular
expressions; most URLs run none. The index is a constant of the query, hashed into buckets, so a
URL is judged within its row: no join, no shuffle, and no key that could be hot.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.llm.common import table, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs on the lower-cased URL, or, if ``site`` is set, on ``://`` host path."""

    pattern: str
    tokens: tuple[str, ...]
    action: str
    site: str | None = None


def site_rule(action: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains, and the paths that start with ``path``."""
    name = host + path
    # The host's labels are whole tokens; of the path, those that a further character follows.
    labels = re.findall(r"[a-z0-9]+", host)
    parts = re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", path.lower())
    pattern = r"^://(?:[^/?#]*\.)?" + _quoted(host) + _quoted(path)
    return Rule(pattern, tuple(dict.fromkeys([*labels, *parts])), action, name)


def pattern_rule(action: str, text: str) -> Rule:
    """A rule in filter notation: ``*`` stands for any text, ``^`` for an end or a character that is no letter or digit."""
    text = text.lower()
    regex = "".join(".*" if c == "*" else "(?:^|$|[^a-z0-9])" if c == "^" else _quoted(c) for c in text)
    # A token is whole only if something other than a wildcard or the rule's end bounds it.
    tokens = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text)
    return Rule(regex, tuple(dict.fromkeys(tokens)), action)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/-_" else "\\" + c for c in text)


# The contract's rules (fixed values), then patterns of spam and advertising hosts.
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)
PATTERN_RULES = (
    pattern_rule("block", "^spam-farm^"),
    pattern_rule("block", "^cheap-pills^"),
    pattern_rule("block", "^casino^"),
    pattern_rule("block", "^free-bets^"),
    pattern_rule("block", "^adult-x^"),
    pattern_rule("block", "^ads-track^"),
    pattern_rule("block", "^payday-loans^"),
    pattern_rule("block", "^adserver^"),
    pattern_rule("block", "^doubleclick^"),
    pattern_rule("block", "^viagra^"),
    pattern_rule("block", "^xxx^"),
    pattern_rule("block", "^porn^"),
    pattern_rule("block", "^link-farm^"),
    pattern_rule("block", "^warez^"),
    pattern_rule("allow", "^wiki^casino^"),
)
RULES = SITE_RULES + PATTERN_RULES


def lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, LOWER)


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(lower(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower(F.coalesce(url, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def token_counts(urls: DataFrame, wanted: list[str]) -> dict[str, int]:
    """URLs that have each of ``wanted``; at most one row per wanted token comes back."""
    if not wanted:
        return {}
    found = urls.select(F.explode(F.array_intersect(tokens(F.col("url")), F.array(*map(F.lit, wanted)))).alias("token"))
    return {r.token: r.n for r in found.groupBy("token").agg(F.count("*").alias("n")).toLocalIterator()}


def index_rules(rules: tuple[Rule, ...], counts: dict[str, int]) -> tuple[list[list[dict]], list[int]]:
    """Buckets of (token, rule number) by the token's hash, and the rules without a token."""
    size = max(16, 1 << (2 * len(rules)).bit_length())
    buckets: list[list[dict]] = [[] for _ in range(size)]
    loose = []
    for number, rule in enumerate(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            buckets[zlib.crc32(rarest.encode()) % size].append({"token": rarest, "number": number})
        else:
            loose.append(number)
    return buckets, loose


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow") -> DataFrame:
    """Append ``host``, ``path``, ``rule``, ``verdict`` and ``matched`` (rules that fit) to ``pages``.

    Of the site rules that fit the longest decides; where none fits, a fitting allow pattern
    decides before a block pattern, and ``default`` stands where nothing fits. A URL that is
    null or has no ``://`` has empty host and path and can fit patterns only. Rules without a
    whole token run on every URL. Repeated rows get equal verdicts, empty tables stay empty,
    long URLs are read whole. Other columns are carried along, and columns named like a result
    are replaced by it.
    """
    counts = token_counts(pages.select("url"), sorted({t for r in rules for t in r.tokens}))
    buckets, loose = index_rules(rules, counts)
    listed = [{"pattern": r.pattern, "action": r.action, "site": r.site} for r in rules]
    index = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<token:string,number:int>>>")
    book = F.from_json(F.lit(json.dumps(listed)), "array<struct<pattern:string,action:string,site:string>>")
    keep = without(pages, ["host", "path", "rule", "verdict", "matched"])

    def filed(token: Column) -> Column:
        bucket = F.get(index, F.pmod(F.crc32(token), F.lit(len(buckets))).cast("int"))
        return F.transform(F.filter(bucket, lambda e: e["token"] == token), lambda e: e["number"])

    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                        lower(url).alias("__url"), tokens(F.col("url")).alias("__tokens"))
    numbers = F.flatten(F.transform("__tokens", filed))
    if loose:
        numbers = F.concat(numbers, F.array(*map(F.lit, loose)))
    rows = rows.withColumn("__rules", F.transform(F.array_distinct(numbers), lambda i: F.get(book, i)))
    site = F.concat(F.lit("://"), F.col("host"), F.col("path"))

    def fits(rule: Column) -> Column:
        return F.when(rule["site"].isNull(), F.rlike("__url", rule["pattern"])).otherwise(F.rlike(site, rule["pattern"]))

    rows = rows.withColumn("matched", F.filter("__rules", fits))
    longest = F.array_max(
        F.transform(
            F.filter("matched", lambda r: r["site"].isNotNull()),
            lambda r: F.struct(F.length(r["site"]).alias("n"), r["site"].alias("site"), r["action"].alias("action")),
        )
    )
    actions = F.transform(F.filter("matched", lambda r: r["site"].isNull()), lambda r: r["action"])
    other = (
        F.when(F.array_contains(actions, "allow"), F.lit("allow"))
        .when(F.array_contains(actions, "block"), F.lit("block"))
        .otherwise(F.lit(default))
    )
    rows = rows.withColumn("__longest", longest)
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        "host",
        "path",
        F.col("__longest.site").alias("rule"),
        F.coalesce(F.col("__longest.action"), other).alias("verdict"),
        "matched",
    )


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    low = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    sites = " UNION ALL ".join(
        f"SELECT '{r.site.partition('/')[0]}' AS h, '/{r.site.partition('/')[2]}' AS p, '{r.action}' AS a, '{r.site}' AS s"
        for r in SITE_RULES
    )

    def any_of(action: str) -> str:
        return " OR ".join(f"regexp_matches(u, '{r.pattern}', 's')" for r in PATTERN_RULES if r.action == action)

    return f"""
WITH r AS ({sites}),
u AS (
    SELECT row_number() OVER () AS rid, page_id, {low} AS u,
           translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
f AS (
    SELECT rid, max_by(s, length(s)) AS rule, max_by(a, length(s)) AS action
    FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN {any_of('allow')} THEN 'allow' WHEN {any_of('block')} THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN f USING (rid)
"""


QUERIES = {"op6_url_rules": op6_url_rules}
ORACLES = {"op6_url_rules": _sql()}
