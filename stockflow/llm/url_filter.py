"""Allow and block lists for URLs: host and path rules looked up by hashed expressions.

A rule is a host and a path. It fits a URL when the URL's host is the rule's or a subdomain of
it and the URL's path begins with the rule's. Each URL is expanded into the expressions a rule
could have been written as, a suffix of the host's labels with a prefix of the path. Only
shapes that some rule has (number of labels, length of path) are expanded. Expressions and
rules are joined on the first `SHORT` hex digits of their SHA-256 digest; the whole digest
then confirms the hit, and the longest confirmed rule decides.

Host: what stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case;
ports and user names are part of it. Path: from there up to `?`, `#` or the end. A URL that is
null or has no `://` has an empty host and path.

Scale: URLs shrink to distinct addresses (host, path) before they are expanded, so a URL that
holds a third of all rows is looked up once. The rules are joined without a hint: a short list
is broadcast by its size, a long one is shuffled by the short hash, where a host that very
many addresses share is a skewed key of the streamed side and split by AQE. What goes to the
driver is the set of shapes, at most the longest host's labels times the longest rule path.

Defined cases: rules with a null or empty host count for nothing, a null path is empty; of
equal rules with different verdicts `block` counts. An address no rule fits has a null rule
and the default verdict: a list of rules names exceptions, so `allow` unless told otherwise.
Rows are kept one for one, whatever their columns are called; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SHORT = 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# the strings of a URL: everything up to the first :// and then host and path
_HOST = r"^[\s\S]*?://([^/?#]*)"
_PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def hashed_rules(rules: DataFrame) -> DataFrame:
    """(short, digest, rule, labels, length, verdict): one row for each rule of (host, path, verdict)."""
    clean = rules.select(
        lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).filter("host <> ''")
    digest = F.sha2(F.concat("host", "path"), 256)
    return (
        clean.groupBy("host", "path")
        .agg(F.max(F.col("verdict") == BLOCK).alias("blocks"))
        .select(
            F.substring(digest, 1, SHORT).alias("short"),
            digest.alias("digest"),
            F.concat("host", "path").alias("rule"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.char_length("path").alias("length"),
            F.when(F.col("blocks"), BLOCK).otherwise(ALLOW).alias("verdict"),
        )
    )


def expressions(shapes: list[tuple[int, int]]) -> Column:
    """The expressions of (host, path) of the given shapes; too short an address has fewer."""
    by_labels: dict[int, list[int]] = {}
    for labels, length in shapes:
        by_labels.setdefault(labels, []).append(length)

    def of(labels: int, lengths: list[int]) -> Column:
        suffix = F.when(F.size(F.split("host", r"\.")) >= labels, F.substring_index("host", ".", -labels))
        fitting = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.char_length("path"))
        return F.transform(fitting, lambda n: F.concat(suffix, F.left(F.col("path"), n)))

    parts = [of(labels, lengths) for labels, lengths in sorted(by_labels.items())]
    return F.filter(F.flatten(F.array(*parts)), lambda e: e.isNotNull())


def verdicts(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct addresses that a rule fits."""
    listed = hashed_rules(rules)
    shapes = listed.select("labels", "length").distinct().collect()
    if not shapes:
        return addresses.limit(0).selectExpr("host", "path", "'' AS rule", "'' AS verdict")
    expanded = addresses.filter("host <> ''").distinct().select(
        "host", "path", F.explode(expressions([tuple(s) for s in shapes])).alias("expression")
    )
    hashed = expanded.withColumn("short", F.substring(F.sha2("expression", 256), 1, SHORT))
    # the rules of one short hash in one row: as a list, their digests stay out of the join's keys
    rule = F.struct(F.char_length("rule").alias("size"), "labels", "digest", "rule", "verdict")
    buckets = listed.groupBy("short").agg(F.collect_list(rule).alias("bucket"))
    confirmed = F.expr("filter(bucket, r -> r.digest = sha2(expression, 256))")
    hits = hashed.join(buckets, "short").select("host", "path", F.explode(confirmed).alias("hit"))
    # the longest rule; rules of one length that fit one address differ in how much of it is host
    best = hits.groupBy("host", "path").agg(F.max("hit").alias("hit"))
    return best.select("host", "path", "hit.rule", "hit.verdict")


def judged(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = ALLOW) -> DataFrame:
    """The columns `keep` of every page with host, path, rule and verdict of its URL."""
    kept = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(keep)])
    placed = pages.select(kept.alias("_kept"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    found = verdicts(placed.select("host", "path"), rules)
    return placed.join(found, ["host", "path"], "left").select(
        *[F.col("_kept")[f"c{k}"].alias(c) for k, c in enumerate(keep)],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def allowed(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The pages whose URL is allowed, with their own columns."""
    kept = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(pages.columns)])
    rows = judged(pages.select(kept.alias("row"), F.col(url).alias("url")), rules, ["row"], "url", default)
    return rows.filter(F.col("verdict") == ALLOW).select(
        *[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(pages.columns)]
    )
