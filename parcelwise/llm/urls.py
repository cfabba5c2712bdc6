"""URL rules: host-suffix and path-prefix expressions, matched by short hash prefixes and confirmed by full digests.

A rule is (host, path, verdict). It fits every URL on its host or a subdomain of it whose path starts with the rule's
path. Each URL is expanded into all the expressions a fitting rule could have: suffixes of its host at a dot with prefixes
of its path that end in a slash, or that are as long as a rule path which does not end in one. Only the
first 32 bits of each expression's SHA-256 meet the rules' in an equi-join; what meets is confirmed by the whole
digest. Of the fitting rules the longest wins (host and path together), then the one with the longer host, then block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this many are sent to every task; more are joined by a shuffle on the hash prefix.
BROADCAST_RULES = 100_000


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """Lower-cased (A-Z) text between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _expressions(labels: int, longest: int, odd_lengths: list[int]) -> Column:
    """Every (host suffix, path prefix) of a row with `host` and `path` that a rule may have; a row without a host has none.

    No rule has more than `labels` host labels or a path longer than `longest`, which bounds the number for any URL.
    """
    parts = F.split("host", r"\.")
    hosts = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(parts) - labels + 1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."),
    )
    start = F.substring("path", 1, longest)
    steps = F.split(start, "/")
    paths = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, F.lit(1), k), "/"), F.lit("/"))),
    )
    if odd_lengths:
        odd = F.filter(F.array(*map(F.lit, odd_lengths)), lambda n: n <= F.length("path"))
        paths = F.array_distinct(F.concat(paths, F.transform(odd, lambda n: F.substring("path", F.lit(1), n))))
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(h.alias("host"), p.alias("path")))))
    return F.when(F.col("host") != "", pairs)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(urls: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of `urls`: its other columns, then `host`, `path`, `rule` and `verdict`.

    `rules` needs `host`, `path`, `verdict` (allow or block). A null URL or one without ``://`` has an empty host and
    path, no rule and the default verdict, as has any URL that no rule fits. Rules with a null or empty host or another
    verdict are ignored, a null rule path is empty, repeated rules count once. Repeated rows of `urls` are judged each.
    Columns of `urls` with the names of results are replaced.
    """
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    table = (
        rules.where("host <> '' and verdict in ('allow', 'block')")
        .select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
        .groupBy("r_host", "r_path")
        .agg(F.max("verdict").alias("r_verdict"))
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("r_digest", 1, 8))
    )
    shape = table.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.max(F.length("r_path")).alias("longest"),
        F.collect_set(F.when(~F.col("r_path").endswith("/"), F.length("r_path"))).alias("odd"),  # one per path length
    ).first()
    expanded = urls.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("_own"),
        url_host(F.col(f"`{url}`")).alias("host"),
        url_path(F.col(f"`{url}`")).alias("path"),
    ).withColumn("_e", F.explode_outer(_expressions(shape.labels or 0, shape.longest or 0, sorted(shape.odd))))
    keyed = expanded.withColumn("_digest", _digest(F.col("_e.host"), F.col("_e.path"))).withColumn(
        "short", F.coalesce(F.substring("_digest", 1, 8), F.concat(F.lit("row "), "_row"))  # no hot null key
    )
    hits = keyed.join(F.broadcast(table) if shape.n <= BROADCAST_RULES else table, "short", "left")
    fits = F.col("_digest") == F.col("r_digest")
    order = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("n"),
        F.length("r_host").alias("h"),
        F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"),
    )
    best = hits.groupBy("_row").agg(
        F.first("_own").alias("_own"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max(F.when(fits, order)).alias("_best"),
    )
    return best.select(
        *[F.col(f"_own.`{c}`").alias(c) for c in own],
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
