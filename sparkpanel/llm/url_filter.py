"""URL filter: host-suffix / path-prefix expressions looked up by hash.

Native DataFrame functions only.  A rule is (host, path, verdict): it fits its host and all
subdomains when the URL's path starts with the rule's path.  Every URL is expanded into
its host suffixes times its path prefixes (of the lengths that occur among the rules, so
no prefix that could match is left out).  Expressions meet the rules by an equi-join on
the first 32 bits of a SHA-256 digest; what meets is then confirmed by the full digests,
which throws out expressions that share a prefix only; the longest rule wins.

The rule table is broadcast when its rows and bytes are measured to be small; beyond that
the rules are replicated under ``SALTS`` salts and joined by shuffle, so an expression that
a third of all URLs share is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: hexadecimal digits of a digest in the join key
PREFIX = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 50_000, 4 << 20
SALTS = 32


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end.  Null or no ``://``: both empty."""
    # (?s): a line feed is a character like any other
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, "(?s)^.*?://", "")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _prefix(digest: Column) -> Column:
    return F.substr(digest, F.lit(1), F.lit(PREFIX))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(rule, verdict, weight, digest, prefix) from (host, path, verdict).

    Null hosts or paths count as empty; the host is lower-cased like a URL's.  An empty
    host fits no URL.  Repeated rules collapse; of two verdicts for one rule, block wins.
    """
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    r = rules.select(host.alias("h"), path.alias("p"), "verdict").where("h <> ''").groupBy("h", "p") \
        .agg(F.max(F.col("verdict") == "block").alias("block"))
    r = r.withColumn("digest", _digest(F.col("h"), F.col("p")))
    return r.select(F.concat("h", "p").alias("rule"), F.when(F.col("block"), "block").otherwise("allow").alias("rule_verdict"),
                    (F.length("h") + F.length("p")).alias("rule_length"), F.length("h").alias("host_length"),
                    F.length("p").alias("path_length"), "digest", _prefix(F.col("digest")).alias("prefix"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict), one row per row of ``pages``.

    Longest rule first (host and path together), ties to the longer host.  A URL without a
    fitting rule, and a null or empty URL, get a null rule and the ``default`` verdict.  Repeated
    rows and null keys stay.  Very long URLs are expanded whole: host suffixes times the
    lengths of the rules' paths.  No rules: every URL gets the default.  Other columns,
    whatever their names, are not read.  Empty table: empty result.
    """
    rules = prepare_rules(rules)
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("rule") + 120), F.lit(0)).alias("bytes"),
                     F.array_sort(F.collect_set("path_length")).alias("lengths")).first()
    small = size["n"] <= MAX_BROADCAST_ROWS and size["bytes"] <= MAX_BROADCAST_BYTES
    rules = rules.drop("path_length")
    host, path = host_and_path(F.col(url))
    # the number of lengths is bounded by the longest path of a rule
    lengths = F.array(*[F.lit(n) for n in size["lengths"]]) if size["lengths"] else F.array().cast("array<int>")
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _digest(s, p))))
    # one placeholder keeps URLs that match nothing and counts the copies of a row
    listed = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")) \
        .select("key", "host", "path", F.explode(F.concat(F.array(F.lit("")), expressions)).alias("found"))
    listed = listed.withColumn("found_prefix", _prefix(F.col("found")))
    # first the short prefixes meet, then the full digests confirm what met
    meets = F.col("found_prefix") == F.col("prefix")
    if small:
        met = listed.join(F.broadcast(rules), meets, "left")
    else:
        salted = rules.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("rule_salt"))
        # the key alone would keep the copies of a row together: the salt also takes the expression
        spread = listed.withColumn("salt", F.pmod(F.xxhash64("key", "found"), F.lit(SALTS)).cast("int"))
        met = spread.join(salted, meets & (F.col("salt") == F.col("rule_salt")), "left")
    confirmed = F.col("found") == F.col("digest")
    matched = met.select("key", "host", "path", "found", *[F.when(confirmed, F.col(c)).alias(c) for c in ("rule", "rule_verdict", "rule_length", "host_length")])
    order = F.struct("rule_length", "host_length")
    best = matched.groupBy("key", "host", "path").agg(
        F.max_by(F.struct("rule", "rule_verdict"), F.when(F.col("rule").isNotNull(), order)).alias("best"),
        F.count_if(F.col("found") == "").alias("copies"))  # the placeholder has an empty prefix: it meets nothing
    rows = best.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("col")
    return rows.select(F.col("key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
