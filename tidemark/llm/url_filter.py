"""URL filtering by listed rules: blocked Bloom filter, then an exact hash join.

A rule is a canonical URL prefix (host and path, like ``example.org/es/``) with
an action. It fits its host and all subdomains, if the path of the URL starts
with the rule's path. For every distinct URL the keys under which a fitting
rule could be listed are formed (the last k labels of the host and the first l
characters of the path, for the label counts k and path lengths l that occur in
the list). The filter lets possible hits pass; an exact join with the list
removes false positives; the longest rule decides.

Everything is DataFrame functions. The filter is a table of at most
``MAX_BLOCKS`` rows of four 64-bit words, so its broadcast is bounded at any
length of the list (a fuller filter only passes more to the exact join). The
list itself is joined as it is: Spark broadcasts it only if its size allows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 16
BITS_PER_RULE = 16
WORDS = 4

RULES_SCHEMA = "host string, path string, action string"


def url_host(url: str | Column = "url") -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0),
                       string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: str | Column = "url") -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    start = F.instr(url, "://")
    return F.coalesce(F.when(start > 0, F.substring(url, start + 3, F.length(url))), F.lit(""))


def _masked(keys: DataFrame, blocks: int) -> DataFrame:
    """Add the filter block of a key and one bit for each of the block's words."""
    bits = F.xxhash64("path", "host")
    out = keys.withColumn("block", F.pmod(F.xxhash64("host", "path"), F.lit(blocks)).cast("int"))
    out = out.withColumn("_bits", bits)
    for i in range(WORDS):
        out = out.withColumn(f"m{i}", F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_bits, {6 * i}) & 63L as int))"))
    return out.drop("_bits")


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): a blocked Bloom filter of the rules' (host, path)."""
    return (_masked(rules.select("host", "path"), blocks).groupBy("block")
            .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)]))


def might_be_listed(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The keys (host, path, ...) that the filter lets pass: all listed ones and some others."""
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return _masked(keys, blocks).join(F.broadcast(bloom), "block").where(hit).select(keys.columns)


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, action) of the longest fitting rule of each distinct URL that has one.

    Of rules of equal length the one with the longer host wins, then ``block``
    (the greater action). Rules without a host fit nothing; a null path is empty.
    """
    rules = (rules.select(F.col("host"), F.coalesce("path", F.lit("")).alias("path"), "action")
             .where(F.length("host") > 0))
    # Numbers that describe the list's shape, not its entries.
    shape = rules.agg(F.count("*").alias("n"),
                      F.sort_array(F.collect_set(F.size(F.split("host", "\\.")))).alias("labels"),
                      F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * WORDS * 64 < shape.n * BITS_PER_RULE:
        blocks *= 2
    distinct = (urls.select("url").where(F.col("url").isNotNull()).distinct()
                .select("url", url_host().alias("_host"), url_path().alias("_path")).where("_host <> ''"))
    suffixes = F.array_distinct(F.array(*[F.substring_index("_host", ".", -k) for k in shape.labels]))
    prefixes = F.array_compact(F.array(*[F.when(F.length("_path") >= n, F.substring("_path", 1, n))
                                         for n in shape.lengths]))
    if not shape.n:
        suffixes = prefixes = F.array().cast("array<string>")
    keys = (distinct.select("url", "_path", F.explode(suffixes).alias("host"), prefixes.alias("_prefixes"))
            .select("url", "host", F.explode("_prefixes").alias("path")))
    possible = might_be_listed(keys, bloom_filter(rules, blocks), blocks)
    listed = possible.join(rules, ["host", "path"])
    rank = F.struct((F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                    F.col("action"), F.concat("host", "path").alias("rule"))
    return listed.groupBy("url").agg(F.max(rank).alias("r")).select("url", "r.rule", "r.action")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    verdict: the action of the longest fitting rule, else ``default`` (a URL
    that the filter does not find listed). A null URL and one without ``://``
    have empty host and path and fit no rule. Repeated URLs are judged once and
    joined back, so a hot host or URL costs one lookup; every row is kept.
    Columns of ``pages`` named like the four results are replaced. An empty
    table gives an empty result, an empty list the default for all rows.
    """
    found = fitting_rules(pages.select(F.col(url).alias("url")), rules)
    found = found.select(F.col("url").alias("_url"), F.col("rule").alias("_rule"), F.col("action").alias("_action"))
    results = {"host": url_host("_key"), "path": url_path("_key"), "rule": F.col("_rule"),
               "verdict": F.coalesce("_action", F.lit(default))}
    packed = pages.select(F.struct(*pages.columns).alias("_page"), F.col(url).alias("_key"))
    joined = packed.join(found, F.col("_key") == F.col("_url"), "left")
    kept = [F.col("_page").getField(c).alias(c) for c in pages.columns if c not in results]
    return joined.select(*kept, *[v.alias(k) for k, v in results.items()])
