"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BITS_PER_KEY = 16
BITS_SET = 4


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _bits(key: Column) -> Column:
    """The bits a key sets in its 64-bit block."""
    bits = F.lit(0).cast("long")
    second = F.xxhash64(F.lit(1), key)
    for k in range(BITS_SET):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's blocks as rows (block, word), of the keys in column `key`."""
    block = F.pmod(F.xxhash64("key"), F.lit(blocks).cast("long"))
    return keys.groupBy(block.alias("block")).agg(F.bit_or(_bits(F.col("key"))).alias("word"))


def possible(candidates: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """Candidates whose `key` the filter of `keys` may hold: all that it does, few others."""
    block = F.pmod(F.xxhash64("key"), F.lit(blocks).cast("long"))
    probed = candidates.withColumn("block", block).join(bloom_filter(keys, blocks), "block")
    wanted = _bits(F.col("key"))
    return probed.filter(F.col("word").bitwiseAND(wanted) == wanted).drop("block", "word")


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The rules' numbers of host labels and path lengths: as many as there are forms."""
    labels = F.size(F.split("host", r"\.")).alias("labels")
    found = rules.select(labels, F.length("path").alias("path_length")).distinct()
    return [tuple(row) for row in found.collect()]


def _candidates(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """Every key a url may be listed under: itself, and a rule of each form that can fit.

    Keys begin with their kind, so a listed url and a rule of the same letters differ.
    """
    labels = F.size(F.split("host", r"\."))
    keys = [F.concat(F.lit("url "), F.col("host"), F.col("path"))]
    for count, length in shapes:
        prefix = F.substring("path", 1, length)
        key = F.concat(F.lit("rule "), F.substring_index("host", ".", -count), prefix)
        keys.append(F.when((labels >= count) & (F.length("path") >= length), key))
    return urls.select("host", "path", F.explode(F.array_compact(F.array(*keys))).alias("key"))


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """Judge every page's url: page_id, host, path, rule, verdict (`allow` or `block`).

    `rules` has host, path and verdict; a rule fits its host and all subdomains if the url's
    path starts with the rule's, and the longest that fits decides, the longer host among
    equals, then the verdict `allow`. Where none fits, a url is blocked if `listed` (column
    `url`) holds it, by canonical form: host and path. Null urls and those without `://`
    have an empty host and path, fit no rule and are allowed. Repeated pages, rules and
    listed urls do no harm; other columns are left out. Each distinct url is judged once;
    the keys it may be listed under pass the filter, then the exact join.
    """
    keyed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = rules.filter("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
    of_rules = rules.select(
        F.concat(F.lit("rule "), "host", "path").alias("key"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        "verdict",
    )
    of_urls = listed.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    of_urls = of_urls.filter("host <> ''").select(
        F.concat(F.lit("url "), "host", "path").alias("key"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(0).alias("host_length"),
        F.lit("block").alias("verdict"),
    )
    entries = of_rules.unionByName(of_urls).groupBy("key", "rule", "host_length").agg(
        F.min("verdict").alias("verdict")
    )
    entries = staged(entries, "url-entries")
    blocks = max(1, -(-entries.count() * BITS_PER_KEY // 64))
    candidates = _candidates(keyed.select("host", "path").distinct(), _shapes(rules))
    hits = possible(candidates, entries.select("key"), blocks).join(entries, "key")
    best = F.struct(F.length("rule").alias("a"), F.col("host_length").alias("b"), "rule", "verdict")
    judged = hits.groupBy("host", "path").agg(F.max(best).alias("best"))
    return keyed.join(judged, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
