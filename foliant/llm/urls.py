"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its hits; plus path rules.

Everything is DataFrame functions. A list holds pages (host and path) and sites (host and a slash: all pages of the host
and its subdomains). A URL is looked up as its page and as the sites it may be in. The filter is a table of blocks of
four 64-bit words; a key sets one bit in each word of its block. Keys that pass are joined with the list itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.shards import free_names

#: Rules: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits a listed URL has in the filter, and the bytes up to which filter and list are broadcast.
BITS_PER_URL = 16
BROADCAST_BYTES = 32 << 20


def host_of(url: Column) -> Column:
    """From the first :// to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end to ?, # or the end; the group may be empty, so that the match never moves past the first ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def site_of(host: Column) -> Column:
    """A host without user part, port and www."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"^www\.", "")


def canonical(host: Column, path: Column) -> Column:
    """Host without user part, port and www., and path without a closing slash or .html; null without a host."""
    return F.when(host != "", F.concat(site_of(host), F.regexp_replace(path, r"(/|\.html)$", "")))


def labels_of(site: Column) -> Column:
    return F.size(F.split(site, r"\."))


def lookups(host: Column, path: Column, most: int) -> Column:
    """The keys under which a URL may be listed: its page, and the sites of all ends of its host of up to `most` labels,
    which is as many as any listed site has."""
    ends = F.sequence(F.lit(1), F.least(labels_of(site_of(host)), F.lit(max(most, 1))))
    sites = F.transform(ends, lambda n: F.concat(F.call_function("substring_index", site_of(host), F.lit("."), -n), F.lit("/")))
    return F.when(host != "", F.concat(F.array(canonical(host, path)), sites)).otherwise(F.array().cast("array<string>"))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host and all subdomains; the path's start) and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _masks(h: Column) -> list[Column]:
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 8 * i), F.lit(64)).cast("int")) for i in range(4)]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w3) of the blocks that have a bit set."""
    masked = keys.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks(F.xxhash64(key, F.lit(2))))))
    return masked.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)))


def _hits(rows: DataFrame, bloom: DataFrame, blocks: int, columns: list[str]) -> DataFrame:
    """columns of rows and __hits, the keys of __keys that the filter lets pass. The whole filter, an array of blocks in
    one row of bounded size, goes to every task."""
    places = rows.sparkSession.range(blocks).withColumnRenamed("id", "block").join(bloom, "block", "left")
    words = [F.coalesce(f"w{i}", F.lit(0).cast("long")).alias(f"w{i}") for i in range(4)]
    whole = places.agg(F.array_sort(F.collect_list(F.struct("block", *words))).alias("__bloom"))
    hashed = F.transform("__keys", lambda k: F.struct(k.alias("key"), _block(k, blocks).cast("int").alias("block"), F.xxhash64(k, F.lit(2)).alias("h")))

    def passes(k: Column) -> Column:
        block, hit = F.get("__bloom", k["block"]), F.lit(True)
        for i, m in enumerate(_masks(k["h"])):
            hit = hit & (block[f"w{i}"].bitwiseAND(m) == m)
        return hit

    found = F.transform(F.filter("__hashed", passes), lambda k: k["key"])
    return rows.withColumn("__hashed", hashed).join(F.broadcast(whole)).select(*columns, found.alias("__hits"))


def filter_urls(pages: DataFrame, listed: DataFrame, url_col: str = "url", listed_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every column of pages, with host, path, canonical, listed (boolean), rule and verdict (allow or block).

    The longest rule decides; without one a listed URL is blocked and any other allowed. Entries of the list are pages or
    sites as said above, with or without a scheme; null entries count for nothing. User parts, ports and www. play no part
    in the list, and a site of any number of labels holds for all hosts below it. A null or malformed url has empty host
    and path, fits no rule and is never listed; so it is allowed. Very long urls are whole. Repeated rows are judged
    alike; an empty table gives no rows, an empty list blocks nothing. Input columns named as a result get the suffix
    _in. Only pages with keys that the filter lets pass are met with the list. Filter and list are broadcast up to
    BROADCAST_BYTES; larger ones are joined by key, each different key once.
    """
    names = ("host", "path", "canonical", "listed", "rule", "verdict")
    pages = free_names(pages, *names)
    keys = listed.select(list_key(F.col(listed_col)).alias("__key")).where("__key is not null").distinct()
    labels = F.max(F.when(F.col("__key").endswith("/"), labels_of(F.col("__key"))))
    n, size, most = keys.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("__key")), F.lit(0)), F.coalesce(labels, F.lit(0))).first()
    blocks, small = max(1, n * BITS_PER_URL // 256), 64 * n + size <= BROADCAST_BYTES
    bloom = bloom_filter(keys, "__key", blocks)
    rows = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    rows = rows.withColumn("canonical", canonical(F.col("host"), F.col("path"))).withColumn("__keys", lookups(F.col("host"), F.col("path"), most))
    columns = [*pages.columns, "host", "path", "canonical"]
    if blocks * 40 <= BROADCAST_BYTES:
        rows = _hits(rows, bloom, blocks, columns)
    else:
        probed = rows.select(F.explode("__keys").alias("__key")).distinct().withColumn("block", _block(F.col("__key"), blocks)).join(bloom, "block")
        hit = F.lit(True)
        for i, m in enumerate(_masks(F.xxhash64("__key", F.lit(2)))):
            hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
        passed = probed.where(hit).select("__key").join(keys, "__key", "left_semi")
        near = rows.select("host", "path", F.explode("__keys").alias("__key")).join(passed, "__key").select("host", "path").distinct().withColumn("__near", F.lit(True))
        rows = rows.join(near, ["host", "path"], "left").select(*columns, F.when(F.col("__near"), F.col("__keys")).otherwise(F.array().cast("array<string>")).alias("__hits"))
    clear = rows.where(F.size("__hits") == 0).select(*columns, F.lit(False).alias("listed"))
    some = rows.where(F.size("__hits") > 0).select(F.struct(*columns).alias("__page"), F.monotonically_increasing_id().alias("__row"), "__hits").select("__page", "__row", F.explode("__hits").alias("__key"))
    side = keys.withColumn("__listed", F.lit(True))
    met = some.join(F.broadcast(side) if small else side, "__key", "left")
    met = met.groupBy("__row").agg(F.first("__page").alias("__page"), F.coalesce(F.bool_or("__listed"), F.lit(False)).alias("listed"))
    rows = clear.unionByName(met.select("__page.*", "listed"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow"))).select(*pages.columns, *names)


def list_key(entry: Column) -> Column:
    """An entry of a list as a key: a site ends in a slash right after its host, anything else is a page."""
    url = F.when(F.contains(entry, F.lit("://")), entry).otherwise(F.concat(F.lit("x://"), entry))
    host, path = host_of(url), path_of(url)
    return F.when(host == "", None).when(path == "/", F.concat(site_of(host), F.lit("/"))).otherwise(canonical(host, path))
