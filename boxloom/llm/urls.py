"""URL filters in DataFrame functions: rules, and a list behind a blocked Bloom filter.

A listed URL sets two bits in each of the four 64-bit words of one block. A block is
thus one row of a small table; a URL that may be listed is one whose block has all its
bits. The distinct ones of those possible hits go to an exact hash join with the list,
which removes the false positives. The other URLs, nearly all, meet only the filter:
broadcast while its counted blocks are few, and beyond that joined by block, each URL
once, so that one that many pages carry is not one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

#: Filter bits for each listed URL; about 0.1 % of other URLs pass at this density.
BITS_PER_URL = 16
BLOCK_BITS = 256
#: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MAX_RULES = 500
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://, empty for a null url and for one without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """host + path without www. or m., page suffix and last slash; null for a url
    without a host, which is never listed."""
    name = F.regexp_replace(host(url), "^(www|m)[.]", "")
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), "([.]html?)?/*$", "")))


def rule_of(host_: Column, path_: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(the rule that fits, its verdict), both null if none fits. A rule fits its host
    and all subdomains, if the path starts with the rule's; the longest wins, of equally
    long ones the first in order. Rules are few, at most MAX_RULES; long lists belong in the list."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for name, prefix, says in sorted(reversed(rules), key=lambda r: len(r[0] + r[1])):  # later ones take precedence
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(prefix)
        rule, verdict = F.when(fits, F.lit(name + prefix)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _masks(key: Column) -> list[Column]:
    """Two bits for each of a block's four words, from one more hash of the key."""
    h = F.xxhash64(key, F.lit(1))
    return [_bit(h, 2 * k).bitwiseOR(_bit(h, 2 * k + 1)) for k in range(4)]


def _bit(h: Column, k: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * k).bitwiseAND(63).cast("int"))


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's rows (block, w0 .. w3); blocks without bits have none."""
    rows = listed.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), *(m.alias(f"w{k}") for k, m in enumerate(_masks(F.col(key)))))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(4)))


def with_listed(rows: DataFrame, key: str, listed: DataFrame, bits: int = BITS_PER_URL) -> DataFrame:
    """rows with a further boolean `listed`: its key is in listed's column of that name.

    A null key is not listed. Repeated list entries count once."""
    exact, several = store.counted(listed.select(F.col(key).alias("__listed")).where(F.col("__listed").isNotNull()).distinct(), "listed")
    blocks = max(1, -(-several["n"] * bits // BLOCK_BITS))
    filter_, used = store.counted(bloom(exact, "__listed", blocks).select(F.col("block").alias("__block"), *(F.col(f"w{k}").alias(f"__w{k}") for k in range(4))), "bloom")
    keys = rows.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull())
    if used["n"] > store.BROADCAST_ROWS:
        keys = keys.distinct()
    probed = keys.join(store.small(filter_, rows=used["n"]), F.pmod(F.xxhash64("__key"), F.lit(blocks)) == F.col("__block"))
    for k, mask in enumerate(_masks(F.col("__key"))):
        probed = probed.where(F.col(f"__w{k}").bitwiseAND(mask) == mask)
    possible, passed = store.counted(probed.select("__key").distinct(), "possible")
    hits, found = store.counted(exact.join(store.small(possible, rows=passed["n"]), F.col("__listed") == F.col("__key"), "left_semi"), "hits")
    if found["n"] <= store.BROADCAST_ROWS:
        known = rows.join(F.broadcast(hits), F.col(key) == F.col("__listed"), "left")
        return known.select(*rows.columns, F.col("__listed").isNotNull().alias("listed"))
    # rows without a key stay out of the shuffle, where all would meet
    known = rows.where(F.col(key).isNotNull()).join(hits, F.col(key) == F.col("__listed"), "left")
    known = known.select(*rows.columns, F.col("__listed").isNotNull().alias("listed"))
    return known.unionByName(rows.where(F.col(key).isNull()).withColumn("listed", F.lit(False)))


def judge(pages: DataFrame, listed: DataFrame, rules: tuple = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row of pages: page_id, host, path, rule, verdict, canonical and listed.

    The verdict is the fitting rule's; without one a url whose canonical form is in
    listed (column `canonical`) is blocked and any other allowed. A null url, or one
    without ://, has an empty host and path, no rule, and is allowed. Repeated rows
    are judged each, and urls of any length whole."""
    rows = pages.select(F.col(key).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), canonical(F.col(url)).alias("canonical"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__says": says})
    judged = with_listed(rows, "canonical", listed)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("__says", method).alias("verdict"), "canonical", "listed")


#: Sites, domains, languages and page numbers of the list that the registered query filters by.
SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
DOMAINS, LANGUAGES, NUMBERS = ("com", "net", "org"), ("de", "en", "es", "fr"), 10_000


def listed_urls(spark: SparkSession) -> DataFrame:
    """(canonical): the pages 0 to NUMBERS - 1 of each of the SITES under each domain and language."""
    texts = lambda *names: F.explode(F.array(*(F.lit(n) for n in names)))
    pages = spark.range(NUMBERS).select("id", texts(*SITES).alias("site")).select("*", texts(*DOMAINS).alias("domain")).select("*", texts(*LANGUAGES).alias("language"))
    return pages.select(F.concat("site", F.lit(".example."), "domain", F.lit("/"), "language", F.lit("/"), F.col("id").cast("string")).alias("canonical"))


#: The same rows by DuckDB.
ORACLE = rf"""
WITH listed AS (SELECT concat(site, '.example.', domain, '/', language, '/', n) AS entry
     FROM (SELECT unnest({list(SITES)}) AS site), (SELECT unnest({list(DOMAINS)}) AS domain), (SELECT unnest({list(LANGUAGES)}) AS language), range({NUMBERS}) t(n)),
u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
c AS (SELECT *, regexp_replace(host, '^(www|m)[.]', '') AS name FROM h),
k AS (SELECT page_id, host, path, CASE WHEN name <> '' THEN concat(name, regexp_replace(path, '([.]html?)?/*$', '')) END AS canonical FROM c),
r AS (SELECT *, CASE WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule, coalesce(canonical IN (SELECT entry FROM listed), false) AS listed FROM k)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical, listed FROM r
"""
