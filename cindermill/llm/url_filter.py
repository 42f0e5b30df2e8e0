"""URL filters by a Bloom filter cascade. DataFrame operations only.

Explicit rules (host and its subdomains, path prefix) decide first, the longest that fits. The other urls are
blocked when their site is listed: the host without user name, port, dots at its end and a front label www, m or
blog. Levels of the cascade encode by turns listed sites and the false positives of the level before, over all
sites of the table, until a level has none: then the first level that a site of the table misses tells its
membership exactly, without a join. A level is an array of longs, built by ``bit_or`` and read through a scalar
subquery; its size is known from the number of keys and at most ``MAX_BITS``. Where one cascade would need
larger levels, sites are split by hash into parts, each with a cascade of its own; the parsed urls lie in a folder
a part, so each is read once, with the levels of its part alone.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; repeated rows give
repeated rows; columns other than ``page_id`` and ``url`` are not read; an empty list blocks nothing.
"""

from __future__ import annotations

import functools
import math
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cindermill.llm.common import discard, staged

#: host, path prefix, verdict. Fixed values.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: The block list of the query: sites, without the front labels www, m and blog.
LISTED = tuple(f"{name}.example.{top}" for name, top in product(("cheap-pills", "casino-win", "adult-x"), ("com", "net", "org")))
#: Bits of one level at most: 16 MB as an array of longs.
MAX_BITS = 1 << 27
#: False positives of the levels after the first: a tenth, so that about log10 of the keys' number are needed.
RATE = 0.1
#: What is no part of a host's site, in order of removal.
AROUND_SITE = (r"(?s)^.*@", r":[0-9]*\z", r"[.]+\z", r"^(www|m|blog)[.]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path and site of every url."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    out = pages.select("page_id", rest.alias("rest"))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    out = out.select("page_id", F.translate(raw, UPPER, LOWER).alias("host"), F.regexp_extract(F.substring("rest", F.length(raw) + 1, F.length("rest")), r"^[^?#]*", 0).alias("path"))
    return out.withColumn("site", functools.reduce(lambda site, part: F.regexp_replace(site, part, ""), AROUND_SITE, F.col("host")))


def rule_of(rules) -> tuple[Column, Column]:
    """The longest fitting rule's name (host and path) and verdict."""
    name = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def positions(key: Column, level: int, bits: int, probes: int) -> list[Column]:
    """Places of a key: both halves of one hash, the second as the (odd) step; ``bits`` is a power of two."""
    one = F.xxhash64(F.lit(level), key)
    step = F.shiftrightunsigned(one, 32).bitwiseOR(F.lit(1))
    return [(one.bitwiseAND(F.lit(bits - 1)) + F.lit(j) * step).bitwiseAND(F.lit(bits - 1)) for j in range(probes)]


def shape(keys: int, false_positives: float) -> tuple[int, int]:
    """Bits (a power of two, whole longs) and probes of a level, of which there are 20 at most."""
    bits = 1 << max(6, math.ceil(math.log2(max(1, keys) * -math.log(false_positives) / math.log(2) ** 2)))
    return bits, min(20, max(1, math.ceil(-math.log2(false_positives))))


class Level:
    def __init__(self, keys: DataFrame, number: int, n: int, false_positives: float):
        self.number, (self.bits, self.probes) = number, shape(n, false_positives)
        places = keys.select(F.explode(F.array(*positions(F.col("site"), number, self.bits, self.probes))).alias("p"))
        words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p as int))")).alias("v"))
        every = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("v"))
        dense = every.union(words).groupBy("word").agg(F.bit_or("v").alias("v"))
        self.table = staged(dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "v"))), lambda x: x["v"]).alias("bits")))

    def passes(self, key: Column) -> Column:
        words = self.table.scalar()
        # of the shift's count the last six bits are taken; on a miss no further place is looked at
        bits = [F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p.cast("int"))) for p in positions(key, self.number, self.bits, self.probes)]
        return functools.reduce(lambda x, y: x & y, [bit != 0 for bit in bits])


def cascade(sites: DataFrame, max_bits: int = MAX_BITS) -> list[Level] | None:
    """Levels that tell the listed of ``sites`` (site, is_listed; no repeats) from the others; None: a level would be too large."""
    inside, outside = sites.where("is_listed").select("site"), sites.where("not is_listed").select("site")
    sizes = sites.agg(F.count_if("is_listed").alias("n"), F.count_if(~F.col("is_listed")).alias("rest")).first()
    n, levels, made = sizes.n, [], []
    rate = min(0.5, n / (math.sqrt(2) * max(1, sizes.rest)))
    while n:
        if shape(n, rate)[0] > max_bits:
            discard(*made, *(level.table for level in levels))
            return None
        levels.append(level := Level(inside, len(levels), n, rate))
        made.append(wrong := staged(outside.where(level.passes(F.col("site")))))
        inside, outside, n, rate = wrong, inside, wrong.count(), RATE
    discard(*made)
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether ``key`` is listed: the first level that it misses decides."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(levels[i].passes(key), out).otherwise(i % 2 == 1)
    return out


def part_of(site: Column, parts: int) -> Column:
    """Of 2, 4, 8 ... parts; the number that hashes a site to its part is no level's."""
    return F.pmod(F.xxhash64(F.lit(-1), site), F.lit(parts)).cast("int")


def cascades(sites: DataFrame, max_bits: int = MAX_BITS) -> list[list[Level]]:
    """One cascade a part: as few parts, 1, 2, 4 ..., as keep every level within ``max_bits``."""
    if max_bits < 64:
        raise ValueError("a level has 64 bits at least")
    parts = 1
    while True:
        out = []
        for part in range(parts):
            levels = cascade(sites.where(part_of(F.col("site"), parts) == part) if parts > 1 else sites, max_bits)
            if levels is None:
                break
            out.append(levels)
        else:
            return out
        discard(*(level.table for levels in out for level in levels))
        parts *= 2


def block_list(spark: SparkSession, sites=LISTED) -> DataFrame:
    return spark.createDataFrame([(s,) for s in sites], "site string").distinct()


def judged(pages: DataFrame, listed: DataFrame, rules=RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    urls = staged(parsed(pages))  # the site is a column of its own for all that probe it
    keys = urls.select("site", F.lit(False).alias("is_listed")).union(listed.select("site", F.lit(True)))
    # of the listed sites those that the table has: the cascade is exact over the table's sites alone
    per = keys.groupBy("site").agg(F.bool_or("is_listed").alias("is_listed"), F.bool_and("is_listed").alias("absent"))
    sites = staged(per.where("not absent").select("site", "is_listed"))
    built = cascades(sites, max_bits)
    discard(sites)
    if len(built) > 1:
        whole, urls = urls, staged(urls.withColumn("part", part_of(F.col("site"), len(built))), partition_by="part")
        discard(whole)
    shares = [urls.where(F.col("part") == i) if len(built) > 1 else urls for i in range(len(built))]
    marked = functools.reduce(DataFrame.union, [share.withColumn("is_listed", member(levels, F.col("site")) if levels else F.lit(False)) for share, levels in zip(shares, built, strict=True)])
    name, verdict = rule_of(rules)
    return marked.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"))


_FITS = [f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{i}}}'" for i, (h, p, _) in enumerate(RULES)]
_LONGEST = sorted(range(len(RULES)), key=lambda i: -len(RULES[i][0] + RULES[i][1]))
#: DuckDB: the list as values instead of filters.
ORACLE = f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM r),
p AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
v AS (SELECT *, CASE {" ".join(_FITS[i].format(*[h + q for h, q, _ in RULES]) for i in _LONGEST)} END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{h + q}' THEN '{says}'" for h, q, says in RULES)}
            WHEN {functools.reduce(lambda site, part: f"regexp_replace({site}, '{part}', '')", AROUND_SITE, "host")} IN ({", ".join(f"'{s}'" for s in LISTED)}) THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""
