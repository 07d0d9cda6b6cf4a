"""URL filters: a blocked Bloom filter of listed keys passes possible hits to an exact join.

Two lists are looked up in this way: rules, which are a host (with all its subdomains) and the
beginning of a path, and canonical URLs. Each key sets three bits within one 64-bit block of the
filter, so that a look-up reads one block. What passes is joined with the list itself, which
removes the false positives. Each distinct URL is judged once.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule;
an empty list blocks nothing; repeated pages each get the answer; of a rule listed twice with
both verdicts, block wins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import UPPER
from ledgerline.session import shared_dir

#: Filter blocks (of 64 bits) up to which they are broadcast; beyond, look-ups are shuffled.
BROADCAST_BLOCKS = 1_000_000
KEYS_PER_BLOCK = 5


def host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)://([^/?#]*)", 1))
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, UPPER.lower())


def path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and default port, path without a closing slash or ``.html``, query without tracking parameters.

    Scheme and fragment are dropped. Null without a host.
    """
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"^(www|m)\.", "")
    way = F.regexp_replace(path(url), r"(/|/?index\.html?|\.html?)$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid|sid|session)(=|$)")))
    return F.when(name != "", F.concat(name, way, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """Three of 64 bits, from a second hash."""
    h = F.xxhash64(F.lit(1), key)
    bits = [F.expr("shiftleft(1L, cast(pmod(shiftright(__h, {}), 64) as int))".format(8 * i)) for i in range(3)]
    return h, bits


def _with_bits(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    h, bits = _mask(F.col(key))
    return keys.withColumn("__h", h).withColumn("mask", bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])).withColumn("block", _block(F.col(key), blocks)).drop("__h")


def possible_hits(probes: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows of ``probes`` whose ``key`` may be in ``listed`` (distinct keys): none that is listed is missed."""
    blocks = max(1, -(-listed.count() // KEYS_PER_BLOCK))
    bloom = _with_bits(listed.select(key), key, blocks).groupBy("block").agg(F.bit_or("mask").alias("word"))
    sent = F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom
    return _with_bits(probes, key, blocks).join(sent, "block").filter(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")).select(*probes.columns)


def rule_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule, verdict``: the longest rule that fits each URL. ``urls`` has ``url, host, path``; ``rules`` has ``host, path, verdict``.

    A URL's candidate keys are the ends of its host of as many labels as rules have, joined
    with the beginnings of its path of the lengths that rules have.
    """
    listed = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("verdict").alias("verdict"), F.max(F.length("path")).alias("n"))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]  # as many as a path has characters, at most
    depths = [r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect()]  # as many as a host has labels, at most
    labels = F.size(F.split("host", r"\."))
    ends = F.filter(F.array(*[F.when(labels >= d, F.substring_index("host", ".", -d)) for d in depths or [1]]), lambda e: e.isNotNull())
    starts = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths or [0]])
    keys = F.flatten(F.transform(ends, lambda e: F.transform(F.filter(starts, lambda s: s.isNotNull()), lambda s: F.concat(e, s))))
    probes = urls.filter(F.col("host") != "").select("url", F.explode(F.array_distinct(keys)).alias("key"))
    exact = possible_hits(probes, listed, "key").join(listed, "key")
    return exact.groupBy("url").agg(F.max(F.struct(F.length("key").alias("length"), F.col("n"), F.col("key").alias("rule"), "verdict")).alias("best")).select("url", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``row`` (the page), ``host, path, rule, verdict, listed``.

    The longest fitting rule decides; without one, a page is blocked if its canonical URL is in
    ``listed`` (one column, ``canonical``).
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical"))
    folder = shared_dir(spark, "urls")
    urls.write.parquet(f"{folder}/urls")
    urls = spark.read.parquet(f"{folder}/urls")
    names = listed.select("canonical").filter(F.col("canonical").isNotNull()).distinct()
    names.write.parquet(f"{folder}/listed")
    names = spark.read.parquet(f"{folder}/listed")
    ruled = rule_hits(urls.select("url", "host", "path"), rules)
    blocked = possible_hits(urls.select("url", "canonical").filter(F.col("canonical").isNotNull()), names, "canonical").join(names, "canonical", "left_semi").select("url", F.lit(True).alias("listed"))
    verdicts = urls.select("url", "host", "path").join(ruled, "url", "left").join(blocked, "url", "left")
    verdicts.write.parquet(f"{folder}/verdicts")
    verdicts = spark.read.parquet(f"{folder}/verdicts").withColumnRenamed("url", "__url")
    joined = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), F.col(url).alias("__own")).join(verdicts, F.col("__own") == F.col("__url"), "left")
    found = F.coalesce("listed", F.lit(False))
    return joined.select("row", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", F.coalesce("verdict", F.when(found, "block").otherwise("allow")).alias("verdict"), found.alias("listed"))
