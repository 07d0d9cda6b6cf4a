"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against all training tokens.

Words are lower-cased (A-Z) runs of digits, a-z and characters beyond ASCII. A window is ``n``
consecutive words of a benchmark item; an item of fewer words is one window. Every document
position is first looked up by its word pair, then by the hash of its whole window, and the
words are compared at last, so hash collisions cannot count.

Defined cases: a null or empty text has no words, no hits and stays; an item without words has
no window; a null item id is not listed; repeated documents each get the same answer; an empty
benchmark hits nothing. Other columns are kept by the removing functions as they are.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import ascii_lower, null_safe, text_key
from ledgerline.session import shared_dir

#: Everything between words of a lower-cased text, and of one as written.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Windows beyond which they are no longer broadcast but shuffled to the tokens.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK, -1), "")


def benchmark_windows(benchmark: DataFrame, n: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, window, size, head, hash``: the distinct windows of every item."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(n))
    return (
        items.select("item", "words", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("at"))
        .select("item", "size", F.slice("words", F.col("at"), F.col("size")).alias("window"))
        .distinct()
        .select("item", "size", "window", _head("window", F.lit(0), "size").alias("head"), F.xxhash64("window").alias("hash"))
    )


def _head(array: str, at: Column, size: str | None = None) -> Column:
    """Hash of the word pair at a place; windows of one word have a head of one word."""
    pair = F.xxhash64(F.get(array, at), F.get(array, at + 1))
    return pair if size is None else F.when(F.col(size) == 1, F.xxhash64(F.get(array, at))).otherwise(pair)


def hits(documents: DataFrame, windows: DataFrame, doc: str = "doc_id", text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``id, key, at, size, item``: every place where a window of an item occurs; ``at`` counts words from 0.

    ``key`` tells texts of one id apart. The windows are broadcast only if they are counted to be
    at most ``broadcast_windows``; beyond that both look-ups are shuffled joins.
    """
    totals = windows.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    small = totals.n <= broadcast_windows
    sent = F.broadcast if small else (lambda df: df)
    tokens = documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"), words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    # Beyond the broadcast only places and heads are shuffled for the first look-up; texts are moved once, for those with a hit.
    carried = ["words"] if small else []
    places = tokens.select("id", "key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))
    heads = windows.select("head").distinct()
    likely = [places.select("id", "key", *carried, "at", _head("words", F.col("at")).alias("head")).join(sent(heads), "head", "left_semi")]
    if 1 in (totals.sizes or []):
        alone = places.select("id", "key", *carried, "at", F.xxhash64(F.get("words", F.col("at"))).alias("head"))
        likely.append(alone.join(sent(windows.filter("size = 1").select("head").distinct()), "head", "left_semi"))
    found = reduce(DataFrame.unionByName, likely)
    if not small:
        met = found.groupBy(F.col("id").alias("i"), F.col("key").alias("k")).agg(F.collect_set("at").alias("places"))
        found = tokens.join(met, F.col("id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k"))).select("id", "key", "words", F.explode("places").alias("at"))
    sizes = F.array(*[F.lit(s) for s in totals.sizes or [0]])
    spans = found.select("id", "key", "at", "words", F.explode(sizes).alias("size")).select("id", "key", "at", "size", F.slice("words", F.col("at") + 1, F.col("size")).alias("window"))
    whole = spans.filter(F.size("window") == F.col("size"))  # at its end a text has no window of every size
    return (
        whole.withColumn("hash", F.xxhash64("window"))
        .join(sent(windows.select(F.col("hash"), F.col("window").alias("listed"), "item")), "hash")
        .filter(F.col("window") == F.col("listed"))
        .select("id", "key", "at", "size", "item")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per document: ``id, key, n_words, n_hit`` (words inside any window) and ``items``, the sorted ids of the items found."""
    folder = shared_dir(documents.sparkSession, "hits")
    hits(documents, benchmark_windows(benchmark, n), doc, text, broadcast_windows).write.parquet(folder)
    places = documents.sparkSession.read.parquet(folder)
    reach = F.col("at") + F.col("size")
    earlier = Window.partitionBy("id", "key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.groupBy("id", "key", "at").agg(F.max("size").alias("size")).withColumn("covered", F.max(reach).over(earlier))
    new = F.greatest(F.lit(0), reach - F.greatest(F.col("at"), F.coalesce("covered", "at")))
    n_hit = spans.groupBy("id", "key").agg(F.sum(new).alias("n_hit"))
    items = places.groupBy("id", "key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = n_hit.join(items, null_safe(n_hit, items, ["id", "key"])).select(n_hit["id"], n_hit["key"], "n_hit", "items")
    every = documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    return every.join(found, null_safe(every, found, ["id", "key"]), "left").select(every["id"], every["key"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_documents(documents: DataFrame, benchmark: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no window occurs, all columns unchanged."""
    bad = hits(documents, benchmark_windows(benchmark, n), doc, text).select("id", "key").distinct()
    return documents.join(bad, documents[doc].eqNullSafe(bad["id"]) & (text_key(documents[text]) == bad["key"]), "left_anti")


def remove_spans(documents: DataFrame, benchmark: DataFrame, n: int = 10, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents; in those with hits, the words inside windows are cut out, what stands between words stays."""
    places = hits(documents, benchmark_windows(benchmark, n), doc, text)
    cut = places.select("id", "key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("pos")).distinct()
    bad = cut.select("id", "key").distinct()
    source = documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text")).dropDuplicates(["id", "key"])
    source = source.join(bad, null_safe(source, bad, ["id", "key"]), "left_semi")
    pieces = source.select("id", "key", F.posexplode(F.arrays_zip(F.split("text", WORD, -1).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("word"))))
    kept = (
        pieces.join(cut.withColumn("gone", F.lit(True)), null_safe(pieces, cut, ["id", "key", "pos"]), "left")
        .select(pieces["id"], pieces["key"], pieces["pos"], F.concat("col.gap", F.when(F.col("gone"), F.lit("")).otherwise(F.coalesce("col.word", F.lit("")))).alias("piece"))
        .groupBy("id", "key")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "piece"))), lambda p: p["piece"]), "").alias("__text"))
    )
    joined = documents.join(kept, documents[doc].eqNullSafe(kept["id"]) & (text_key(documents[text]) == kept["key"]), "left")
    return joined.select(*[F.coalesce("__text", documents[c]).alias(c) if c == text else documents[c] for c in documents.columns])
