"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. The expected copies are
summed up along the source, one offset is added, and a document is emitted once for every
integer its stretch of the sum crosses. Nothing is random between runs: the offset comes from a
seed and the source's name.

The order within a source is by size (so that what one document gives too much, its neighbour of
nearly equal size takes back) and then by hash. The sum is built without bringing a source
together: counts per size class, counts per slot of a class, and a rank within one slot of about
``slot_rows`` documents.

Defined cases: a null text has size 0; a null source is a source of its own, last in the order;
documents of size 0 may be copied but add nothing; if all sizes are 0 nothing is taken; equal
rows are told apart by rank; an empty table gives an empty mix.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import SPACED_WORD
from ledgerline.session import shared_dir

#: Rows of the plan, one for each source and size class, that are broadcast; more are shuffled.
BROADCAST_ROWS = 500_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACED_WORD)).cast("long")


def source_targets(totals: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """``source, source_size`` and the ``target`` of each source.

    Sources in code point order, nulls last, take the weights in turn and share ``share`` times
    the total size by weight. A target ends at ``most`` times its source's size; what is cut off
    is shared by weight among the rest until nothing is above. Sorted by ``size / weight`` the
    cut sources come first, so the first level at which the next source stays below its end
    gives every target. One row per source.
    """
    numbered = _prefixed(totals.select("source", "source_size"), [F.col("source").asc_nulls_last()], {"nth": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    weighted = numbered.withColumn("weight", weight).withColumn("end", F.lit(float(most)) * F.col("source_size"))
    sums = weighted.agg(F.sum("source_size").alias("everything"), F.sum("weight").alias("weights")).first()
    by_end = _prefixed(weighted, [(F.col("end") / F.col("weight")).asc(), F.col("nth").asc()], {"ends_before": F.col("end"), "weight_before": F.col("weight")})
    level = (F.lit(float(share)) * F.lit(sums.everything) - F.col("ends_before")) / (F.lit(sums.weights) - F.col("weight_before"))
    levels = by_end.withColumn("level", level)
    # the first source in this order that stays below its end has the level all others below share
    below = levels.filter(F.col("weight") * F.col("level") <= F.col("end"))
    chosen = below.agg(F.min(F.struct(F.col("end") / F.col("weight"), F.col("nth"), F.col("level").alias("level"))).alias("c")).first().c
    target = F.col("end") if chosen is None else F.least(F.col("weight") * F.lit(chosen["level"]), F.col("end"))
    return levels.select("source", "source_size", target.alias("target"))


def _prefixed(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with the sums of what comes before each in a total ``order``, and no task with all of them.

    Ranges of the order are written; their totals, one row for each, are summed up first.
    """
    spark, folder = rows.sparkSession, shared_dir(rows.sparkSession, "prefix")
    placed = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    upto = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = placed.groupBy("range").agg(*[F.sum(c).alias(f"{n}_sum") for n, c in sums.items()])
    starts = totals.select(F.col("range").alias("r"), *[F.coalesce(F.sum(f"{n}_sum").over(upto), F.lit(0)).alias(f"{n}_start") for n in sums])
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{n}_in") for n, c in sums.items()])
    joined = within.join(F.broadcast(starts), F.col("range") == F.col("r"))
    return joined.select(*rows.columns, *[(F.col(f"{n}_start") + F.col(f"{n}_in")).alias(n) for n in sums])


def _class(size: Column) -> Column:
    """Sixteen classes for each doubling of the size."""
    bits = F.length(F.bin(size))
    return F.when(bits <= 5, size).otherwise(bits * 16 + F.expr("shiftright(size, cast(length(bin(size)) as int) - 5)") % 16)


def _sized(documents: DataFrame, doc: str, text: str, source: str, *more: Column) -> DataFrame:
    key = F.md5(F.concat_ws("|", F.coalesce(F.col(doc).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))))
    # generated, not projected: the words are counted once, however often the size is used
    return documents.select(F.col(doc).alias("id"), F.col(source).alias("source"), key.alias("key"), *more, F.explode(F.array(word_count(F.col(text)))).alias("size")).withColumn("class", _class(F.col("size")).cast("int"))


def mix(documents: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7, slot_rows: int = 2_000, with_rows: bool = False, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document: ``id, source, size, source_size, target, copies``, and with ``with_rows`` also ``row``, the document with all its columns.

    Sizes are written once below the shared folder; texts are read again only for ``row``.
    """
    spark, folder = documents.sparkSession, shared_dir(documents.sparkSession, "sizes")
    sized = _sized(documents, doc, text, source)
    sized.write.parquet(folder)
    sizes = spark.read.schema(sized.schema).parquet(folder)
    docs = _sized(documents, doc, text, source, F.struct(*[documents[c] for c in documents.columns]).alias("row")) if with_rows else sizes
    hashed = F.conv(F.substring("key", 1, 12), 16, 10).cast("long")

    classes = sizes.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("class_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("slots", F.ceil(F.col("n") / slot_rows))
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce("source", F.lit("")), F.col("source").isNull().cast("string"))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = classes.join(targets.select(F.col("source").alias("s"), "source_size", "target"), classes["source"].eqNullSafe(F.col("s"))).select("s", F.col("class").alias("c"), "class_start", "slots", "source_size", "target", expected.alias("expected"), offset.alias("offset"))
    plan.write.parquet(f"{folder}-plan")
    plan = spark.read.schema(plan.schema).parquet(f"{folder}-plan")
    known = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(known, rows["source"].eqNullSafe(F.col("s")) & (rows["class"] == F.col("c"))).withColumn("slot", F.pmod(hashed, F.col("slots")))

    slots = placed(sizes).groupBy("s", "c", "slot").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("s", "c").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    # written and counted, so that documents are not moved for it: a row for each slot
    starts = slots.select(F.col("s").alias("s2"), F.col("c").alias("c2"), F.col("slot").alias("slot2"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("slot_start"))
    starts.write.parquet(f"{folder}-starts")
    starts = spark.read.schema(starts.schema).parquet(f"{folder}-starts")
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    ranked = placed(docs).withColumn("rank", F.row_number().over(Window.partitionBy("s", "c", "slot").orderBy("size", "key")))
    nth = F.col("class_start") + F.col("slot_start") + F.col("rank")
    crossed = F.floor(F.col("offset") + nth * F.col("expected")) - F.floor(F.col("offset") + (nth - 1) * F.col("expected"))
    joined = ranked.join(starts, F.col("s").eqNullSafe(F.col("s2")) & (F.col("c") == F.col("c2")) & (F.col("slot") == F.col("slot2")))
    return joined.select("id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", crossed.cast("long").alias("copies"), *(["row"] if with_rows else []))


def emit(documents: DataFrame, seed: int = 7, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, with ``copy`` counting from 1; all columns kept.

    A column that is already called ``copy`` is replaced.
    """
    taken = mix(documents, seed=seed, with_rows=True, doc=doc, text=text, source=source).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(*[F.col("row")[c].alias(c) for c in documents.columns if c != "copy"], "copy")
