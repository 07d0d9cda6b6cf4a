"""Source divergence audit: how far the words of each source stray from other sources and from their language.

Every language keeps the terms found in a least number of its documents. The sorted kept terms of a language become
minimal acyclic transducers with lexicographic ordinals, each over a range of at most ``SHARD`` terms. All texts are
streamed through them a second time, which counts occurrences by source and ordinal; from there on
ordinals stand for terms, also in ties, and only reported terms are spelled again by the transducers.

**Shares** are whole numbers, billionths of a group's kept occurrences plus a prior for every term, so
all arithmetic is exact. The divergence of two sources is the sum of absolute differences over all kept terms. A task
compares two tiles of about ``TILE`` sources over ``SPAN`` ordinals as whole matrices, absent terms at the prior's
share; the partial sums are added. The result itself holds every pair of sources of a language.

**Size.** Counts leave a task once per term and source, whatever a source's share of the rows is. Transducers reach the tasks in
groups of at most ``LOADED`` bytes of tables; a larger vocabulary is recounted in several passes over the texts.

Defined cases: null text, language and source are empty strings; repeated rows count as documents; a group without
kept terms has the prior's share of each; without kept terms all pairs of a language are at 0; an empty table gives
no rows; other columns are not used.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.scan import LETTER_BYTES, pieces, small_batches
from ledgerline.llm.transducer import Transducer
from ledgerline.session import shared_dir

TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Part of a share, and occurrences that every term is given beforehand.
UNIT, PRIOR = 1_000_000_000, 5
#: Terms of a transducer, and memory of those that are loaded together.
SHARD, LOADED = 50_000, 256 << 20
#: Entries that a task holds before it hands them on, and bytes of text that are read at once.
HELD, AT_ONCE = 500_000, 2 << 20
#: Sources of a tile and ordinals of a span.
TILE, SPAN = 256, 4_096


def _rows(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = F.lit("")
    return documents.select(F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"), F.coalesce(F.col(text), empty).cast("binary").alias("text"))


def _document_counts(batches):
    """In how many documents of its language each term occurs; handed on whenever much is held."""
    held: dict[str, Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["lang", "term", "docs"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own: set[bytes] = set()
            for piece in pieces(text.as_py().lower(), LETTER_BYTES):
                own.update(TERM.findall(piece))
            held[lang].update(own)
        if sum(map(len, held.values())) > HELD:
            yield from out()
    yield from out()


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term`` of the terms found in at least ``min_docs`` documents of their language."""
    found = rows.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term")


def transducers(kept: DataFrame) -> DataFrame:
    """``lang, first, n, size, packed``: transducers over consecutive ranges of each language's sorted terms."""

    def build(batches):
        lang, held = None, []

        def out() -> pa.RecordBatch:
            made = Transducer.build(held)
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([held[0]], pa.binary()), pa.array([len(held)], pa.int64()), pa.array([made.table_bytes], pa.int64()), pa.array([made.pack()], pa.binary())], names=["lang", "first", "n", "size", "packed"])

        for batch in batches:
            for own, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (own != lang or len(held) >= SHARD):
                    yield out()
                    held = []
                lang = own
                held.append(term)
        if held:
            yield out()

    return kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(build, "lang string, first binary, n long, size long, packed binary")


def _tokens(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of some texts at a time the bytes, and of each word the start, the end and the text's number."""
    held, numbers, size = [], [], 0

    def out():
        body = np.frombuffer(b" ".join([*held, b""]), np.uint8)
        inside = np.concatenate(([False], LETTER_BYTES[body]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        offsets = np.cumsum([0, *[len(x) + 1 for x in held]])
        return body, starts, ends, np.array(numbers)[np.searchsorted(offsets, starts, "right") - 1] if len(starts) else starts

    for nr, text in enumerate(texts):
        for piece in pieces(text, LETTER_BYTES, AT_ONCE):
            held.append(piece)
            numbers.append(nr)
            size += len(piece)
            if size >= AT_ONCE:
                yield out()
                held, numbers, size = [], [], 0
    if held:
        yield out()


def _recount(loaded: list[tuple[str, int, bytes]]) -> Callable:
    """Occurrences by language, source and ordinal; ``loaded`` holds language, first ordinal and packed transducer."""

    def count(batches):
        readers: dict[str, list[tuple[int, Transducer]]] = defaultdict(list)
        for lang, base, packed in loaded:
            readers[lang].append((base, Transducer.unpack(packed)))
        held: dict[tuple[str, str], list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        size = 0

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, place, np.concatenate([n for _, n in parts]))
            return found, sums

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), parts in held.items():
                found, sums = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array([source] * len(found), pa.string()), pa.array(found), pa.array(sums)], names=["lang", "source", "ordinal", "n"])
            held.clear()

        for batch in batches:
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            names = {g: k for k, g in enumerate(dict.fromkeys(g for g in groups if g[0] in readers))}
            lists = list(names)
            group_of = np.array([names.get(g, -1) for g in groups])
            lang_of = np.array([lang for lang, _ in lists])
            for body, starts, ends, text in _tokens([x.as_py().lower() if g[0] in readers else b"" for x, g in zip(batch.column(2), groups)]):
                if not len(starts):
                    continue
                group = group_of[text]
                for lang in {lists[g][0] for g in np.unique(group)}:
                    own = (lang_of == lang)[group]
                    for base, reader in readers[lang]:
                        found = reader.ordinals(body, starts[own], ends[own])
                        hit = found >= 0
                        whose, which, counts = _pairs(group[own][hit], found[hit])
                        for g in np.unique(whose):
                            mine = slice(*np.searchsorted(whose, [g, g + 1]))
                            held[lists[g]].append((which[mine] + base, counts[mine]))
                            size += mine.stop - mine.start
            if size > HELD:
                for g, parts in held.items():
                    held[g] = [merged(parts)]
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    return count


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two arrays in order, and how often each occurs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], np.diff(np.append(first, len(a)))


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * terms))`` in exact arithmetic; null without terms."""
    whole = (F.lit(UNIT).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(20,0)")).cast("decimal(38,0)")
    parts = F.when(terms > 0, total + PRIOR * terms).cast("decimal(38,0)")
    return F.call_function("div", whole, parts) + 1


def _apart(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of absolute differences between the sources of two tiles over one span of ordinals, each pair once."""
    lang, _, one, other = key
    width = int(rows["width"].iloc[0])
    base = rows[rows["ordinal"] < 0].sort_values("source", kind="stable")
    entries = rows[rows["ordinal"] >= 0]
    names = base["source"].to_numpy(object)
    place = {s: k for k, s in enumerate(names)}
    shares = np.repeat(base["p"].fillna(0).to_numpy(np.int64)[:, None], width, axis=1)
    if len(entries):
        shares[entries["source"].map(place).to_numpy(np.int64), entries["ordinal"].to_numpy(np.int64) % SPAN] = entries["p"].to_numpy(np.int64)
    tile = base["tile"].to_numpy()
    left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == other)
    pairs = [(k, right[right > k] if one == other else right) for k in left]
    values = [np.abs(shares[others] - shares[k]).sum(axis=1) for k, others in pairs]
    first = names[np.repeat(left, [len(others) for _, others in pairs])] if pairs else []
    second = names[np.concatenate([others for _, others in pairs])] if pairs else []
    found = {"a": pd.Series(first, dtype=object), "b": pd.Series(second, dtype=object), "value": np.concatenate(values) if values else np.zeros(0, np.int64)}
    return pd.DataFrame({"lang": pd.Series([lang] * len(first), dtype=object), **found})


class Audit:
    """The counts of one table, written below the shared folder, and what follows from them."""

    def __init__(self, documents: DataFrame, min_docs: int = 30, text: str = "text", lang: str = "lang", source: str = "source"):
        self.spark, self.folder = documents.sparkSession, shared_dir(documents.sparkSession, "divergence")
        rows = _rows(documents, text, lang, source)
        kept = self._kept(kept_terms(rows, min_docs), "terms")
        self.vocabulary = self._kept(transducers(kept), "transducers")
        self.counts = self._counted(rows)
        terms = self.vocabulary.groupBy("lang").agg(F.sum("n").alias("v"))
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = rows.select("lang", "source").distinct().join(terms, "lang", "left").join(totals, ["lang", "source"], "left")
        self.groups = self._kept(groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total")), "groups")

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        with small_batches(self.spark):
            df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def _ranges(self) -> DataFrame:
        """The transducers with the ordinal of their first term; one row for up to ``SHARD`` terms."""
        before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
        return self.vocabulary.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def _counted(self, rows: DataFrame) -> DataFrame:
        """``lang, source, ordinal, n``. One pass over the texts for each group of transducers that fits in memory."""
        parts, loaded, size = [], [], 0

        def recount() -> None:
            found = rows.mapInArrow(_recount(list(loaded)), "lang string, source string, ordinal long, n long")
            parts.append(f"{self.folder}/counts-{len(parts)}")
            with small_batches(self.spark):
                found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")).write.parquet(parts[-1])

        for row in self._ranges().select("lang", "base", "size", "packed").toLocalIterator():  # the driver holds one group at a time
            if loaded and size + row.size > LOADED:
                recount()
                loaded, size = [], 0
            loaded.append((row.lang, row.base, bytes(row.packed)))
            size += row.size
        if loaded:
            recount()
        schema = "lang string, source string, ordinal long, n long"
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def spelled(self) -> DataFrame:
        """``lang, ordinal, term`` of all kept terms, read out of the transducers."""

        def spell(batches):
            for batch in batches:
                for lang, base, packed in zip(*(c.to_pylist() for c in batch.columns)):
                    found = [t.decode() for t in Transducer.unpack(packed).terms()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(range(base, base + len(found)), pa.int64()), pa.array(found, pa.string())], names=["lang", "ordinal", "term"])

        return self._ranges().select("lang", "base", "packed").mapInArrow(spell, "lang string, ordinal long, term string")

    def marked_terms(self, top: int = 50) -> DataFrame:
        """``lang, source, item, value, rank``: the terms of which a group has more than its language, by the difference of shares."""
        whole = self.counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
        lang_total = self.groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
        found = self.counts.join(self.groups, ["lang", "source"]).join(whole, ["lang", "ordinal"]).join(lang_total, "lang")
        p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
        best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
        ranked = found.withColumn("value", p - q).filter("value > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        return ranked.join(self.spelled(), ["lang", "ordinal"]).select("lang", "source", F.col("term").alias("item"), "value", "rank")

    def distances(self) -> DataFrame:
        """``lang, a, b, value``: the divergence of every two sources of a language, each pair once."""
        tiles = self.groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
        groups = self.groups.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
        spans = F.greatest(F.lit(1), F.ceil(F.col("v") / SPAN)).cast("int")
        own = ["lang", "source", "tile", "tiles", "v"]
        base = groups.select(*own, F.explode(F.sequence(F.lit(0), spans - 1)).alias("span"), F.lit(-1).cast("long").alias("ordinal"), share(F.lit(0), F.col("total"), F.col("v")).alias("p"))
        entries = self.counts.join(groups, ["lang", "source"]).select(*own, F.floor(F.col("ordinal") / SPAN).cast("int").alias("span"), "ordinal", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
        sent = base.unionByName(entries).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        width = F.least(F.lit(SPAN).cast("long"), F.col("v") - F.col("span") * SPAN).cast("int")
        met = sent.select("lang", "span", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "source", "tile", "ordinal", "p", width.alias("width"))
        partial = met.groupBy("lang", "span", "one", "two").applyInPandas(_apart, "lang string, a string, b string, value long")
        return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    def pairs(self) -> DataFrame:
        """``lang, source, item, value, rank``: every other source of the language, the most distant first."""
        found = self.distances()
        both = found.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("pair"), "value")
        far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return both.select("lang", "pair.source", "pair.item", "value").withColumn("rank", F.row_number().over(far))

    def report(self, top: int = 50) -> DataFrame:
        """``lang, source, part, item, value, rank`` with the parts ``pair`` and ``term``."""
        parts = [self.pairs().withColumn("part", F.lit("pair")), self.marked_terms(top).withColumn("part", F.lit("term"))]
        return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
