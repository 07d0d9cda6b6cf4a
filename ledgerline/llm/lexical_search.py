"""Exact ranked lexical search with per-term geometric blocking.

**Vectors.** One scan turns every document into its length and the frequencies of the items' terms. Document and
term statistics are counted over all documents.

**Index.** Vectors are ordered by a similarity key (signs of random projections), so neighbours resemble one
another, and cut into cells of a fixed size; a key that very many documents share is divided by a salt. In each
cell every term's posting list is clustered by document similarity: some of its documents are pivots, the others go
to the pivot of largest inner product, and each cluster is one or more blocks. A block's summary holds, coordinate by
coordinate, the largest contribution of any of its documents before the term's weight.

**Search.** An item's terms are taken from the rarest on. The bound of a block of one term is the item's product
with the summary over this term and the more frequent ones: documents that hold a rarer term of the item are in
that term's blocks too. Blocks are opened by falling bounds, their documents scored on the whole vectors, and a
block is skipped only if its bound lies below the lowest of the best scores so far. So every result is exact.

**Size.** A summary covers only terms that some item asks for together with the block's term, more than
``COORDINATES`` of them in groups by their largest; items are served in blocks of bounded vocabulary, and
the cells of a long item hold fewer documents. Each task keeps the best documents of each item over all its cells, so
little leaves it. Vectors and index are written below the shared folder.

Defined cases: a null or empty text has no terms and is not counted; repeated rows are documents (or items) of their
own; null document ids come last among equal scores; an item without known terms gives no row; empty tables give
none; other columns are not used. Lengths times documents have to stay below 3 * 10 ** 17 (64-bit arithmetic).
"""

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.scan import WORD_BYTES, pieces, small_batches
from ledgerline.session import shared_dir

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Distinct terms, and terms in all, of the items that are served by one scan.
VOCABULARY, ITEM_TERMS = 200_000, 1_000_000
#: Distinct terms, and sum of squared lengths, of the items that share one dense matrix.
CHUNK_TERMS, CHUNK_PAIRS = 4_096, 4_000_000
#: Documents of a cell, entries of its matrix, documents of a block, coordinates of a summary.
CELL, MATRIX, BLOCK, COORDINATES = 2_048, 1 << 23, 32, 256
#: Random projections that make the similarity key.
PROJECTIONS = 16


def terms(text: bytes | None) -> Counter:
    """How often each term occurs."""
    found: Counter = Counter()
    for piece in pieces((text or b"").lower(), WORD_BYTES):
        found.update(TERM.findall(piece))
    return found


def _vectors(place: dict[bytes, int]) -> Callable:
    def scan(batches):
        for batch in batches:
            lengths, found, often = [], [], []
            for text in batch.column(1):
                own = terms(text.as_py())
                lengths.append(own.total())
                known = [(place[t], n) for t, n in own.items() if t in place]
                found.append([k for k, _ in known])
                often.append([n for _, n in known])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))], names=["id", "n", "terms", "tf"])

    return scan


def impact(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to a document's score before its weight, at most a million."""
    m = 100 - 25 + (25 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _directions(size: int) -> np.ndarray:
    return np.random.default_rng(17).standard_normal((size, PROJECTIONS)).astype(np.float32)


def _projected(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n_rows: int, directions: np.ndarray) -> np.ndarray:
    """Random projections of sparse rows; ``rows`` must be sorted."""
    found = np.zeros((n_rows, PROJECTIONS), np.float32)
    if len(rows):
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        found[rows[starts]] = np.add.reduceat(values[:, None].astype(np.float32) * directions[columns], starts)
    return found


class Chunk:
    """Items that share one matrix, whose columns are their terms from the rarest on."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray):
        """``items``: number, terms from the rarest on, how often each is asked for. ``weights`` belong to all terms of the scan."""
        self.items, self.weights = items, weights

    def prepare(self, rank: np.ndarray) -> "Chunk":
        """Everything that does not depend on the documents; made in each task once."""
        used = np.unique(np.concatenate([found for _, found, _ in self.items]))
        self.terms = used[np.argsort(rank[used])]
        self.by_term = np.argsort(self.terms)
        place = np.argsort(rank[used])
        column = np.empty(len(used), np.int64)
        column[place] = np.arange(len(used))
        self.asked = [(nr, column[np.searchsorted(used, found)], often * self.weights[found]) for nr, found, often in self.items]
        self.owners: dict[int, list[tuple[int, int]]] = {}
        for k, (_, columns, _) in enumerate(self.asked):
            for at, c in enumerate(columns):
                self.owners.setdefault(int(c), []).append((k, at))
        self._coordinates: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._products: dict[int, np.ndarray] = {}
        return self

    def columns_of(self, found: np.ndarray) -> np.ndarray:
        """Columns of terms; -1 for those that no item of the chunk asks for."""
        ordered = self.terms[self.by_term]
        at = np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)
        return np.where(ordered[at] == found, self.by_term[at], -1)

    def coordinates(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """The columns that some item asks for together with column ``c`` and no rarer than it, and where their groups begin."""
        if c not in self._coordinates:
            after = [self.asked[k][1][at:] for k, at in self.owners[c]]
            found = after[0] if len(after) == 1 else np.unique(np.concatenate(after))
            groups = np.unique(np.linspace(0, len(found), min(len(found), COORDINATES), endpoint=False).astype(np.int64))
            self._coordinates[c] = found, groups
        return self._coordinates[c]

    def products(self, c: int) -> np.ndarray:
        """For each item that asks for column ``c`` the weights of the groups of its coordinates, one column an item."""
        if c not in self._products:
            found, groups = self.coordinates(c)
            made = np.zeros((len(groups), len(self.owners[c])), np.int64)
            for nth, (k, at) in enumerate(self.owners[c]):
                _, columns, weights = self.asked[k]
                group = np.searchsorted(groups, np.searchsorted(found, columns[at:]), "right") - 1
                np.add.at(made[:, nth], group, weights[at:])
            self._products[c] = made
        return self._products[c]

    @cached_property
    def rows(self) -> int:
        return int(max(1, min(CELL, MATRIX // max(1, len(self.terms)))))

    @cached_property
    def directions(self) -> np.ndarray:
        return _directions(len(self.terms)) * self.weights[self.terms][:, None].astype(np.float32)


def dense(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    found = np.zeros(shape, np.int32)
    found[rows, columns] = impacts
    return found


def blocks_of(chunk: Chunk, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of all posting lists of a cell: their column, number of documents, documents, and summaries."""
    matrix = dense(rows, columns, impacts, (n_rows, len(chunk.terms)))
    near = _projected(rows, columns, impacts, n_rows, chunk.directions)
    order = np.argsort(columns, kind="stable")
    held, starts = np.unique(columns[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    whose, sizes, members, summaries = [], [], [], []
    for c, start, end in zip(held.tolist(), starts, ends):
        found = rows[order[start:end]]
        cuts = np.zeros(1, np.int64)
        if len(found) > BLOCK:
            pivots = near[found[:: BLOCK]]
            cluster = np.argmax(near[found] @ pivots.T, axis=1)
            sorted_ = np.argsort(cluster, kind="stable")
            found, cluster = found[sorted_], cluster[sorted_]
            begins = np.flatnonzero(np.concatenate(([True], cluster[1:] != cluster[:-1])))
            within = np.arange(len(found)) - np.repeat(begins, np.diff(np.append(begins, len(found))))
            cuts = np.flatnonzero(within % BLOCK == 0)
        asked, groups = chunk.coordinates(c)
        part = matrix[np.ix_(found, asked)]
        if len(groups) < len(asked):
            part = np.maximum.reduceat(part, groups, axis=1)
        summaries.append(np.maximum.reduceat(part, cuts, axis=0).ravel())
        whose.append(np.full(len(cuts), c, np.int32))
        sizes.append(np.diff(np.append(cuts, len(found))).astype(np.int32))
        members.append(found.astype(np.int32))
    return np.concatenate(whose), np.concatenate(sizes), np.concatenate(members), np.concatenate(summaries)


class Best:
    """The best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        for n in np.flatnonzero(scores >= self.least):
            self.rows.append((int(scores[n]), ids[n]))
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(1, self.rows[-1][0])


def search_cell(chunk: Chunk, best: list[Best], ids: list, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, whose: np.ndarray, sizes: np.ndarray, members: np.ndarray, summaries: np.ndarray) -> tuple[int, int]:
    """Offers the documents of one cell to the items' best. Returns how many blocks were met and opened."""
    matrix = None
    first = np.concatenate(([0], np.cumsum(sizes)))
    held, begins, counts = np.unique(whose, return_index=True, return_counts=True)
    item_of, block_of, bound_of = [], [], []
    at = 0
    for c, begin, count in zip(held.tolist(), begins, counts):
        width = len(chunk.coordinates(c)[1])
        summary = summaries[at : at + count * width].reshape(count, width)
        at += count * width
        bounds = summary.astype(np.int64) @ chunk.products(c)
        owners = np.array([k for k, _ in chunk.owners[c]])
        least = np.array([best[k].least for k in owners])
        b, o = np.nonzero(bounds >= least)
        item_of.append(owners[o])
        block_of.append(begin + b)
        bound_of.append(bounds[b, o])
    met = int(sum(count * len(chunk.owners[c]) for c, count in zip(held.tolist(), counts)))
    items, blocks, bounds = np.concatenate(item_of), np.concatenate(block_of), np.concatenate(bound_of)
    order = np.lexsort((-bounds, items))
    items, blocks, bounds = items[order], blocks[order], bounds[order]
    opened = 0
    edges = np.flatnonzero(np.concatenate(([True], items[1:] != items[:-1]))) if len(items) else np.zeros(0, np.int64)
    for begin, end in zip(edges, np.append(edges[1:], len(items))):
        k = int(items[begin])
        _, asked, weights = chunk.asked[k]
        seen = np.zeros(len(ids), bool)
        step = 4
        while begin < end and bounds[begin] >= best[k].least:
            upto = min(end, begin + step)
            some = blocks[begin:upto][bounds[begin:upto] >= best[k].least]
            opened += len(some)
            found = np.unique(np.concatenate([members[first[x] : first[x + 1]] for x in some]))
            found = found[~seen[found]]
            seen[found] = True
            if len(found):
                if matrix is None:
                    matrix = dense(rows, columns, impacts, (len(ids), len(chunk.terms)))
                best[k].offer(matrix[np.ix_(found, asked)].astype(np.int64) @ weights, [ids[x] for x in found])
            begin, step = upto, step * 2
    return met, opened


def _packed(x: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


_INDEX = ["rows", "columns", "impacts", "whose", "sizes", "members", "summaries"]


class LexicalIndex:
    """The index of all documents for one block of items, whose vocabulary is bounded."""

    def __init__(self, documents: DataFrame, items: list[tuple[object, Counter]], doc: str = "doc_id", text: str = "text"):
        self.spark, self.items = documents.sparkSession, items
        self.folder = shared_dir(self.spark, "lexical")
        self.kind = documents.schema[doc].dataType.simpleString()
        vocabulary = sorted(set().union(*[found for _, found in items]))
        self.place = {t: k for k, t in enumerate(vocabulary)}
        source = documents.select(F.col(doc).alias("id"), F.col(text).cast("binary").alias("text"))
        with small_batches(self.spark):
            source.mapInArrow(_vectors(self.place), f"id {self.kind}, n long, terms array<int>, tf array<long>").write.parquet(f"{self.folder}/vectors")
        self.vectors = self.spark.read.parquet(f"{self.folder}/vectors").filter("n > 0")
        totals = self.vectors.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        self.documents, self.length = totals.documents, totals.length
        self.holding = np.zeros(len(vocabulary), np.int64)
        for row in self.vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():  # one narrow row for each of the bounded vocabulary
            self.holding[row.term] = row.df
        self.weights = np.array([weight(self.documents, int(df)) for df in self.holding], np.int64)
        order = np.lexsort((np.arange(len(vocabulary)), self.holding))
        self.rank = np.empty(len(vocabulary), np.int64)
        self.rank[order] = np.arange(len(vocabulary))
        self.chunks = self._chunks()

    def _chunks(self) -> list[Chunk]:
        made, group, used, pairs = [], [], set(), 0
        for nr, (_, counts) in enumerate(self.items):
            known = sorted((t for t in map(self.place.get, counts) if self.holding[t]), key=lambda t: self.rank[t])
            if not known:
                continue
            often = {self.place[t]: n for t, n in counts.items()}
            one = (nr, np.array(known, np.int64), np.array([often[t] for t in known], np.int64))
            if group and (len(used.union(known)) > CHUNK_TERMS or pairs + len(known) ** 2 > CHUNK_PAIRS):
                made.append(Chunk(group, self.weights))
                group, used, pairs = [], set(), 0
            group.append(one)
            used.update(known)
            pairs += len(known) ** 2
        return [*made, Chunk(group, self.weights)] if group else made

    def build(self) -> DataFrame:
        """One row for each cell and chunk: documents, vectors, blocks and summaries, packed."""
        chunks, rank, documents, length, kind, weights = self.chunks, self.rank, self.documents, self.length, self.vectors.schema["id"].dataType, self.weights

        def keyed(batches):
            directions = _directions(len(rank)) * weights[:, None].astype(np.float32)
            for batch in batches:
                found = batch.column(2)
                sizes = np.diff(found.offsets.to_numpy())
                rows = np.repeat(np.arange(batch.num_rows), sizes)
                tf = batch.column(3).flatten().to_numpy()
                near = _projected(rows, found.flatten().to_numpy(), np.log1p(tf), batch.num_rows, directions)
                key = (near > 0) @ (1 << np.arange(PROJECTIONS, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key, pa.int64())], names=["id", "n", "terms", "tf", "near"])

        def cells(batches) -> Iterator[pa.RecordBatch]:
            ready = [c.prepare(rank) for c in chunks]
            wait: list[pa.RecordBatch] = []
            n = 0
            for batch in batches:
                wait.append(batch)
                n += batch.num_rows
                while n >= CELL:
                    table = pa.Table.from_batches(wait).combine_chunks()
                    yield from indexed(table.slice(0, CELL), ready)
                    wait, n = table.slice(CELL).to_batches(), n - CELL
            if n:
                yield from indexed(pa.Table.from_batches(wait), ready)

        def indexed(table: pa.Table, ready: list[Chunk]) -> Iterator[pa.RecordBatch]:
            for nth, chunk in enumerate(ready):
                for start in range(0, table.num_rows, chunk.rows):
                    part = table.slice(start, chunk.rows).combine_chunks().to_batches()[0]
                    sizes = np.array([len(x) for x in part.column(2)], np.int64)
                    rows = np.repeat(np.arange(part.num_rows), sizes)
                    columns = chunk.columns_of(part.column(2).flatten().to_numpy())
                    impacts = impact(part.column(3).flatten().to_numpy(), part.column(1).to_numpy()[rows], documents, length)
                    known = columns >= 0
                    if not known.any():
                        continue
                    rows, columns, impacts = rows[known], columns[known], impacts[known]
                    packed = [rows, columns, impacts, *blocks_of(chunk, rows, columns, impacts, part.num_rows)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([nth], pa.int32()), pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), *[pa.array([_packed(x, "<i4")], pa.binary()) for x in packed]],
                        names=["chunk", "ids", *_INDEX],
                    )

        near = self.vectors.filter(F.size("terms") > 0).select("id", "n", "terms", "tf").mapInArrow(keyed, f"id {self.kind}, n long, terms array<int>, tf array<long>, near long")
        dealt = near.repartitionByRange(F.col("near"), F.xxhash64("id", "n", "terms")).sortWithinPartitions("near").select("id", "n", "terms", "tf")
        path = f"{self.folder}/index"
        dealt.mapInArrow(cells, f"chunk int, ids array<{kind.simpleString()}>, {', '.join(f'{c} binary' for c in _INDEX)}").write.parquet(path)
        return self.spark.read.parquet(path)

    def search(self, index: DataFrame, k: int = 20) -> DataFrame:
        """``nr`` (the item's number in the block), ``rank``, ``id``, ``score``."""
        chunks, rank, kind = self.chunks, self.rank, self.kind

        def tops(batches):
            ready: dict[int, tuple[Chunk, list[Best]]] = {}
            id_type = None
            for batch in batches:
                id_type = batch.column(1).type.value_type
                for row in range(batch.num_rows):
                    nth = batch.column(0)[row].as_py()
                    if nth not in ready:
                        chunk = chunks[nth].prepare(rank)
                        ready[nth] = chunk, [Best(k) for _ in chunk.asked]
                    chunk, best = ready[nth]
                    arrays = [np.frombuffer(batch.column(2 + c)[row].as_py(), "<i4") for c in range(len(_INDEX))]
                    search_cell(chunk, best, batch.column(1)[row].as_py(), *arrays)
            for chunk, best in ready.values():
                found = [(nr, score, doc) for (nr, _, _), own in zip(chunk.asked, best) for score, doc in own.rows]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], id_type)], names=["nr", "score", "id"])

        found = index.mapInArrow(tops, f"nr long, score long, id {kind}")
        best_first = Window.partitionBy("nr").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k).select("nr", "rank", "id", "score")


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, Counter]]]:
    """The items with their terms in blocks of bounded vocabulary; the driver holds one block at a time."""
    block, used, total = [], set(), 0
    for row in items.select(F.col(item).alias("item"), F.col(text).cast("binary").alias("text")).toLocalIterator():
        own = terms(bytes(row.text) if row.text is not None else None)
        if not own:
            continue
        if block and (len(used | own.keys()) > VOCABULARY or total + len(own) > ITEM_TERMS):
            yield block
            block, used, total = [], set(), 0
        block.append((row.item, own))
        used |= own.keys()
        total += len(own)
    if block:
        yield block


def ranked(documents: DataFrame, items: DataFrame, k: int = 20, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item, rank, id, score``: the ``k`` best documents of every item, the best first, equal scores by id."""
    spark = documents.sparkSession
    folder = shared_dir(spark, "ranked")
    schema = f"item {items.schema[item].dataType.simpleString()}, rank int, id {documents.schema[doc].dataType.simpleString()}, score long"
    paths = []
    for block in item_blocks(items, item, item_text):
        index = LexicalIndex(documents, block, doc, text)
        if not index.chunks:
            continue
        names = spark.createDataFrame([(nr, name) for nr, (name, _) in enumerate(block)], f"nr long, item {items.schema[item].dataType.simpleString()}")
        paths.append(f"{folder}/{len(paths)}")
        index.search(index.build(), k).join(names, "nr").select("item", "rank", "id", "score").write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
