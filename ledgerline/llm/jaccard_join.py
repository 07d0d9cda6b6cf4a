"""Exact Jaccard join in the metric space of shingle sets, with distance ``d = 1 - similarity``.

**Pivots and Voronoi regions.** The pivots are the sets of a single shingle, in one global order:
shingles that many documents share come last, the others by hash. A set ``x`` is at distance
``1 - 1 / |x|`` from every pivot it holds and at 1 from all others; its home is the first of its
nearest pivots. (Whole documents as the only pivots do not divide a corpus: unrelated documents are at
distance 1 from all of them, so every window reaches everywhere.)

**Windows.** If ``y`` holds none of the first ``i`` pivots of ``x``, then ``d(x, y) >= i / |x|``. Within
radius ``r`` only the first ``|x| - ceil((1 - r) |x|) + 1`` pivots of ``x`` matter, and the document is
replicated to exactly those regions. Two sets within ``r`` have their first common pivot in both windows.

**Document pivots.** In every region the document with the fewest pivots before this one becomes a pivot
itself, and all members are compared with it, which joins large groups of near copies by a star of
links instead of all pairs. Regions whose members are all connected by then are done.

**Home regions.** Where more than ``PAIRS`` pairs are left, the members of a home region - each set is in one only - are
compared in blocks, which connects most of what is left of a large group with one copy of each set.

**Recursion.** In the regions that more than one connected part still meets in, members outside the largest part
are compared with the rest: small regions by a join, large ones by every two of their blocks. A first task divides its
blocks recursively by distances of histograms to members as pivots, with windows on both sides of each border, and
finds who can have a partner there, in the first region that both share. A second task divides only those, by Jaccard
distances, and counts overlaps of whole sets. What leaves is a spanning forest of the parts, never the pairs. The
comparisons within a large group of mutually distant near copies grow with its square, spread over pairs of blocks.

**Candidates** of stars and small regions pass two bounds that hold for every pair within the radius - sizes, and the distance between
histograms of their shingles, which never exceeds the symmetric difference - before the whole sets
are compared. All of this is exact, up to equal 64-bit hashes of different shingles.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing;
with fewer words than a shingle the whole sequence is one shingle; equal sets are one class and always
linked; rows repeated with one id are each judged by their own text; a null id only names a group in
which all ids are null; other columns are not used.
"""

import hashlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.jaccard_blocks import Forest, Sets, forest
from ledgerline.llm.scan import small_batches
from ledgerline.llm.text import text_key
from ledgerline.session import shared_dir

SPACE = b" \t\n\x0b\x0c\r"
#: Sets in a region beyond which its pivot goes to the end of the order, and rounds of ordering.
COMMON = 24
ORDERINGS = 1
#: Bits of the map of common pivots; a shingle that shares its place with a common one is moved too, which is harmless.
MAP_BITS = 22
#: Buckets of the histograms.
BUCKETS = 128
#: Rows of keys that are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Pairs left to compare beyond which a region is joined in blocks; members and shingles of a block.
PAIRS = 2_000
BLOCK = 1_024
SHINGLES = 1 << 19
#: Pairs of histograms that are compared at once.
AT_ONCE = 1 << 14


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACES = np.zeros(256, bool)
_SPACES[list(SPACE)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each run of characters other than ASCII white space, A-Z in lower case."""
    body = np.frombuffer(text.lower(), np.uint8)
    inside = np.concatenate(([False], ~_SPACES[body], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    letters = np.flatnonzero(inside[1:-1])
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE | np.uint64(1), np.uint64))
    sums = np.add.reduceat(_BYTES[body[letters]] * powers[place], first)
    return _mix(sums + lengths.astype(np.uint64) * _BASE)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; the whole sequence as one if it is shorter."""
    hashes = word_hashes(text or b"")
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    n = len(hashes) - size + 1
    total, steps = np.zeros(n, np.uint64), np.arange(1, size + 1, dtype=np.uint64) * _BASE
    for k in range(size):
        total = _mix(total + hashes[k : k + n] + steps[k])
    return np.unique(total)


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def ordered(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Shingles in the order of the pivots: those marked as common last, all by hash."""
    if not len(common):
        return found
    late = common[_place(found)]
    return np.concatenate((found[~late], found[late]))


def window(size: int, similarity: Fraction) -> int:
    """Pivots of a set of that size to which it is replicated: all but those its partners have to share."""
    return size - -(-size * similarity.numerator // similarity.denominator) + 1 if size else 0


def _signed(words: int) -> Callable:
    def sign(batches):
        for batch in batches:
            found = [shingles(x.as_py(), words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([_signature(x) for x in found], pa.binary())], names=["row", "n", "c"])

    return sign


def _described(words: int, similarity: Fraction, common: np.ndarray) -> Callable:
    def describe(batches):
        for batch in batches:
            signatures, sizes, windows, histograms = [], [], [], []
            for text in batch.column(0):
                found = shingles(text.as_py(), words)
                n = len(found)
                signatures.append(_signature(found))
                sizes.append(n)
                windows.append(ordered(found, common)[: window(n, similarity)].view(np.int64).copy())  # without the rest of the set
                histograms.append(np.minimum(np.bincount(found.view(np.int64) & (BUCKETS - 1), minlength=BUCKETS), 32767).astype(">i2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(signatures, pa.binary()), pa.array(sizes, pa.int64()), pa.array(windows, pa.list_(pa.int64())), pa.array(histograms, pa.binary())],
                names=["c", "n", "win", "histogram"],
            )

    return describe


def _signature(found: np.ndarray) -> bytes:
    """128 bits of a set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _close(a: Column, b: Column, similarity: Fraction) -> Column:
    """Sizes under which two sets can be within the radius."""
    return (F.least(a, b) * similarity.denominator >= F.greatest(a, b) * similarity.numerator)


def metric_pairs(left: np.ndarray, right: np.ndarray, histograms: np.ndarray, radius: int):
    """Index pairs, one of ``left`` and one of ``right``, whose histograms are within ``radius``, by recursive division.

    Distances are sums of absolute differences, for which the triangle inequality holds.
    """
    work = [(left, right)]
    while work:
        a, b = work.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) > AT_ONCE:
            pivot = histograms[a[len(a) // 2]]
            da, db = np.abs(histograms[a] - pivot).sum(1), np.abs(histograms[b] - pivot).sum(1)
            border = np.median(np.concatenate((da, db)))
            parts = [
                (a[da <= border], b[db <= border]),
                (a[da > border], b[db > border]),
                (a[(da <= border) & (da >= border - radius)], b[(db > border) & (db <= border + radius)]),
                (a[(da > border) & (da <= border + radius)], b[(db <= border) & (db >= border - radius)]),
            ]
            if sum(len(x) * len(y) for x, y in parts) < 0.9 * len(a) * len(b):
                work.extend(parts)
                continue
        step = max(1, AT_ONCE // len(b))
        for k in range(0, len(a), step):
            some = a[k : k + step]
            x, y = np.nonzero(np.abs(histograms[some][:, None] - histograms[b][None]).sum(2, dtype=np.int32) <= radius)
            yield some[x], b[y]


def _block_candidates(similarity: Fraction) -> Callable:
    s = similarity

    def groups(key: tuple, rows: pa.Table) -> pa.Table:
        """The members with a possible partner, each with the group it is connected with by such pairs."""
        i, j = (k.as_py() for k in key[1:])
        n, block = (rows.column(c).to_numpy() for c in ("n", "block"))
        minor, part = rows.column("minor").to_numpy(), _numbered(rows.column("part"))
        histograms = np.frombuffer(b"".join(rows.column("histogram").to_pylist()), ">i2").reshape(-1, BUCKETS).astype(np.int16)
        radius = 2 * int(n.max()) * (s.denominator - s.numerator) // (s.denominator + s.numerator)
        earlier = [set(x) for x in rows.column("earlier").to_pylist()]
        joined = Forest(len(n))
        for x, y in metric_pairs(np.flatnonzero(block == i), np.flatnonzero(block == j), histograms, radius):
            total, apart = n[x] + n[y], np.abs(histograms[x] - histograms[y]).sum(1, dtype=np.int64)
            right = (x != y) & (part[x] != part[y]) & (minor[x] | minor[y]) & (apart * (s.denominator + s.numerator) <= total * (s.denominator - s.numerator))
            for k, m in zip(x[right].tolist(), y[right].tolist()):
                if joined.root(k) != joined.root(m) and earlier[k].isdisjoint(earlier[m]):
                    joined.join(k, m)
        group = np.array([joined.root(k) for k in range(len(n))], np.int64)
        found = np.bincount(group, minlength=len(n))[group] > 1
        some = rows.select(["pivot", "i", "j", "block", "c", "part", "minor"]).append_column("group", pa.array(group))
        return some.filter(pa.array(found))

    return groups


def _block_links(similarity: Fraction) -> Callable:
    def links(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = (k.as_py() for k in key[1:3])
        sets = Sets([np.frombuffer(x, np.uint64) for x in rows.column("found").to_pylist()])
        block, minor = rows.column("block").to_numpy(), rows.column("minor").to_numpy()
        c = rows.column("c").to_pylist()
        found = forest(sets, _numbered(rows.column("part")), minor, np.flatnonzero(block == i), np.flatnonzero(block == j), similarity)
        ends = [(min(c[x], c[y]), max(c[x], c[y])) for x, y in found]
        return pa.table({"a": pa.array([a for a, _ in ends], pa.binary()), "b": pa.array([b for _, b in ends], pa.binary())})

    return links


def _numbered(parts: pa.ChunkedArray) -> np.ndarray:
    """A number for each connected part."""
    return parts.combine_chunks().dictionary_encode().indices.to_numpy()


class JaccardJoin:
    """One join. Its tables are written below one folder, which cuts the lineage for lost executors."""

    def __init__(self, documents: DataFrame, words: int = 5, similarity: Fraction = Fraction(4, 5), doc: str = "doc_id", text: str = "text"):
        self.spark, self.words, self.similarity = documents.sparkSession, words, similarity
        self.folder, self.tables = shared_dir(self.spark, "jaccard"), 0
        self.kind = documents.schema[doc].dataType.simpleString()
        self.texts = documents.select(F.struct(F.col(doc).alias("id"), text_key(F.col(text)).alias("key")).alias("row"), F.col(text).cast("binary").alias("text"))

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path, self.tables = f"{self.folder}/{self.tables}-{name}", self.tables + 1
        with small_batches(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _texts_of(self, rows: DataFrame) -> DataFrame:
        """The texts of some rows, given by ``id`` and ``key`` in a written table."""
        wanted = self._sent(rows)
        return self.texts.join(wanted, self.texts["row.id"].eqNullSafe(wanted["id"]) & (self.texts["row.key"] == wanted["key"]), "left_semi")

    def _described(self, texts: DataFrame, common: np.ndarray) -> DataFrame:
        return texts.select("text").mapInArrow(_described(self.words, self.similarity, common), "c binary, n long, win array<long>, histogram binary")

    def _common(self, classes: DataFrame, common: np.ndarray) -> np.ndarray:
        """Adds the pivots of crowded regions to the map; its size is fixed, whatever the data."""
        place = F.shiftrightunsigned("pivot", 64 - MAP_BITS)
        crowded = self._entries(classes).groupBy("pivot").agg(F.count("*").alias("m")).filter(F.col("m") > COMMON)
        blocks = crowded.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("block")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        marked = common.copy() if len(common) else np.zeros(1 << MAP_BITS, bool)
        with small_batches(self.spark):  # the texts are read here
            rows = blocks.collect()  # at most 2 ** MAP_BITS / 64 rows
        for row in rows:
            bits = np.array([row.bits], np.int64).view(np.uint8)
            marked[row.block * 64 : row.block * 64 + 64] |= np.unpackbits(bits, bitorder="little").astype(bool)
        return marked

    def _window(self) -> Column:
        return F.col("n") - F.ceil(F.col("n") * self.similarity.numerator / self.similarity.denominator) + 1

    def _possible(self, at: Column, other_at: Column, n: Column, other_n: Column) -> Column:
        """Whether two sets can be within the radius: at their first common pivot, what stands before is in one of them only."""
        s = self.similarity
        return (at + other_at) * (s.denominator + s.numerator) <= (n + other_n) * (s.denominator - s.numerator)

    def _sent(self, df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
        """A written table of one or two narrow columns, broadcast if it is counted to be small enough."""
        return F.broadcast(df) if df.count() <= rows else df

    def _entries(self, classes: DataFrame) -> DataFrame:
        """``pivot, at, c, n``: every set in every region of its window. Sets too small to differ and still be linked are left out."""
        s = self.similarity
        can_differ = F.col("n") * (s.denominator - s.numerator) >= s.numerator
        return classes.filter(can_differ).select("c", "n", F.posexplode(F.slice("win", F.lit(1), F.least(self._window(), F.size("win")).cast("int"))).alias("at", "pivot"))

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """``members`` (``id, key, n, c``) and the distinct non-empty ``classes`` (``c, n, win, histogram``), in the final order of pivots.

        Sets are told apart by their signatures first; windows are made from the text of one member of each class.
        """
        signed = self.texts.mapInArrow(_signed(self.words), f"row struct<id:{self.kind},key:bigint>, n long, c binary")
        members = self._kept(signed.select("row.id", "row.key", "n", "c"), "members")
        first = members.filter("n > 0").groupBy("c").agg(F.min(F.struct("id", "key")).alias("row"))
        self.first = self._kept(first.select("c", "row.id", "row.key"), "first")
        texts = self._texts_of(self.first.select("id", "key"))
        # rows that repeat both id and text would be described more than once
        repeated = members.groupBy("id", "key").agg(F.count("*").alias("m")).filter("m > 1").limit(1).count() > 0
        common = np.zeros(0, bool)
        for _ in range(ORDERINGS):
            found = self._described(texts, common)
            common = self._common(found.dropDuplicates(["c"]) if repeated else found, common)
        found = self._described(texts, common)
        return members, self._kept(found.dropDuplicates(["c"]) if repeated else found, "classes")

    def _verified(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """Of candidate pairs ``a, b`` of classes those within the radius: histograms first, then whole sets."""
        pairs = self._kept(pairs.distinct(), f"{name}-pairs")
        left = classes.select(F.col("c").alias("a"), F.col("n").alias("an"), F.col("histogram").alias("ah"))
        right = classes.select(F.col("c").alias("b"), F.col("n").alias("bn"), F.col("histogram").alias("bh"))
        s = self.similarity

        def near(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                a, b, an, bn, ah, bh = (batch.column(i) for i in range(6))
                x, y = (np.frombuffer(b"".join(h.to_pylist()), ">i2").reshape(-1, BUCKETS).astype(np.int64) for h in (ah, bh))
                total = an.to_numpy() + bn.to_numpy()
                # |x ^ y| <= (1 - s) / (1 + s) * (|x| + |y|); full buckets can only hide a difference
                limit = total * (s.denominator - s.numerator) // (s.denominator + s.numerator)
                close = pa.array(np.abs(x - y).sum(1) <= limit)
                yield pa.RecordBatch.from_arrays([a.filter(close), b.filter(close)], names=["a", "b"])

        close = pairs.join(left, "a").join(right, "b").filter(_close(F.col("an"), F.col("bn"), s)).select("a", "b", "an", "bn", "ah", "bh").mapInArrow(near, "a binary, b binary")
        close = self._kept(close, f"{name}-close")
        wanted = close.select(F.col("a").alias("w")).unionByName(close.select(F.col("b").alias("w"))).distinct()
        sets = self._kept(self._full(wanted), f"{name}-sets")

        def linked(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x, y = np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(shared * s.denominator >= (len(x) + len(y) - shared) * s.numerator)
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

        both = close.join(sets.select(F.col("c").alias("a"), F.col("found").alias("af")), "a").join(sets.select(F.col("c").alias("b"), F.col("found").alias("bf")), "b")
        return self._kept(both.select("a", "b", "af", "bf").mapInArrow(linked, "a binary, b binary"), f"{name}-links")

    def _full(self, wanted: DataFrame) -> DataFrame:
        """``c, found``: the whole sets of some classes, made again from the text of one member each."""
        words = self.words

        def whole(batches):
            for batch in batches:
                found = [shingles(x.as_py(), words) for x in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([_signature(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], names=["c", "found"])

        some = self._kept(self.first.join(wanted, F.col("c") == F.col("w"), "left_semi").select("id", "key"), "wanted")
        return self._texts_of(some).select("text").mapInArrow(whole, "c binary, found binary").dropDuplicates(["c"])

    def links(self) -> DataFrame:
        """``a, b``: links between classes, enough for all connections (not every pair within a connected group)."""
        self.members, classes = self.classes()
        met = self._kept(self._entries(classes).groupBy("pivot").agg(F.count("*").alias("m")).filter("m > 1").select("pivot"), "met")
        entries = self._kept(self._entries(classes).join(self._sent(met), "pivot", "left_semi"), "entries")

        # the centre of a region is the member with the fewest pivots before it, which has the fewest shingles of its own
        centre = entries.groupBy("pivot").agg(F.min(F.struct("at", "c", "n")).alias("p")).select("pivot", F.col("p.c").alias("b"), F.col("p.n").alias("bn"), F.col("p.at").alias("bat"))
        met_centre = entries.join(self._kept(centre, "centres"), "pivot").filter((F.col("c") != F.col("b")) & _close(F.col("n"), F.col("bn"), self.similarity))
        stars = met_centre.filter(self._possible(F.col("at"), F.col("bat"), F.col("n"), F.col("bn")))
        star_links = self._verified(stars.select(F.least("c", "b").alias("a"), F.greatest("c", "b").alias("b")), classes, "star")

        known = self._known(entries, star_links)
        home_links = self._home_links(known, classes)
        if home_links is not None:
            star_links = star_links.unionByName(home_links)
            known = self._known(entries, star_links)
        regions = self._open(known)
        rest = self._verified(self._pairs(regions.filter(F.col("left") <= PAIRS)), classes, "rest")
        crossed = self._blocks(regions.filter(F.col("left") > PAIRS), classes, "crossed")
        return self._kept(star_links.unionByName(rest).unionByName(crossed).distinct(), "links")

    def _known(self, entries: DataFrame, links: DataFrame) -> DataFrame:
        """The entries with the part that the links so far connect each set with."""
        parts = self._kept(components(links), "parts").withColumnRenamed("node", "pc")
        known = entries.join(parts, F.col("c") == F.col("pc"), "left").select("pivot", "at", "c", "n", F.coalesce("component", "c").alias("part"))
        return self._kept(known, "known")

    def _home_links(self, known: DataFrame, classes: DataFrame) -> DataFrame | None:
        """Links within the blocks of large home regions, where each set is in one region and one block only; None if no region is large."""
        home = known.groupBy("c").agg(F.min(F.struct("at", "pivot", "n", "part")).alias("h")).select("h.pivot", "h.at", "c", "h.n", "h.part")
        large = self._open(self._kept(home, "homes")).filter(F.col("left") > PAIRS)
        return None if large.isEmpty() else self._blocks(large, classes, "home", across=False)

    def _open(self, known: DataFrame) -> DataFrame:
        """The members of regions that more than one connected part meets in, with the pairs left to compare and the shingles there."""
        sizes = known.groupBy("pivot", "part").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
        regions = sizes.groupBy("pivot").agg(F.count("*").alias("parts"), F.sum("m").alias("members"), F.sum("s").alias("shingles"), F.max(F.struct("m", "part")).alias("main")).filter("parts > 1")
        regions = self._kept(regions.select("pivot", "members", "shingles", (F.col("members") * (F.col("members") - F.col("main.m"))).alias("left"), F.col("main.part").alias("main")), "regions")
        return self._kept(known.join(regions, "pivot").select("pivot", "at", "c", "n", "part", "members", "shingles", "left", (F.col("part") != F.col("main")).alias("minor")), "open")

    def _blocks(self, regions: DataFrame, classes: DataFrame, name: str, across: bool = True) -> DataFrame:
        """Links of large regions, cut into blocks of bounded size: within each, and ``across`` every two of them.

        A first task per pair of blocks finds by bounds which members can have a partner there; only their sets are
        sent to a second one, which compares them.
        """
        blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / SHINGLES)).cast("int")
        large = regions.join(classes.select(F.col("c").alias("wc"), "win", "histogram"), F.col("c") == F.col("wc"))
        own = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
        placed = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if across else F.col("block"))
        met = placed.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c", "n", "part", "minor", F.slice("win", F.lit(1), F.col("at")).alias("earlier"), "histogram")
        possible = met.groupBy("pivot", "i", "j").applyInArrow(_block_candidates(self.similarity), "pivot long, i int, j int, block int, c binary, part binary, minor boolean, group long")
        possible = self._kept(possible, f"{name}-possible").withColumnRenamed("c", "mc")
        sets = self._kept(self._full(possible.select(F.col("mc").alias("w")).distinct()), f"{name}-sets")
        whole = possible.join(sets, F.col("mc") == F.col("c")).select("pivot", "i", "j", "group", "block", "c", "part", "minor", "found")
        return self._kept(whole.groupBy("pivot", "i", "j", "group").applyInArrow(_block_links(self.similarity), "a binary, b binary"), f"{name}-links")

    def _pairs(self, regions: DataFrame) -> DataFrame:
        """Members outside the main part against all others of their region that are not connected with them yet."""
        s = self.similarity
        x = regions.filter("minor").select("pivot", F.col("c").alias("x"), F.col("n").alias("xn"), F.col("at").alias("xat"), F.col("part").alias("xpart"))
        y = regions.select("pivot", F.col("c").alias("y"), F.col("n").alias("yn"), F.col("at").alias("yat"), F.col("part").alias("ypart"), "minor")
        enough = self._possible(F.col("xat"), F.col("yat"), F.col("xn"), F.col("yn"))
        once = ~F.col("minor") | (F.col("x") < F.col("y"))
        met = x.join(y, "pivot").filter((F.col("xpart") != F.col("ypart")) & once & _close(F.col("xn"), F.col("yn"), s) & enough)
        return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def groups(self) -> DataFrame:
        """``id, key, n, component``: per row its set's size and the smallest id it is connected with (its own, if it has no words)."""
        links = self.links()
        joined = self._kept(components(links), "class-groups")
        classes = self.members.filter("n > 0").groupBy("c").agg(F.min("id").alias("least"))
        named = classes.join(joined, F.col("c") == F.col("node"), "left").select("c", "least", F.coalesce("component", "c").alias("group"))
        named = self._kept(named, "named")
        smallest = self._kept(named.groupBy("group").agg(F.min("least").alias("component")), "smallest").withColumnRenamed("group", "g")
        answers = self._kept(named.join(smallest, F.col("group") == F.col("g")).select(F.col("c").alias("ac"), "component"), "answers")
        return self.members.join(answers, F.col("c") == F.col("ac"), "left").select("id", "key", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def near_duplicates(documents: DataFrame, words: int = 5, similarity: Fraction = Fraction(4, 5), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, n, component`` for every row of ``documents``; ``key`` is a hash of the text."""
    return JaccardJoin(documents, words, similarity, doc, text).groups()


def keep_one(documents: DataFrame, words: int = 5, similarity: Fraction = Fraction(4, 5), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each group: the one with the group's smallest id. Documents without words or id all stay.

    Rows that repeat the smallest id with the same text are one document and stay together.
    """
    found = near_duplicates(documents, words, similarity, doc, text)
    gone = found.filter((F.col("n") > 0) & (F.col("id") != F.col("component"))).select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct()
    return documents.join(gone, (documents[doc] == F.col("__id")) & (text_key(documents[text]) == F.col("__key")), "left_anti")
