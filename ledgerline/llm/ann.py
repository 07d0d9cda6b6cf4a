"""Approximate nearest neighbours: an inverted multi-index.

Vectors are scaled to length one and cut in two halves; each half has its own centroids, and a
vector belongs to the cell of its pair of nearest centroids. A query visits cells by the sum of its
halves' distances to the two centroids, taken from a heap, until the cells hold enough vectors, and
all vectors of these cells are ranked by the exact cosine of the vectors as given. How many are
enough is measured: ``PROBES`` vectors are compared with every entry, and the traversal has to
reach the cells of ``REACHED`` of their true neighbours. Clustered vectors need few; vectors without
any structure need a large share of all.

Equal vectors are one entry with its smallest ids, as many as a result can hold, so thousands of
copies neither fill a cell nor leave anything out; equal queries are searched once. Cells are cut
into blocks of bounded size, and so are the queries that visit one, before they meet.

The centroids are fitted on a bounded sample, ``SAMPLE`` vectors chosen by a hash; every vector is
indexed. Centroids grow with the square root of the number of vectors, up to ``CENTROIDS`` a half.

Defined cases: vectors that are null, empty or zero, that hold nulls or non-finite numbers, or are of
another length than most take no part, neither as queries nor as candidates; a null id takes no part;
rows repeated with the same id and vector count once; ties go to the smaller id; with fewer
candidates than asked for, all are returned; an empty table gives no rows. Other columns are ignored.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import shared_dir

SAMPLE = 20_000
#: Centroids of a half at most. Up to 13 million vectors a cell holds about CELL of them; with more, cells and the
#: vectors a query visits grow in proportion, unless ``most_centroids`` (and the sample) are raised with them.
CENTROIDS = 256
ROUNDS = 12
CELL = 200  # vectors in a cell, on average
PROBES = 100
REACHED = 0.97
#: Rows in a block of entries; a block of queries is eight times as large.
BLOCK = 2_048


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _rows(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float).reshape(len(vectors), -1)


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0, (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)[None])


def fit_half(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Lloyd's iterations from a random choice of points; empty centroids keep their place."""
    rng = np.random.default_rng(seed)
    centroids = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(points, centroids).argmin(1)
        for c in np.unique(nearest):
            centroids[c] = points[nearest == c].mean(0)
    return centroids


def cells_in_order(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells by rising sum of the two distances until they hold ``enough`` vectors; empty ones are passed over."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    found, held, k = [], 0, len(b)
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * k + int(b[j])
        if sizes[cell]:
            found.append(cell)
            held += int(sizes[cell])
        if j + 1 < k:
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return found


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, v``: the rows that take part, vectors in double precision."""
    v = F.col(vector).cast("array<double>")
    found = vectors.select(F.col(id).alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    return found.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


class MultiIndex:
    """Centroids of both halves and the entries of every cell, in written tables."""

    def __init__(self, vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k_nearest: int = 5, sample: int = SAMPLE, most_centroids: int = CENTROIDS):
        spark = vectors.sparkSession
        self.spark, self.folder, self.k = spark, shared_dir(spark, "multi-index"), k_nearest
        rows = usable(vectors, id, vector)
        lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.empty = lengths is None
        if self.empty:
            return
        self.dimensions = lengths.d
        self._classes(rows).write.parquet(f"{self.folder}/classes")
        self.classes = spark.read.parquet(f"{self.folder}/classes")
        n = self.classes.count()
        bound = int(min(1.0, 2 * sample / n) * 2**31)
        chosen = self.classes.filter(F.pmod(F.xxhash64("v"), F.lit(2**31)) <= bound).select("v").orderBy(F.xxhash64("v")).limit(sample)
        points = _unit(_rows(chosen.toPandas()["v"]))
        self.half = max(1, self.dimensions // 2)
        centroids = max(1, min(most_centroids, int(np.sqrt(n / CELL)) + 1, len(points)))
        self.first = fit_half(points[:, : self.half], centroids)
        self.second = fit_half(points[:, self.half :], centroids) if self.dimensions > 1 else np.zeros((1, 0))
        self._place().write.parquet(f"{self.folder}/entries")
        self.entries = spark.read.parquet(f"{self.folder}/entries")
        self.sizes = np.zeros(len(self.first) * len(self.second), np.int64)
        for row in self.entries.groupBy("cell").count().collect():  # at most CENTROIDS squared rows
            self.sizes[row["cell"]] = row["count"]
        self.enough = self._enough()

    def _classes(self, rows: DataFrame) -> DataFrame:
        """``v, ids``: distinct vectors with their smallest ids, one more than a result holds, as a query leaves itself out."""
        same = rows.filter(F.size("v") == self.dimensions).distinct()
        ranked = same.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("nth") <= self.k + 1)
        return ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    def _enough(self, probes: int = PROBES, reached: float = REACHED) -> int:
        """Vectors that the visited cells have to hold, so that the traversals of the probes reach their true neighbours."""
        asked = _rows(self.classes.select("v").orderBy(F.xxhash64(F.lit(3), F.col("v"))).limit(probes).toPandas()["v"])
        k = self.k

        def near(frames):
            for frame in frames:
                if not len(frame):
                    continue
                entries = _rows(frame["v"])
                cosine = cosines(asked, entries)
                for p, point in enumerate(asked):
                    cosine[p, (entries == point).all(1)] = -2
                best = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
                p = np.repeat(np.arange(len(asked)), best.shape[1])
                yield pd.DataFrame({"p": p.astype("int32"), "score": cosine[p, best.ravel()], "cell": frame["cell"].to_numpy()[best.ravel()]})

        found = self.entries.select("v", "cell").mapInPandas(near, "p int, score double, cell int").filter("score > -2")
        nearest = found.withColumn("nth", F.row_number().over(Window.partitionBy("p").orderBy(F.desc("score"), "cell"))).filter(F.col("nth") <= k).select("p", "cell").collect()  # probes times k rows
        units, needed = _unit(asked), []
        order = {}
        for row in nearest:
            if row.p not in order:
                point = units[row.p][None]
                cells = cells_in_order(_distances(point[:, : self.half], self.first)[0], _distances(point[:, self.half :], self.second)[0], self.sizes, int(self.sizes.sum()))
                held = np.cumsum(self.sizes[cells])
                order[row.p] = {c: int(held[i] - self.sizes[c]) for i, c in enumerate(cells)}
            needed.append(order[row.p][row.cell] + 1)
        return int(np.quantile(needed, reached, method="higher")) if needed else 1

    def _place(self) -> DataFrame:
        first, second, half = self.first, self.second, self.half

        def placed(frames):
            for frame in frames:
                units = _unit(_rows(frame["v"]))
                a = _distances(units[:, :half], first).argmin(1)
                b = _distances(units[:, half:], second).argmin(1)
                yield frame.assign(cell=(a * len(second) + b).astype("int32"))

        kind = self.classes.schema["ids"].dataType.simpleString()
        return self.classes.mapInPandas(placed, f"v array<double>, ids {kind}, cell int")

    def search(self, queries: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """``query_id, rank, vec_id, score``: the nearest entries of every query, the query's own id left out."""
        if self.empty:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        k, spark = self.k, self.spark
        kind = self.classes.schema["ids"].dataType.elementType.simpleString()
        asked = usable(queries, id, vector).filter(F.size("v") == self.dimensions).distinct()
        # equal queries go through the cells once, under the hash of their vector
        asked.withColumn("q", F.md5(F.to_json(F.col("v")))).write.parquet(f"{self.folder}/queries")
        asked = spark.read.parquet(f"{self.folder}/queries")
        distinct = asked.groupBy("q").agg(F.first("v").alias("v"))
        first, second, half, sizes, enough, block = self.first, self.second, self.half, self.sizes, self.enough, BLOCK

        def visits(frames):
            for frame in frames:
                if not len(frame):
                    continue
                units = _unit(_rows(frame["v"]))
                a, b = _distances(units[:, :half], first), _distances(units[:, half:], second)
                for n, (q, v) in enumerate(zip(frame["q"], frame["v"])):
                    cells = cells_in_order(a[n], b[n], sizes, enough)
                    yield pd.DataFrame({"q": q, "v": [v] * len(cells), "cell": np.array(cells, "int32")})

        spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
        visited = distinct.repartition(spread, "q").mapInPandas(visits, "q string, v array<double>, cell int")
        # a block of entries meets a block of queries; each side is copied to the other's blocks of the cell
        sizes_table = self.entries.groupBy(F.col("cell").alias("c")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
        large = F.coalesce("blocks", F.lit(1))

        def with_blocks(rows: DataFrame) -> DataFrame:
            return rows.join(F.broadcast(sizes_table), F.col("cell") == F.col("c"), "left")  # at most CENTROIDS squared rows

        query_blocks = max(1, -(-asked.count() // (8 * block)))
        entries = with_blocks(self.entries).withColumn("eb", F.pmod(F.xxhash64("v"), large).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).select("cell", "eb", "qb", "v", "ids")
        seekers = with_blocks(visited).withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).cast("int")).withColumn("eb", F.explode(F.sequence(F.lit(0), large - 1))).select("cell", "eb", "qb", "q", "v")

        def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"q": pd.Series([], dtype=str), "found": []})
            e, s = _rows(left["v"]), _rows(right["v"])
            cosine = cosines(s, e)
            rows = []
            for n, q in enumerate(right["q"]):
                line = cosine[n]
                some = np.flatnonzero(line >= np.partition(line, -(k + 1))[-(k + 1)]) if len(line) > k + 1 else np.arange(len(line))
                best = sorted((-line[i], x) for i in some for x in left["ids"].iloc[i].tolist())[: k + 1]
                rows.append((q, [{"score": -x, "id": i} for x, i in best]))
            return pd.DataFrame(rows, columns=["q", "found"])

        keys = ["cell", "eb", "qb"]
        parts = entries.groupBy(*keys).cogroup(seekers.groupBy(*keys)).applyInPandas(nearest, f"q string, found array<struct<score:double,id:{kind}>>")
        merged = parts.groupBy("q").agg(F.slice(F.array_sort(F.transform(F.flatten(F.collect_list("found")), lambda f: F.struct((-f["score"]).alias("s"), f["id"].alias("id")))), 1, k + 1).alias("found"))
        merged.write.parquet(f"{self.folder}/found")
        answers = asked.select("q", F.col("id").alias("query_id")).join(spark.read.parquet(f"{self.folder}/found"), "q")
        others = answers.withColumn("found", F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k))
        return others.select("query_id", F.posexplode("found").alias("nth", "f")).select("query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), (-F.col("f.s")).alias("score"))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of ``a`` with all of ``b``, in double precision.

    Products are added in one order whatever the blocks are, so equal pairs have equal scores.
    """
    products = np.einsum("id,jd->ij", a, b, optimize=False)
    return products / (np.sqrt(np.einsum("id,id->i", a, a))[:, None] * np.sqrt(np.einsum("jd,jd->j", b, b))[None])
