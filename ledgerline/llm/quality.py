"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its whole text. Random Fourier features of the
standardised statistics approximate a Gaussian kernel; every partition of labelled rows sums its
part of the normal equations, the sums are added up by Spark, and one small system is solved. On
a part of the labelled rows kept back from this, the raw scores are grouped into bins and made
monotone (pool adjacent violators), which turns a raw score into the share of good documents.

Defined cases: a null text counts as an empty one and gets a score like any other; a null label is
no label; rows repeated with one id are scored each by its own text, and a label goes to all of
them; without labelled rows every score is 0.5; extra columns are not used.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scan import small_batches
from ledgerline.llm.text import text_key
from ledgerline.session import shared_dir

#: Dimensions of the feature map, kernel width in standard deviations, ridge penalty per row, bins of the calibration.
FEATURES = 192
WIDTH = 4.0
PENALTY = 1e-4
BINS = 200
SEED = 11
THRESHOLD = 0.3
#: Rows that are mapped at once, and ids that are broadcast; more are joined by a shuffle.
AT_ONCE = 1_000
BROADCAST_ROWS = 1_000_000

STATISTICS = [
    "log_chars", "log_words", "log_lines", "word_length", "long_words", "distinct_words", "top_word", "repeated_pairs", "adjacent_repeats",
    "distinct_lines", "letters", "upper", "digits", "spaces", "newlines", "punctuation", "symbols", "exclamations", "pipes", "beyond_ascii",
    "capital_words", "shouted_words", "marked_words", "stop_marks", "line_words", "worst_run",
]

_LOWER, _UPPER, _DIGIT = np.arange(97, 123), np.arange(65, 91), np.arange(48, 58)
_PUNCTUATION = np.frombuffer(b".,;:'\"()-", np.uint8)
_SYMBOLS = np.frombuffer(b"#$%&*@^~<>{}[]\\/_=+`", np.uint8)
_MARKS = b"#$%&*!|"


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters, upper = int(counts[_LOWER].sum() + counts[_UPPER].sum()), int(counts[_UPPER].sum())
    beyond = int(counts[128:].sum())
    words, lines = text.split(), text.split(b"\n")
    m = max(1, len(words))
    seen: dict[bytes, int] = {}
    run = worst = repeats = marked = shouted = capital = long = 0
    last = b""
    for w in words:
        seen[w] = seen.get(w, 0) + 1
        if w == last:
            repeats += 1
            run += 1
            worst = max(worst, run)
        else:
            run = 0
        last = w
        marked += w[-1] in _MARKS
        shouted += w.isupper() and len(w) > 1
        capital += w[:1].isupper()
        long += len(w) > 12
    pairs = len(set(zip(words, words[1:])))
    full = [x for x in lines if x.strip()]
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, seen)) / max(1, len(seen)), long / m, len(seen) / m, max(seen.values(), default=0) / m,
        1 - pairs / max(1, len(words) - 1), repeats / m, len(set(full)) / max(1, len(full)), letters / n, upper / max(1, letters), counts[_DIGIT].sum() / n, counts[32] / n, counts[10] / n,
        counts[_PUNCTUATION].sum() / n, counts[_SYMBOLS].sum() / n, counts[33] / m, counts[124] / m, beyond / n,
        capital / m, shouted / m, marked / m, (counts[46] + counts[63]) / m, np.log1p(len(words) / max(1, len(full))), np.log1p(worst),
    ]


def _described(batches):
    for batch in batches:
        found = np.array([statistics(x.as_py() or b"") for x in batch.column(1)], np.float64).reshape(-1, len(STATISTICS))
        values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["row", "x"])


def describe(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``row`` (a struct of the columns to keep) and ``x``, the statistics."""
    source = documents.select(F.struct(*[documents[c] for c in keep]).alias("row"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(_described, f"row {source.schema['row'].dataType.simpleString()}, x array<double>")


class Map:
    """Standardise, then cosines of fixed random directions."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(scale > 1e-9, scale, 1.0)
        self.directions = rng.normal(size=(len(mean), features)) / width
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([np.ones((len(x), 1)), z, waves])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sliced(batches):
    """Not empty, and no larger than what is mapped at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(first, AT_ONCE)


def _summed(mapped: Map):
    """One partition's part of the normal equations: rows of the Gram matrix, the right side as their last entry."""

    def sums(batches):
        total = None
        for batch in _sliced(batches):
            z = mapped(_matrix(batch.column(0)))
            part = z.T @ np.hstack([z, batch.column(1).to_numpy(zero_copy_only=False).reshape(-1, 1)])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    return sums


def _scored(mapped: Map, weights: np.ndarray):
    def score(batches):
        for batch in _sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mapped(_matrix(batch.column(1))) @ weights)], names=["row", "raw"])

    return score


def _described_and_scored(mapped: Map, weights: np.ndarray, text: str, at_once: int = AT_ONCE):
    """Scores whole documents that carry their text themselves, a slice of a batch at a time, so that texts are held once."""

    def score(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                rows = batch.column(0).slice(first, at_once)
                found = np.array([statistics((x.as_py() or "").encode()) for x in rows.field(text)], np.float64)
                yield pa.RecordBatch.from_arrays([rows, pa.array(mapped(found) @ weights)], names=["row", "raw"])

    return score


def isotonic(good: list[float], count: list[float]) -> list[float]:
    """The monotone shares nearest to ``good / count``, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for g, n in zip(good, count):
        pools.append([g, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + n2, pools[-1][2] + k2]
    return [g / n for g, n, k in pools for _ in range(int(k))]


def bucket(id: Column) -> Column:
    """crc32 of the id as text modulo 5: rows with 0 are held out, rows with 1 calibrate, the others train."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(5))


def fit(described: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "quality"):
    """``(map, weights, edges, shares)`` learnt from the labelled rows outside the held-out fifth, or None without any.

    ``described`` should be a written table. Only sums and bins of fixed size come to the driver.
    """
    known = labels.select(F.col(doc).alias("id"), F.col(label).cast("double").alias("y")).filter(F.col("y").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.avg("y").alias("y"))
    rows = described.select(F.col(f"row.{doc}").alias("id"), "x").filter(bucket(F.col("id")) != 0).join(known, "id").withColumn("part", bucket(F.col("id")))
    folder = shared_dir(labels.sparkSession, "quality-rows")
    rows.write.parquet(folder)
    rows = labels.sparkSession.read.schema(rows.schema).parquet(folder)
    train, calibrate = rows.filter("part > 1"), rows.filter("part = 1")
    aggregates = [f(F.get("x", F.lit(i))) for i in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop)]
    n, *moments = train.agg(F.count("*"), *aggregates).first()
    if not n:
        return None
    mapped = Map(np.array(moments[0::2], float), np.array(moments[1::2], float))
    parts = train.select("x", "y").mapInArrow(_summed(mapped), "i int, sums array<double>")
    added = parts.select("i", F.posexplode("sums").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s")).groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "s"))), lambda e: e["s"]).alias("sums")).collect()  # the system's own size
    system = np.array([r.sums for r in sorted(added, key=lambda r: r.i)])
    gram, right = system[:, :-1], system[:, -1]
    weights = np.linalg.solve(gram + PENALTY * n * np.eye(len(gram)), right)
    raw = calibrate.select(F.col("y").alias("row"), "x").mapInArrow(_scored(mapped, weights), "row double, raw double")
    bins = raw.groupBy(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("raw") + 0.5) * (BINS / 2)))).cast("int").alias("bin")).agg(F.sum("row").alias("good"), F.count("*").alias("n")).orderBy("bin").collect()  # at most BINS rows
    if not bins:
        return mapped, weights, [0.0, 1.0], [0.0, 1.0]
    shares = isotonic([r.good for r in bins], [r.n for r in bins])
    return mapped, weights, [(r.bin + 0.5) / (BINS / 2) - 0.5 for r in bins], shares


def _calibrated(raw: Column, edges: list[float], shares: list[float]) -> Column:
    """Straight lines between the bins' centres."""
    result = F.lit(float(shares[-1]))
    for k in range(len(edges) - 1, 0, -1):
        if shares[k] == shares[k - 1] and k < len(edges) - 1 and shares[k + 1] == shares[k]:
            continue
        slope = (shares[k] - shares[k - 1]) / (edges[k] - edges[k - 1])
        result = F.when(raw < edges[k], F.lit(float(shares[k - 1])) + (raw - edges[k - 1]) * slope).otherwise(result)
    return F.when(raw <= edges[0], F.lit(float(shares[0]))).otherwise(result)


def scores(documents: DataFrame, labels: DataFrame, keep: list[str] | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the kept columns, the id among them) and ``score``, from 0 to 1."""
    spark = documents.sparkSession
    folder = shared_dir(spark, "quality")
    keep = keep or [doc]
    described = describe(documents, [doc] if text in keep else keep, text)
    with small_batches(spark):
        described.write.parquet(f"{folder}/statistics")
    written = spark.read.schema(described.schema).parquet(f"{folder}/statistics")
    model = fit(written, labels, doc)
    # texts are not written with the statistics; where they are wanted, the statistics are made once more
    rows = documents.select(F.struct(*[documents[c] for c in keep]).alias("row")) if text in keep else written
    if model is None:
        return rows.select("row", F.lit(0.5).alias("score"))
    mapped, weights, edges, shares = model
    scored = _described_and_scored(mapped, weights, text) if text in keep else _scored(mapped, weights)
    raw = rows.mapInArrow(scored, f"row {rows.schema['row'].dataType.simpleString()}, raw double")
    table = F.lit(0.0) + _calibrated(F.col("raw"), edges, shares)
    return raw.select("row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), table)).alias("score"))


def without_low(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold.

    Texts are described once and go to Python without the other columns; only the ids and text hashes of rows to
    drop travel to the documents, broadcast if counted to be at most ``BROADCAST_ROWS``, else both sides are shuffled.
    """
    spark, folder = documents.sparkSession, shared_dir(documents.sparkSession, "quality-low")
    keyed = documents.select(documents[doc].alias("id"), text_key(documents[text]).alias("key"), documents[text].alias("text"))
    scored = scores(keyed, labels.select(F.col(doc).alias("id"), "quality"), keep=["id", "key"], doc="id", text="text")
    low = scored.filter(~F.coalesce(F.col("score") >= threshold, F.lit(False))).select(F.col("row.id").alias("__id"), F.col("row.key").alias("__key")).distinct()
    low.write.parquet(folder)
    low = spark.read.schema(low.schema).parquet(folder)
    sent = F.broadcast(low) if low.count() <= BROADCAST_ROWS else low
    return documents.join(sent, documents[doc].eqNullSafe(low["__id"]) & (text_key(documents[text]) == low["__key"]), "left_anti")
