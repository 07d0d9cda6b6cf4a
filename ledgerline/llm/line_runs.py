"""Line dedup against levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased; its hash has 128
bits. Runs are written tables below the shared folder, sorted by hash within hash partitions, of two
kinds: *frequent* runs hold the hashes found in ``min_docs`` documents or more, each once; *counting* runs hold
``hash, docs`` of the others. Each new batch is merge-anti-joined with the frequent runs; what remains is merged with
the counting runs, and hashes that reach ``min_docs`` by that start a new frequent run, the rest a new counting run.
When a level has ``fanout`` runs they are merged into one run of the next level, so ``n`` batches leave
about ``fanout * log(n)`` runs; counts of hashes that have become frequent go then.

The frequent runs are the result. That the anti-join lets no frequent hash through is checked when they
are read: a hash that comes twice fails the job.

Defined cases: a null or empty text is one empty line; empty keys are never counted or dropped;
every row counts as a document, also rows repeated with the same id, which get the same answer;
an empty batch adds an empty run; other columns pass through whatever their names are.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.scan import small_batches
from ledgerline.session import shared_dir

SPACE = b" \t\n\x0b\x0c\r"
#: Hashes (16 bytes each) and documents that are broadcast; more are shuffled.
BROADCAST_HASHES = 1_000_000


def line_hash(line: bytes) -> bytes | None:
    """128 bits of a line's key; None for an empty key."""
    key = line.strip(SPACE).lower()
    return hashlib.blake2b(key, digest_size=16).digest() if key else None


def _sliced(batches, rows: int = 1_000):
    """What is made of a batch is held for so many of its rows at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _hashed(batches):
    for batch in _sliced(batches):
        ids, parts, hashes = batch.column(0), batch.column(1), []
        for text in batch.column(2):
            found = {line_hash(x) for x in (text.as_py() or b"").split(b"\n")}
            hashes.append([x for x in found if x])
        yield pa.RecordBatch.from_arrays([ids, parts, pa.array(hashes, pa.list_(pa.binary()))], ["id", "batch", "hashes"])


def document_lines(documents: DataFrame, batches: int = 1, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, batch, hashes``: the distinct line hashes of every row. Rows are dealt to batches by a hash of the text."""
    kind = documents.schema[doc].dataType.simpleString()
    source = documents.select(F.col(doc).alias("id"), F.pmod(F.xxhash64(F.col(doc), F.col(text)), F.lit(batches)).cast("int").alias("batch"), F.col(text).cast("binary").alias("text"))
    return source.mapInArrow(_hashed, f"id {kind}, batch int, hashes array<binary>")


class LineRuns:
    """The runs of all batches so far, below one folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None, min_docs: int = 10, fanout: int = 3):
        self.spark, self.min_docs, self.fanout, self.written = spark, min_docs, fanout, 0
        self.folder = folder or shared_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.frequent_levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        path, self.written = f"{self.folder}/run-{self.written}", self.written + 1
        run.sortWithinPartitions("hash").write.parquet(path)
        return path

    def _read(self, levels: list[list[str]], schema: str) -> DataFrame:
        paths = [p for level in levels for p in level]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def counts(self) -> DataFrame:
        """``hash, docs`` of the counting runs; a hash may come once per run."""
        return self._read(self.levels, "hash binary, docs long")

    def _frequent(self) -> DataFrame:
        return self._read(self.frequent_levels, "hash binary")

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The rows of a batch whose ``hash`` is in no frequent run (merge-anti-join)."""
        known = self._frequent().withColumnRenamed("hash", "known")
        return hashes.join(known.hint("merge"), F.col("hash") == F.col("known"), "left_anti") if self.frequent_levels else hashes

    def add(self, lines: DataFrame) -> None:
        """Takes in one batch and compacts every level that is full."""
        batch = lines.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("docs"))
        rest = self.unseen(batch)
        if self.levels:
            earlier = self.counts().groupBy(F.col("hash").alias("known")).agg(F.sum("docs").alias("earlier"))
            rest = rest.join(earlier.hint("merge"), F.col("hash") == F.col("known"), "left")
        else:
            rest = rest.withColumn("earlier", F.lit(0))
        staged = f"{self.folder}/batch-{self.written}"
        rest.select("hash", "docs", (F.col("docs") + F.coalesce("earlier", F.lit(0))).alias("total")).write.parquet(staged)
        staged = self.spark.read.parquet(staged)
        self._place(self.frequent_levels, 0, self._write(staged.filter(F.col("total") >= self.min_docs).select("hash")), self._merged_frequent)
        self._place(self.levels, 0, self._write(staged.filter(F.col("total") < self.min_docs).select("hash", "docs")), self._merged_counts)

    def _merged_counts(self, paths: list[str]) -> DataFrame:
        return self.unseen(self._read([paths], "hash binary, docs long").groupBy("hash").agg(F.sum("docs").alias("docs")))

    def _merged_frequent(self, paths: list[str]) -> DataFrame:
        return self._read([paths], "hash binary").repartition("hash")

    def _place(self, levels: list[list[str]], level: int, path: str, merged) -> None:
        if level == len(levels):
            levels.append([])
        levels[level].append(path)
        if len(levels[level]) >= self.fanout:
            one = self._write(merged(levels[level]))
            levels[level] = []
            self._place(levels, level + 1, one, merged)

    def frequent(self) -> DataFrame:
        """The hashes found in at least ``min_docs`` documents of all batches, each once."""
        found = self._frequent()
        if not found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            raise RuntimeError("a frequent line came through the anti-join")
        return found


def _purged(batches):
    for batch in _sliced(batches):
        texts, lines, dropped = [], [], []
        for text, gone in zip(batch.column(1), batch.column(2)):
            text = text.as_py()
            own, gone = (text or b"").split(b"\n"), set(gone.as_py() or ())
            kept = [x for x in own if line_hash(x) not in gone] if gone else own
            texts.append(None if text is None else b"\n".join(kept).decode())
            lines.append(len(own))
            dropped.append(len(own) - len(kept))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["row", "kept", "n_lines", "n_dropped"])


def purge(documents: DataFrame, lines: DataFrame, frequent: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the document), ``kept`` (its text without the frequent lines; null stays null), ``n_lines`` and ``n_dropped``.

    Only the hashes of lines to drop travel to the documents, broadcast if they are counted to be at most
    ``BROADCAST_HASHES``; beyond that the texts are shuffled once. A line that many documents share is
    a skewed join key on plain scans, which adaptive execution splits.
    """
    spark, folder = documents.sparkSession, shared_dir(documents.sparkSession, "line-drops")
    lines.select("id", F.explode("hashes").alias("hash")).join(frequent, "hash", "left_semi").groupBy("id").agg(F.collect_set("hash").alias("gone")).write.parquet(folder)
    gone = spark.read.schema(f"id {documents.schema[doc].dataType.simpleString()}, gone array<binary>").parquet(folder)
    small = (gone.agg(F.sum(F.size("gone") + 1)).first()[0] or 0) <= BROADCAST_HASHES
    source = documents.select(F.col(doc).alias("__id"), F.struct(*[documents[c] for c in documents.columns if c != text]).alias("row"), F.col(text).cast("binary").alias("text"))
    joined = source.join(F.broadcast(gone) if small else gone, F.col("__id").eqNullSafe(F.col("id")), "left").select("row", "text", "gone")
    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_purged, f"row {row}, kept string, n_lines long, n_dropped long")


def dedup_lines(documents: DataFrame, min_docs: int = 10, batches: int = 6, fanout: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All batches go through the runs first; then every document loses the lines that are frequent over all of them."""
    spark = documents.sparkSession
    runs = LineRuns(spark, min_docs=min_docs, fanout=fanout)
    staged = f"{runs.folder}/lines"
    with small_batches(spark):
        document_lines(documents, batches, doc, text).write.partitionBy("batch").parquet(staged)
    lines = spark.read.schema(f"id {documents.schema[doc].dataType.simpleString()}, hashes array<binary>, batch int").parquet(staged)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch))
    return purge(documents, lines, runs.frequent(), doc, text)


def without_frequent_lines(documents: DataFrame, min_docs: int = 10, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their columns, the text without frequent lines. A null text stays null."""
    purged = dedup_lines(documents, min_docs, doc=doc, text=text)
    return purged.select(*[F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in documents.columns])
