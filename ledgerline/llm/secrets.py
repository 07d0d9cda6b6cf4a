"""Secret scans: patterns, and two character Markov models compared by log-likelihood ratio.

Fixed patterns give the base spans. Beside them, every long unbroken token is scored by a model of
random strings against a model of ordinary identifiers; both hold transition probabilities
between characters, counted from labelled tokens and smoothed by one. With no random strings to
learn from, the first model is therefore uniform. The threshold is set where one ordinary token in
a thousand would pass. Models and threshold come from every document, copies of a text once.

Defined cases: a null or empty text has no spans; rows repeated with one id and text each get the
same spans; tokens that overlap a base span are not proposed again; other columns are not used.
"""

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import match_spans, null_safe, span_text, text_key
from ledgerline.session import shared_dir

#: Fixed by the query's contract. The runs of ``hex`` and ``access`` are asked for in full length
#: at once: a shorter run cannot hold a longer match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"[0-9a-f]{32,}+",
}
ORDER = ["assign", "access", "hex", "markov"]
LEAST_VALUE = 8

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
#: Words and names joined by underscores; tokens with digits may be secrets that no pattern names, so they teach nothing.
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z][A-Za-z_]{7,}+(?![0-9])"
#: Share of ordinary tokens that may pass the threshold, and the steps of a score that it is set by.
FALSE_POSITIVES = 0.001
STEPS = 1_000


def _texts(documents: DataFrame, doc: str, text: str) -> DataFrame:
    return documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def base_spans(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, kind, start, end, value`` of the patterns; assignments only with values of eight characters or more."""
    spans = match_spans(_texts(documents, doc, text), BASE)
    value = F.regexp_extract("value", ASSIGN, 1)
    return spans.filter((F.col("kind") != "assign") | (F.length(value) >= LEAST_VALUE))


def _pairs(tokens: DataFrame) -> DataFrame:
    """``label, pair, n``: how often one character follows another in the tokens of each label."""
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1))
    times = F.col("n") if "n" in tokens.columns else F.lit(1)
    pairs = tokens.filter(F.length("token") >= 2).select("label", "token", times.alias("n"), at.alias("at")).select("label", F.substring(F.col("token"), F.col("at"), F.lit(2)).alias("pair"), "n")
    return pairs.groupBy("label", "pair").agg(F.sum("n").alias("n"))


def train(tokens: DataFrame) -> list[float]:
    """Log-likelihood ratios of all character pairs, from ``label`` (1 random, 0 ordinary), ``token`` and, if there, how often it occurs (``n``).

    One number for every two characters of the alphabet, whatever the data. Row by row, the
    smoothed probabilities of what follows a character sum to one.
    """
    letters = [*ALPHABET, ""]
    side = len(letters)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = {0: [[1.0] * side for _ in letters], 1: [[1.0] * side for _ in letters]}
    for label, pair, n in _pairs(tokens).collect():  # at most the square of the alphabet for each label, other characters together
        first, second = (place.get(c, side - 1) for c in pair)
        counts[label][first][second] += n
    return [log(counts[1][a][b] / sum(counts[1][a])) - log(counts[0][a][b] / sum(counts[0][a])) for a in range(side) for b in range(side)]


def score(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio over the token's character pairs."""
    side = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")

    def place(at: Column) -> Column:
        found = F.instr(F.lit(ALPHABET), F.substring(token, at, F.lit(1)))
        return F.when(found > 0, found - 1).otherwise(side - 1)

    total = F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda sum_, at: sum_ + F.get(table, (place(at) * side + place(at + 1)).cast("int")))
    return total / (F.length(token) - 1)


def labelled_tokens(documents: DataFrame, base: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``label, token, n``: values of base spans (1) and identifiers outside them (0) of all documents, copies of a text once.

    Where a text holds no pattern, its identifiers are taken as they are; only in the others they are placed and
    compared with the spans. Equal tokens are counted before they are kept.
    """
    texts = _texts(documents, doc, text)
    has_base = F.lit(False)
    for pattern in BASE.values():
        has_base = has_base | F.col("text").rlike(pattern)
    once = base.dropDuplicates(["key", "kind", "start"])
    random = once.select(F.lit(1).alias("label"), F.when(F.col("kind") == "assign", F.regexp_extract("value", ASSIGN, 1)).otherwise(F.col("value")).alias("token"))
    plain = texts.filter(~has_base & F.col("text").rlike(IDENTIFIER)).select("key", F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)).alias("tokens")).dropDuplicates(["key"])
    words = match_spans(texts.filter(has_base), {"word": IDENTIFIER}).dropDuplicates(["key", "start"])
    taken = once.select(F.col("key").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    outside = words.join(taken, (words["key"] == F.col("k")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_anti")
    ordinary = plain.select(F.explode("tokens").alias("token")).unionByName(outside.select(F.col("value").alias("token")))
    return random.unionByName(ordinary.select(F.lit(0).alias("label"), "token")).groupBy("label", "token").agg(F.count("*").alias("n"))


def threshold(tokens: DataFrame, ratios: list[float]) -> float:
    """The least score, in whole steps and not below zero, that at most :data:`FALSE_POSITIVES` of all ordinary tokens exceed."""
    steps = F.ceil(score(F.col("token"), ratios) * STEPS)
    found = tokens.filter("label = 0").groupBy(steps.alias("step")).agg(F.sum("n").alias("n")).filter("step is not null")
    rows = sorted(found.collect(), key=lambda r: -r.step)  # a score is a mean of logarithms of counts: some ten steps of a thousand
    left = FALSE_POSITIVES * sum(r.n for r in rows)
    for row in rows:
        left -= row.n
        if left < 0:
            return max(0.0, row.step / STEPS)
    return 0.0


def secret_spans(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, kind, start, end, value, score``: the base spans (score null) and the tokens the models find random (``markov``)."""
    spark = documents.sparkSession
    folder = shared_dir(spark, "secrets")
    base_spans(documents, doc, text).write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    labelled_tokens(documents, base, doc=doc, text=text).write.parquet(f"{folder}/tokens")
    tokens = spark.read.parquet(f"{folder}/tokens")
    ratios = train(tokens)
    bar = threshold(tokens, ratios)
    candidates = match_spans(_texts(documents, doc, text), {"markov": TOKEN}).withColumn("score", score(F.col("value"), ratios)).filter(F.col("score") > bar)
    taken = base.select(F.col("id").alias("i"), F.col("key").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    free = candidates.join(taken, candidates["id"].eqNullSafe(F.col("i")) & (candidates["key"] == F.col("k")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_anti")
    return base.withColumn("score", F.lit(None).cast("double")).unionByName(free)


def redact(documents: DataFrame, spans: DataFrame, doc: str = "doc_id", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span, overlapping ones together, replaced by ``mark``; all columns kept."""
    order = Window.partitionBy("id", "key").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        spans.withColumn("new", (reach.isNull() | (F.col("start") >= reach)).cast("int"))
        .withColumn("group", F.sum("new").over(order))
        .groupBy("id", "key", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("id").alias("__id"), F.col("key").alias("__key")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    )
    body, cuts = documents[text], F.col("__cuts")
    begin = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["end"].cast("int")))
    finish = F.concat(F.transform(cuts, lambda c: c["start"].cast("int")), F.array(F.length(body)))
    pieces = F.zip_with(begin, finish, lambda b, e: F.substring(body, b + 1, e - b))
    joined = documents.join(merged, documents[doc].eqNullSafe(F.col("__id")) & (text_key(body) == F.col("__key")), "left")
    return joined.select(*[F.when(cuts.isNotNull(), F.array_join(pieces, mark)).otherwise(body).alias(c) if c == text else documents[c] for c in documents.columns])


def span_digest(documents: DataFrame, spans: DataFrame, order: list[str], base: list[str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, a count ``n_<kind>`` for each base kind, ``base_text`` and ``spans``: all as ``kind:start:end`` by start, then kind as in ``order``."""
    nth = F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind"))
    entries = F.sort_array(F.collect_list(F.struct("start", nth.alias("nth"), "end", F.col("kind").isin(base).alias("base"), span_text("kind", "start", "end").alias("said"))))
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in base]
    found = spans.groupBy("id", "key").agg(entries.alias("entries"), *counts)
    rows = documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"))
    joined = rows.join(found, null_safe(rows, found, ["id", "key"]), "left")
    said = F.array_join(F.transform("entries", lambda e: e["said"]), ",")
    base_said = F.array_join(F.transform(F.filter("entries", lambda e: e["base"]), lambda e: e["said"]), ",")
    return joined.select(rows["id"], *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base], F.coalesce(base_said, F.lit("")).alias("base_text"), F.coalesce(said, F.lit("")).alias("spans"))
