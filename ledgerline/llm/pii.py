"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

Generators with high recall propose spans that overlap: of anything that looks like an address with
an at sign (also written out), every beginning that ends at a label; of digit groups with the
separators of phone numbers, cards and network addresses, every run of neighbouring groups with as
many digits as a format has. So numbers side by side are candidates of their own. Validated patterns
give the base spans, which always stay. Gradient boosted trees learn from candidates that are a base
span (1) or touch none (0), using format and context only - not the validity checks, so that a
number without its plus sign or with a wrong check digit can still look like what it is; candidates
that touch a base span without being one teach nothing and are not added. On a held-out part the
smallest probability with the wanted precision becomes the threshold; candidates above it that
touch no base span are added as ``likely``, of overlapping ones the most probable, then the longest.

Defined cases: a null or empty text has no spans; rows repeated with one id and text each get the
same spans; without candidates, or with candidates of one label only, nothing is added; other
columns are not used.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import match_spans, text_key
from ledgerline.session import shared_dir

#: Fixed by the query's contract. A search goes on from the end of the last match (\G) or at the
#: beginning of a run, so that no run is tried from each of its characters; cards are asked for
#: in their least length, as a shorter sequence of digits holds no longer one.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ORDER = ["email", "ip", "card", "phone", "likely"]

AT = r"\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?"
DOT = r"\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?"
ADDRESS = rf"[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++"
LABEL = rf"{DOT}[A-Za-z0-9-]++"
#: Where candidates are looked for; ``candidates`` proposes the parts of these matches.
GENERATORS = {
    "address": rf"(?:\G|(?<![A-Za-z0-9._%+-])){ADDRESS}(?:{LABEL})*+",
    "digits": r"[+(]?[0-9](?:[\x20().:/-]{0,2}[0-9]){6,}+|(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
}
#: The digits of the shortest and the longest format, phone numbers and cards; a network address may have fewer.
DIGITS = (7, 19)
#: Labels a domain name has at most.
LABELS = 127
#: The precision the threshold has to reach on the held-out fifth of the candidates.
PRECISION = 0.95
CONTEXT = 24


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a right check digit."""
    size = F.length(digits)

    def part(sum_: Column, at: Column) -> Column:
        d = F.substring(digits, at, F.lit(1)).cast("int")
        doubled = F.when(d >= 5, d * 2 - 9).otherwise(d * 2)
        return sum_ + F.when((size - at) % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), part) % 10 == 0


def _texts(documents: DataFrame, doc: str, text: str) -> DataFrame:
    return documents.select(F.col(doc).alias("id"), text_key(F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def base_spans(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, kind, start, end, value`` of the validated patterns."""
    spans, n = match_spans(_texts(documents, doc, text), BASE), F.length(_digits(F.col("value")))
    part = F.regexp_replace("value", r"(^|\.)0+(?=[0-9])", "$1")  # leading zeros say nothing about a part's size
    octets = part.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    right = (
        F.when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", F.when(n.between(14, 19), luhn(_digits(F.col("value")))).otherwise(F.lit(False)))
        .when(F.col("kind") == "phone", n.between(10, 15))
        .otherwise(F.lit(True))
    )
    return spans.filter(right)


def _addresses(spans: DataFrame) -> DataFrame:
    """Every beginning of an address that ends at a label."""
    stem, labels = F.regexp_extract("value", f"^{ADDRESS}", 0), F.regexp_extract_all("value", F.lit(LABEL), F.lit(0))
    # the stem has no label, so the labels of what follows it are those of the domain
    found = spans.withColumn("stem", stem).withColumn("value", F.expr("substring(value, length(stem) + 1)")).withColumn("labels", F.slice(labels, 1, LABELS - 1))
    parts = found.select("id", "key", "kind", "start", "stem", "labels", F.explode(F.sequence(F.lit(0), F.size("labels"))).alias("n"))
    value = F.concat("stem", F.array_join(F.slice("labels", F.lit(1), F.col("n")), ""))
    return parts.select("id", "key", "kind", "start", (F.col("start") + F.length(value)).alias("end"), value.alias("value"))


def _numbers(spans: DataFrame) -> DataFrame:
    """Every run of neighbouring digit groups that is as long as a format, and every long group by itself."""
    least, most = DIGITS
    groups = F.arrays_zip(F.split("value", "[0-9]+", -1).alias("gap"), F.regexp_extract_all("value", F.lit("[0-9]+"), F.lit(0)).alias("digits"))
    each = spans.select("id", "key", "kind", F.col("start").alias("run"), F.posexplode(groups)).select("id", "key", "kind", "run", "pos", "col.gap", "col.digits").filter("digits is not null")
    order = Window.partitionBy("id", "key", "kind", "run").orderBy("pos")
    placed = each.withColumn("end", F.col("run") + F.sum(F.length("gap") + F.length("digits")).over(order))
    ahead = placed.withColumn("ahead", F.collect_list(F.struct("gap", "digits", "end")).over(order.rowsBetween(0, most - 1)))
    lead = F.regexp_extract("gap", "[+(]$", 0)
    parts = ahead.select("id", "key", "kind", lead.alias("lead"), (F.col("end") - F.length("digits")).alias("first"), "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n"))
    cut = parts.withColumn("part", F.slice("ahead", F.lit(1), F.col("n")))
    size = F.aggregate("part", F.lit(0), lambda sum_, g: sum_ + F.length(g["digits"]))
    dotted = (F.col("n") == 4) & F.forall(F.slice("part", 2, 3), lambda g: g["gap"] == ".")
    right = ((size >= least) & ((size <= most) | (F.col("n") == 1))) | dotted
    value = F.concat("lead", F.col("part")[0]["digits"], F.array_join(F.transform(F.slice("part", F.lit(2), F.col("n")), lambda g: F.concat(g["gap"], g["digits"])), ""))
    return cut.filter(right).select("id", "key", "kind", (F.col("first") - F.length("lead")).alias("start"), F.element_at("part", -1)["end"].alias("end"), value.alias("value"))


def candidates(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, kind, start, end, value, before, after``: proposed spans, overlapping ones too, with the characters around them."""
    texts = _texts(documents, doc, text)
    found = match_spans(texts, GENERATORS)
    spans = _addresses(found.filter("kind = 'address'")).unionByName(_numbers(found.filter("kind = 'digits'")))
    likely = texts.filter(F.col("text").rlike("|".join(f"(?:{p})" for p in GENERATORS.values()))).dropDuplicates(["id", "key"]).select(F.col("id").alias("i"), F.col("key").alias("k"), "text")
    near = spans.join(likely, spans["id"].eqNullSafe(F.col("i")) & (spans["key"] == F.col("k")))
    first = F.greatest(F.col("start") - CONTEXT, F.lit(0))
    return near.select("id", "key", "kind", "start", "end", "value", F.lower(F.substring(F.col("text"), (first + 1).cast("int"), (F.col("start") - first).cast("int"))).alias("before"), F.lower(F.substring(F.col("text"), (F.col("end") + 1).cast("int"), F.lit(CONTEXT))).alias("after"))


def features() -> dict[str, Column]:
    """Format and context of a candidate, all numbers. Digit values, check digits and plus signs are left out.

    Addresses are looked at as if their signs were written plainly, so that one written out resembles the others.
    """
    plainly = F.regexp_replace(F.regexp_replace("value", AT, "@"), DOT, ".")
    value, before, after = F.when(F.col("kind") == "address", plainly).otherwise(F.col("value")), F.col("before"), F.col("after")

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("double")

    def says(text: Column, pattern: str) -> Column:
        return text.rlike(pattern).cast("double")

    return {
        "is_address": (F.col("kind") == "address").cast("double"),
        "length": F.length(F.regexp_replace(value, r"^\+", "")).cast("double"),
        "digits": count("[0-9]"),
        "letters": count("[A-Za-z]"),
        "groups": count("[0-9]+"),
        "dots": count(r"\."),
        "spaces": count(" "),
        "dashes": count("-"),
        "parens": count(r"[()]"),
        "slashes": count("[:/]"),
        "long_group": count("[0-9]{5,}"),
        "short_group": count("(?<![0-9])[0-9]{1,3}(?![0-9])"),
        "says_phone": says(before, r"tel|phone|call|fax|mobil|cell"),
        "says_mail": says(before, r"mail|contact|write"),
        "says_card": says(before, r"card|visa|master|iban|account|pay"),
        "says_host": says(before, r"\bip\b|host|server|addr"),
        "starts_word": says(before, r"(^|[\s(:=+/])$"),
        "ends_word": says(after, r"^($|[\s).,;/])"),
        "in_number": says(before, r"[0-9.,-]$"),
    }


def train(labelled: DataFrame, precision: float = PRECISION):
    """``(model, thresholds)`` from ``features`` and ``label``, or None if one label is missing.

    The trees learn from all candidates but a fifth, which is held out by a hash of where they are. Addresses and numbers have a threshold each, the lowest that keeps ``precision`` among
    the held-out candidates of the kind; a kind without such is never added.
    """
    hashed = F.xxhash64("id", "key", "kind", "start")
    parted = labelled.withColumn("held", F.pmod(F.shiftright(hashed, 33), F.lit(5)) == 0)
    seen = {r.label for r in parted.filter("not held").select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        return None
    names = list(features())
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=8, maxDepth=4, seed=7).fit(vectors.transform(parted.filter("not held")))
    binned = _probability(parted.filter("held"), model).groupBy("kind", F.floor(F.col("probability") * 100).alias("bin"))
    held = binned.agg(F.sum("label").alias("right"), F.count("*").alias("n")).collect()  # at most 101 rows a kind
    thresholds = {}
    for kind in GENERATORS:
        right = total = 0.0
        thresholds[kind] = 1.01
        for row in sorted((r for r in held if r.kind == kind), key=lambda r: -r.bin):
            right, total = right + row.right, total + row.n
            if right / total >= precision:
                thresholds[kind] = row.bin / 100
    return model, thresholds


def _probability(rows: DataFrame, model) -> DataFrame:
    scored = model.transform(VectorAssembler(inputCols=list(features()), outputCol="features").transform(rows))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")


def _labelled(proposed: DataFrame, base: DataFrame) -> DataFrame:
    """The candidates that are a base span (``label`` 1) or touch none (0).

    A candidate may begin one character before its base span: with a bracket or a plus sign.
    """
    rows = proposed.withColumn("base", F.lit(False)).unionByName(base.withColumn("base", F.lit(True)), allowMissingColumns=True)
    # a base span touches a candidate if it begins before the candidate's end and ends after its start
    order = Window.partitionBy("id", "key").orderBy(F.when(F.col("base"), F.col("start")).otherwise(F.col("end")), "base")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.collect_set(F.when(F.col("base"), F.col("start"))).over(Window.partitionBy("id", "key", "end"))
    same = F.array_contains("starts", F.col("start")) | F.array_contains("starts", F.col("start") + 1)
    touched = F.coalesce(F.col("reach") > F.col("start"), F.lit(False))
    label = F.when(same, 1.0).when(~touched, 0.0)
    return rows.withColumn("reach", reach).withColumn("starts", starts).filter("not base").withColumn("label", label).filter("label is not null").drop("base", "reach", "starts")


def _best(likely: DataFrame) -> DataFrame:
    """Of overlapping candidates the most probable one, to the threshold's precision, then the longest, then the first."""
    order = Window.partitionBy("id", "key").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chains = likely.withColumn("new", (reach.isNull() | (F.col("start") >= reach)).cast("int")).withColumn("chain", F.sum("new").over(order))
    rank = [(-F.floor(F.col("probability") * 100)).alias("p"), (F.col("start") - F.col("end")).alias("n")]
    ranked = chains.groupBy("id", "key", "chain").agg(F.sort_array(F.collect_list(F.struct(*rank, "start", "end", "kind", "value", "probability"))).alias("ranked"))

    def take(taken: Column, c: Column) -> Column:
        return F.when(F.exists(taken, lambda t: (t["start"] < c["end"]) & (c["start"] < t["end"])), taken).otherwise(F.concat(taken, F.array(c)))

    taken = F.aggregate("ranked", F.slice("ranked", 1, 1), take)
    return ranked.select("id", "key", F.explode(taken).alias("c")).select("id", "key", "c.start", "c.end", "c.value", "c.probability")


def pii_spans(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, kind, start, end, value, probability``: the base spans (probability null) and the ``likely`` ones."""
    spark = documents.sparkSession
    folder = shared_dir(spark, "pii")
    base_spans(documents, doc, text).write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    columns = ["id", "key", "kind", "start", "end", "value", "label", *[c.alias(n) for n, c in features().items()]]
    _labelled(candidates(documents, doc, text), base).select(*columns).write.parquet(f"{folder}/candidates")
    labelled = spark.read.parquet(f"{folder}/candidates")
    trained = train(labelled)
    kept = base.withColumn("probability", F.lit(None).cast("double"))
    if trained is None:
        return kept
    model, thresholds = trained
    threshold = F.element_at(F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair]), F.col("kind"))
    likely = _probability(labelled.filter("label = 0"), model).filter(F.col("probability") >= threshold)
    added = _best(likely)
    return kept.unionByName(added.select("id", "key", F.lit("likely").alias("kind"), "start", "end", "value", "probability"))
