"""Text expressions shared by the operators: ASCII case, words, and positions of pattern matches."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of characters other than ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is. ``lower`` does the same to pure ASCII, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_key(text: Column) -> Column:
    """Tells rows of one id apart by their text; rows equal in both have equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def match_spans(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Every leftmost non-overlapping match of each pattern.

    ``texts`` has ``id``, ``key`` and ``text`` (not null). Returns ``id, key, kind, start, end, value``;
    positions count code points, the end is exclusive. A text is cut at its matches and the
    positions are running sums of the pieces' lengths, so work is linear in the text.
    Repeated rows give their spans once. Patterns must not match the empty string.
    """
    cut = None
    for kind, pattern in patterns.items():
        own = (
            texts.filter(F.col("text").rlike(pattern))
            .select("id", "key", F.lit(kind).alias("kind"), F.posexplode(F.arrays_zip(F.split("text", pattern, -1).alias("gap"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("value"))))
            .select("id", "key", "kind", F.col("pos"), F.length("col.gap").alias("gap"), F.col("col.value").alias("value"))
            .filter(F.col("value").isNotNull())
        )
        cut = own if cut is None else cut.unionByName(own)
    pieces = cut.dropDuplicates(["id", "key", "kind", "pos"])
    before = Window.partitionBy("id", "key", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    return pieces.select("id", "key", "kind", end.alias("end"), "value").select("id", "key", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value")


def span_text(kind: str, start: str, end: str) -> Column:
    return F.concat_ws(":", F.col(kind), F.col(start), F.col(end))


def null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Join condition under which null keys meet."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
