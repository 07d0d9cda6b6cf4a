"""One query per operator over its whole tables, and their SQL."""

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, decontaminate, divergence, jaccard_join, lexical_search, licenses, line_runs, mixing, pii, quality, secrets, url_filter, warc
from ledgerline.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the pages as archives with revisits, reads them back and resolves the revisits."""
    pages, folder = table(spark, sf_dir, "pages"), shared_dir(spark, "warc")
    warc.originals(warc.payload_headers(pages)).write.parquet(f"{folder}/originals")
    warc.write_archives(pages, spark.read.parquet(f"{folder}/originals"), f"{folder}/archives")
    warc.read_archives(spark, f"{folder}/archives", with_payload=False).drop("payload").write.parquet(f"{folder}/headers")
    found = warc.resolve(spark.read.parquet(f"{folder}/headers"))
    return found.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words and a similarity of 0.9, as the query's contract says."""
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=Fraction(9, 10))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.span_digest(documents, secrets.secret_spans(documents), secrets.ORDER, list(secrets.BASE))
    return found.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), "spans")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.MultiIndex(vectors).search(vectors.filter("vec_id % 50 = 0"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.span_digest(documents, pii.pii_spans(documents), pii.ORDER, list(pii.BASE))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), "spans")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("row.doc_id").alias("doc_id"), (quality.bucket(F.col("row.doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


#: Fixed by the query's contract: verdict, host, beginning of the path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Hosts whose URLs the query lists: a label that begins with one of these words.
ADVERT_HOST = r"(^|\.)(ads?|adserver|track|tracker|tracking)[0-9]*[-.]"

#: Of the others, the first digits of the hashes that are listed: two of sixteen.
LISTED_SHARE = "3c"


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no list of their own: it holds the canonical URLs of advert hosts and an eighth of all others, by their hash."""
    pages = table(spark, sf_dir, "pages")
    row = lambda rule: F.struct(*[F.lit(x).alias(n) for n, x in zip(("verdict", "host", "path"), rule)])
    rules = spark.range(1).select(F.inline(F.array(*[row(r) for r in URL_RULES])))
    url = F.col("url")
    urls = pages.select(url_filter.host(url).alias("host"), url_filter.canonical(url).alias("canonical"))
    listed = urls.filter(F.col("host").rlike(ADVERT_HOST) | F.md5("canonical").rlike(f"^[{LISTED_SHARE}]")).select("canonical")
    found = url_filter.judge(pages, rules, listed)
    return found.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.detect(table(spark, sf_dir, "documents")).withColumn("base", licenses.base_detections())
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        licenses.joined_labels(F.col("base")).alias("base_labels"),
        licenses.joined_labels(F.col("detections")).alias("labels"),
        licenses.score().alias("score"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.Audit(table(spark, sf_dir, "documents"), min_docs=30).report(top=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_line_dedup": op2_line_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_secrets": op5_secrets,
    "op6_mix_sources": op6_mix_sources,
    "op7_nearest": op7_nearest,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_url_filter": op10_url_filter,
    "op11_license_scan": op11_license_scan,
    "op12_lexical_search": op12_lexical_search,
    "op13_source_divergence": op13_source_divergence,
}

