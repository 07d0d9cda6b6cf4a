"""Typed staging of landed prices and extraction of facts from nested filings."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import AMOUNT, FISCAL_PERIODS, GAAP_TAGS, MONEY, PRICE


def stage_prices(raw: DataFrame) -> DataFrame:
    """Clean the ticker, cast every column and default missing dividends and splits."""
    split = T.DecimalType(10, 4)
    columns = [
        F.upper(F.trim("ticker")).alias("ticker"),
        F.col("trade_date").cast("date").alias("trade_date"),
        *[F.col(c).cast(PRICE).alias(c) for c in ("open_price", "high_price", "low_price", "close_price", "adj_close")],
        F.col("volume").cast("bigint").alias("volume"),
        F.coalesce(F.col("dividend_amount").cast(PRICE), F.lit(0).cast(PRICE)).alias("dividend_amount"),
        F.coalesce(F.col("split_coefficient").cast(split), F.lit(1).cast(split)).alias("split_coefficient"),
    ]
    if "ingested_at" in raw.columns:
        columns.append(F.col("ingested_at"))
    return raw.select(*columns)


def extract_facts(
    filings: DataFrame,
    tags=GAAP_TAGS,
    taxonomy: str = "us-gaap",
    unit: str = "USD",
    periods=FISCAL_PERIODS,
    mode: str = "FAILFAST",
    payload: str = "payload",
) -> DataFrame:
    """Flatten nested filing documents to one typed, distinct row per reported fact.

    Only the wanted tags and unit are declared, so one streaming pass over each document
    skips everything else without building it. Amounts are declared as decimals: the parser
    then takes their digits as written, while a number read as text would pass through a
    double. A malformed document - cut off, a scalar where facts should be, an amount that is
    no number or too large - fails the job. ``mode="PERMISSIVE"`` lets such documents lose
    facts instead; ``rejected_filings`` names them.
    """
    document = _document(tags, taxonomy, unit)
    parsed = filings.select("ticker", "cik", F.from_json(payload, document, {"mode": mode}).alias("doc"))
    body = F.col("doc.facts").getField(taxonomy)
    per_tag = [F.struct(F.lit(t).alias("gaap_tag"), body.getField(t).getField("units").getField(unit).alias("facts")) for t in tags]
    per_fact = parsed.select("ticker", "cik", F.inline(F.array(*per_tag))).select("ticker", "cik", "gaap_tag", F.inline("facts"))
    return _typed(per_fact, periods)


def parse_filings(filings: DataFrame, payload: str = "payload") -> DataFrame:
    """Filings with their documents parsed once, as a variant column ``body`` in place of the text.

    Written as a table, it serves the extraction of any tag, also of one that nobody asked for when it was
    written, without reading text again. A malformed document fails the job.
    """
    return filings.select(*[c for c in filings.columns if c != payload], F.parse_json(payload).alias("body"))


def extract_parsed_facts(
    documents: DataFrame,
    tags=GAAP_TAGS,
    taxonomy: str = "us-gaap",
    unit: str = "USD",
    periods=FISCAL_PERIODS,
    body: str = "body",
) -> DataFrame:
    """:func:`extract_facts` over documents that :func:`parse_filings` has parsed; ``tags=None`` takes every tag there is.

    The tags of a document come out of its parsed form by ``variant_explode``. A figure that is no amount fails
    the job; what is no object where facts should be holds no facts.
    """
    facts = F.variant_get(F.col(body), f"$.facts['{taxonomy}']", "variant")
    found = documents.select("ticker", "cik", facts.alias("_facts")).where(F.col("_facts").isNotNull())
    each = found.lateralJoin(documents.sparkSession.tvf.variant_explode(F.col("_facts").outer())).select("ticker", "cik", F.col("key").alias("gaap_tag"), "value")
    if tags is not None:
        each = each.where(F.col("gaap_tag").isin(*tags))
    fact = ", ".join(f"`{n}`: string" for n in ("form", "fy", "fp", "filed", "start", "end", "accn"))
    rows = F.variant_get("value", f"$.units['{unit}']", f"array<struct<{fact}, `val`: {MONEY.simpleString()}>>")
    return _typed(each.select("ticker", "cik", "gaap_tag", F.inline(rows)), periods)


def _typed(found: DataFrame, periods) -> DataFrame:
    """The distinct facts of wanted periods in the types of the fact table."""
    return (
        found.where(F.col("val").isNotNull() & F.col("fy").isNotNull() & F.col("fp").isin(*periods))
        .select(
            "ticker",
            "cik",
            "gaap_tag",
            F.col("form").alias("form_type"),
            F.col("fy").cast("int").alias("fiscal_year"),
            F.upper("fp").alias("fiscal_period"),
            F.col("filed").cast("date").alias("filed_date"),
            F.col("start").cast("date").alias("period_start_date"),
            F.col("end").cast("date").alias("period_end_date"),
            F.col("val").cast(AMOUNT).alias("amount"),
            F.col("accn").alias("accession_number"),
        )
        .distinct()
    )


def rejected_filings(filings: DataFrame, tags=GAAP_TAGS, taxonomy: str = "us-gaap", unit: str = "USD", payload: str = "payload") -> DataFrame:
    """The filings that :func:`extract_facts` refuses, with all their columns."""
    document = _document(tags, taxonomy, unit).add("_corrupt", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(payload, document, options)
    return filings.where(F.col(payload).isNotNull() & (parsed.isNull() | parsed.getField("_corrupt").isNotNull()))


def _document(tags, taxonomy: str, unit: str) -> T.StructType:
    texts = [T.StructField(n, T.StringType()) for n in ("form", "fy", "fp", "filed", "start", "end", "accn")]
    fact = T.StructType([*texts, T.StructField("val", MONEY)])
    by_unit = T.StructType([T.StructField(unit, T.ArrayType(fact))])
    by_tag = T.StructType([T.StructField(tag, T.StructType([T.StructField("units", by_unit)])) for tag in tags])
    return T.StructType([T.StructField("facts", T.StructType([T.StructField(taxonomy, by_tag)]))])
