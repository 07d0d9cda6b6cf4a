"""Incremental landing: new files in a folder are upserted as they arrive."""

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.ingest import FILINGS, trade_month, watched_filings
from ledgerline.schemas import PRICE_KEYS, PRICE_UPDATES, RAW_MARKET_PRICES
from ledgerline.sources.landed import shape_filings
from ledgerline.sources.landing import land_partitions
from ledgerline.sources.merge_on_read import Landing, compact_when_full, land_delta
from ledgerline.sources.versions import TableSet


def land_stream(
    batches: DataFrame,
    table_path: str,
    schema,
    checkpoint_path: str,
    keys,
    update_cols,
    partition_col: str,
    partition_of,
    **options,
):
    """Upsert every micro-batch of ``batches`` (a streaming frame) and stop when drained.

    The upsert is idempotent and each batch stages under its own number, so a batch that is
    run again after a failure leaves the same table. The staging lies in the checkpoint
    folder, because batch numbers only mean something together with that checkpoint.
    """

    def upsert_batch(batch, number):
        land_partitions(
            batch.sparkSession,
            table_path,
            schema,
            batch,
            f"{checkpoint_path}/staging",
            str(number),
            keys,
            update_cols,
            partition_col,
            partition_of,
            **options,
        )

    return (
        batches.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def land_price_stream(spark: SparkSession, incoming: str, table_path: str, checkpoint_path: str, **options):
    """Price files in bronze shape, into a table partitioned by trading month."""
    batches = spark.readStream.schema(RAW_MARKET_PRICES).parquet(incoming)
    return land_stream(
        batches,
        table_path,
        RAW_MARKET_PRICES,
        checkpoint_path,
        PRICE_KEYS,
        PRICE_UPDATES,
        "trade_month",
        trade_month(),
        **options,
    )


def land_deltas(batches: DataFrame, root: str, landing: Landing, checkpoint_path: str, prepare=None):
    """Land every micro-batch of a stream as a delta of one table of the set below ``root``, and stop when drained.

    A batch that was committed but not marked as done in the checkpoint is not landed again: its number is
    remembered with the table. ``prepare`` makes table rows of a micro-batch.
    """
    name = checkpoint_path.rstrip("/").rsplit("/", 1)[-1]

    def land(batch, number):
        tables = TableSet(batch.sparkSession, root)
        tables, _ = land_delta(tables, landing, batch if prepare is None else prepare(batch), f"{name}/{number}")
        compact_when_full(tables, landing)

    return batches.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()


def land_filing_stream(spark: SparkSession, incoming: str, root: str, checkpoint_path: str, watchlist: DataFrame):
    """Filings as JSON lines (``ticker``, ``cik``, ``payload``) of watched companies, one document for each company and micro-batch."""
    lines = spark.readStream.schema("ticker string, cik string, payload string").json(incoming)
    return land_deltas(shape_filings(lines), root, FILINGS, checkpoint_path, lambda batch: watched_filings(batch, watchlist))
