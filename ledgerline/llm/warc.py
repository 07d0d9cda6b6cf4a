"""WARC archives: write, read, and resolve revisits.

Headers alone (id, digest, length) are shuffled by payload digest to find the record with the smallest
id of each digest. It keeps its payload, the others become revisit records that refer to it; pages meet these
originals by digest, where payloads are moved once if the originals are too many to broadcast. Archives
are gzip files written by Spark's text writer, one record after another, so they commit and
recover like any table and their size has no bound that matters: the reader streams them.

The reader joins a file's lines again and cuts them by ``Content-Length`` alone, so payloads may hold
anything, other archives included; a record that is not followed by ``CRLF CRLF`` is an error. Lines
end at one byte because Spark's text source misses, or loses bytes before, a longer separator that
an input buffer divides. A file that the text source would split (only uncompressed ones) is refused. Gzip files are read by one task from their beginning, lines in order.

Defined cases: a null payload is an empty one; payloads under ``least`` bytes are always
responses; of rows repeated with the smallest id, each is a response, and rows that repeat an id and a payload
share a record id; a record without an id is always a response and no other one refers to it (its id is
the empty string in headers and null again when read); null URLs
are written as ``about:blank``; line breaks in URLs are percent-encoded; no pages, no records.
"""

import hashlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
END = b"\r\n\r\n"
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_type string, record_id string, id string, target_uri string, refers_to string, digest string, payload_bytes long, payload binary"


def payload_headers(pages: DataFrame, id: str = "page_id", payload: str = "html") -> DataFrame:
    """``id, digest, payload_bytes``: what is shuffled instead of the payloads."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return pages.select(F.col(id).alias("id"), F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("payload_bytes"))


def originals(headers: DataFrame, least: int = 100) -> DataFrame:
    """``digest, original``: the smallest id of each payload of at least ``least`` bytes that occurs more than once."""
    return headers.filter(F.col("payload_bytes") >= least).groupBy("digest").agg(F.min("id").alias("original"), F.count("*").alias("n")).filter("n > 1").select("digest", "original")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)))


def write_archives(pages: DataFrame, first: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html", date: Column | None = None) -> None:
    """Writes a record with fresh headers for every page; ``first`` is a written table from ``originals``.

    A payload that many pages share is a skewed join key on plain scans; adaptive execution splits it.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    uri = F.coalesce(F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A"), F.lit("about:blank"))
    records = pages.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), uri.alias("uri"), body.alias("body"), F.sha2(body.cast("binary"), 256).alias("digest"), F.octet_length(body).alias("length"))
    joined = records.join(first.select("digest", F.col("original").cast("string").alias("original")), "digest", "left")
    revisit = F.col("original").isNotNull() & (F.col("id") != "") & (F.col("original") != F.col("id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("length").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    when = F.date_format(F.current_timestamp() if date is None else date, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    head = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<"), _uuid(F.col("id"), F.col("digest"), revisit.cast("string")), F.lit(">"))),
        line("WARC-Date", when),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<"), _uuid(F.col("original"), F.col("digest"), F.lit("false")), F.lit(">"))), line("X-Refers-To-Id", F.col("original")))).otherwise(F.lit("")),
        line("X-Id", F.col("id")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    joined.select(F.concat(head, F.lit("\r\n"), block).alias("record")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (x.split(b":", 1) for x in head.split(b"\r\n") if b":" in x)
    return {k.strip().lower().decode(): v.strip().decode() for k, v in pairs}


def _parsed(fields: dict[str, str], block: bytes, with_payload: bool):
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    response = fields["warc-type"] == "response"
    digest = hashlib.sha256(payload).hexdigest() if response else fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if response and fields.get("warc-payload-digest", "").startswith("sha256:") and fields["warc-payload-digest"] != f"sha256:{digest}":
        raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not match")
    return (fields["warc-type"], fields.get("warc-record-id"), fields.get("x-id") or None, fields.get("warc-target-uri"), fields.get("x-refers-to-id"), digest, len(payload) if response else None, payload if with_payload else None)


class _Stream:
    """The bytes of one file as they come, cut into records by their Content-Length."""

    def __init__(self, path: str):
        self.path, self.held, self.known = path, bytearray(), None

    def records(self, data: bytes, with_payload: bool):
        self.held += data
        at = 0
        while True:
            if self.known is None:
                end = self.held.find(END, at)
                if end < 0:
                    break
                head = bytes(self.held[at:end])
                if not head.startswith(b"WARC/"):
                    raise ValueError(f"{self.path}: {head[:40]!r} is not the beginning of a record")
                fields = _fields(head)
                self.known, at = (fields, int(fields["content-length"])), end + len(END)
            fields, length = self.known
            if len(self.held) < at + length + len(END):
                break
            if self.held[at + length : at + length + len(END)] != END:
                raise ValueError(f"{self.path}: {fields.get('warc-record-id')} does not end where its Content-Length says")
            yield _parsed(fields, bytes(self.held[at : at + length]), with_payload)
            self.known, at = None, at + length + len(END)
        del self.held[:at]

    def close(self) -> None:
        if self.held or self.known:
            raise ValueError(f"{self.path} ends within a record")


def _records(with_payload: bool):
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.string()] * 6 + [pa.int64(), pa.binary()]

    def read(batches):
        stream = None
        for batch in batches:
            rows = []
            for path, lines in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), itemgetter(0)):
                if stream is None or path != stream.path:
                    if stream is not None:
                        stream.close()
                    stream = _Stream(path)
                rows.extend(stream.records(b"".join(x + b"\n" for _, x in lines), with_payload))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)], names=names)
        if stream is not None:
            stream.close()

    return read


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record, see ``RECORD``; digests of responses are computed from the payload and checked."""
    split = F.col("_metadata.file_block_length") < F.col("_metadata.file_size")
    whole = F.when(split, F.raise_error(F.concat(F.col("_metadata.file_path"), F.lit(" would be split: compress it")))).otherwise(F.col("value"))
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("_metadata.file_path").alias("path"), whole.cast("binary").alias("line"))
    return lines.mapInArrow(_records(with_payload), RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """``id, record_type, refers_to, digest, payload_bytes``: revisits take their length from the response they refer to.

    ``records`` should be a written table: it is read for both sides.
    """
    heads = records.select("id", "record_type", "refers_to", "digest", "payload_bytes")
    first = heads.filter("record_type = 'response'").groupBy(F.col("digest").alias("d")).agg(F.max("payload_bytes").alias("known"))
    alone = heads.filter("record_type = 'response'")
    revisits = heads.filter("record_type = 'revisit'")
    found = revisits.join(first, F.col("digest") == F.col("d"), "left").select("id", "record_type", "refers_to", "digest", F.coalesce("known", F.raise_error(F.concat(F.lit("no response for revisit "), F.col("id")))).cast("long").alias("payload_bytes"))
    return alone.unionByName(found)
