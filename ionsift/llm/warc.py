"""WARC archives: written as one gzip stream a file, normalised to one member a record, read by offset."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common
from ionsift.session import settle, shared_folder

_CRLF = b"\r\n"
INDEX = "file string, offset long, length long, record_id string, record_type string"
_READ_BYTES = 1 << 20


def payloads(pages: DataFrame, page_col: str = "page_id", body_col: str = "html", at_least: int = 0) -> DataFrame:
    """``page_id``, ``body`` and what the record says of it: ``digest``, ``n_bytes``, ``refers_to``.

    Of equal payloads of at least ``at_least`` bytes the smallest page_id is the response and the
    others refer to it. A NULL body is empty. Digests are counted before the shuffle (the smallest id of each), so
    a payload that a third of the pages share costs one row per task; the join back is one that
    adaptive execution splits. Rows with equal page_id are one page: each becomes a response or each a revisit.
    """
    at = {c: i for i, c in reversed(list(enumerate(pages.columns)))}
    body = F.coalesce(F.col(f"_c{at[body_col]}").cast("string"), F.lit(""))
    plain = pages.toDF(*[f"_c{i}" for i in range(len(pages.columns))]).select(
        F.col(f"_c{at[page_col]}").cast("long").alias("page_id"), body.alias("body")
    )
    known = plain.select(
        "page_id",
        "body",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.unhex(F.sha1(F.encode("body", "UTF-8"))).alias("sha1"),
    )
    first = (
        known.where(F.col("n_bytes") >= at_least)
        .groupBy(F.col("sha1").alias("_sha1"))
        .agg(F.min("page_id").alias("_first"))
    )
    joined = known.join(first, (F.col("sha1") == F.col("_sha1")) & (F.col("n_bytes") >= at_least), "left")
    return joined.select(
        "page_id",
        "body",
        "n_bytes",
        base32(F.col("sha1")).alias("digest"),
        F.when(F.col("_first") < F.col("page_id"), F.col("_first")).alias("refers_to"),
    )


def base32(sha1):
    """Bare upper-case base32 of a 20-byte digest: 32 groups of five bits."""
    bits = F.concat(*[F.lpad(F.conv(F.hex(F.substring(sha1, i, 5)), 16, 2), 40, "0") for i in (1, 6, 11, 16)])
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.concat(
        *[
            F.substring(F.lit(letters), F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1))
            for i in range(32)
        ]
    )


def record_text(page_id, body, n_bytes, digest, refers_to, url_base: str = "urn:page:"):
    """A record as text, without its last line break, which the writer of the archive adds."""
    uri = F.concat(F.lit(url_base), F.coalesce(page_id.cast("string"), F.lit("")))
    kind = F.when(refers_to.isNull(), "response").otherwise("revisit")
    content = F.when(refers_to.isNull(), body).otherwise("")
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: <"), uri, F.lit(">\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/http;msgtype=response"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(
            refers_to.isNotNull(),
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.lit("\r\nWARC-Refers-To: <"), F.lit(url_base), refers_to.cast("string"), F.lit(">"),
                F.lit("\r\nX-Payload-Length: "), n_bytes.cast("string"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(content)).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, http, content, F.lit("\r\n"))


def write_archives(records: DataFrame, folder: str, rows_per_file: int = 20_000) -> None:
    """Write record texts as gzip streams, one whole stream per file, by Spark's text writer.

    The committer of the writer keeps a retried task from leaving half a file. ``rows_per_file``
    bounds an archive.
    """
    (
        records.write.option("compression", "gzip")
        .option("lineSep", "\r\n")
        .option("maxRecordsPerFile", rows_per_file)
        .text(folder)
    )


class Inflater:
    """Reads a gzip stream once, whatever its members, and hands out its bytes piece by piece."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.stream = chunks, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        for chunk in self.chunks:
            while chunk:
                self.held += self.stream.decompress(chunk)
                chunk = b""
                if self.stream.eof:
                    chunk, self.stream = self.stream.unused_data, zlib.decompressobj(31)
            return True
        return False

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and including ``mark``; what is left, if it does not come."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self._more():
                return self.take(len(self.held))
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        if len(self.held) < n:
            raise ValueError(f"the archive ends {n - len(self.held)} bytes early")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def fields(head: bytes) -> dict[str, str]:
    """Header fields of a record, their names in lower case."""
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def record_bytes(stream: Inflater) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of a stream with its header fields, from its version line to its last line break."""
    while True:
        head = stream.until(_CRLF + _CRLF)
        if not head.strip():
            return
        known = fields(head)
        yield known, head + stream.take(int(known["content-length"])) + stream.take(4)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def normalise(spark: SparkSession, archives: str, folder: str, level: int = 1) -> DataFrame:
    """Rewrite archives with each record as a gzip member of its own; the sidecar index, one row a record.

    Each archive is inflated once, in pieces, by the task that has its file; a record and a piece is
    all that is held beside the compressed file. The new file has the archive's name; it is written under a name of its own task attempt
    and then moved, so a repeated or speculative task leaves whole files only. The index (file,
    offset, length, record id and type) is written beside the files as Parquet and read back from there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, base = _filesystem(folder)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name = path.as_py().rsplit("/", 1)[1].removesuffix(".txt.gz") + ".warc.gz"
                data = content.as_buffer()
                pieces = (data.slice(i, min(_READ_BYTES, data.size - i)).to_pybytes() for i in range(0, data.size, _READ_BYTES))
                rows, at, unfinished = [], 0, f"{base}/{name}.{attempt}"
                with store.open_output_stream(unfinished, compression=None) as out:
                    for known, record in record_bytes(Inflater(pieces)):
                        member = zlib.compressobj(level, zlib.DEFLATED, 31)
                        packed = member.compress(record) + member.flush()
                        out.write(packed)
                        rows.append((name, at, len(packed), known["warc-record-id"], known["warc-type"]))
                        at += len(packed)
                store.move(unfinished, f"{base}/{name}")
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["file", "offset", "length", "record_id", "record_type"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives)
    files.select("path", "content").mapInArrow(work, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str, url_base: str = "urn:page:") -> DataFrame:
    """Records at the places an index names: each is read, inflated and parsed by itself.

    ``payload`` is what the record holds (NULL in a revisit); size and digest are computed from
    it, for a revisit taken from its header.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name, source = row["file"], store.open_input_file(f"{base}/{row['file']}")
                source.seek(row["offset"])
                record = zlib.decompress(source.read(row["length"]), 31)
                head, _, block = record[:-4].partition(_CRLF + _CRLF)
                known = fields(head)
                if len(block) != int(known["content-length"]):
                    raise ValueError(f"record {known['warc-record-id']} is {len(block)} bytes long")
                payload = block.partition(_CRLF + _CRLF)[2]
                digest = known["warc-payload-digest"].removeprefix("sha1:")
                number = known["warc-record-id"].strip("<>").removeprefix(url_base)
                if known["warc-type"] == "response":
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"record {known['warc-record-id']} has another digest")
                    size, first = len(payload), None
                else:
                    size, first = int(known["x-payload-length"]), int(known["warc-refers-to"].strip("<>").removeprefix(url_base))
                    payload = None
                out.append((int(number) if number else None, size, digest, known["warc-type"], first, payload))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return index.select("file", "offset", "length").mapInArrow(work, schema)


def round_trip(
    pages: DataFrame, page_col: str = "page_id", body_col: str = "html", at_least: int = 0, folder: str | None = None
) -> DataFrame:
    """Pages to archives, archives normalised, records read back through the index.

    NULL bodies are empty payloads; a NULL page_id gives a record without a number, read back as NULL; repeated
    rows are records each; an empty table gives no record; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    known = payloads(pages, page_col, body_col, at_least)
    parts = [F.col(c) for c in ("page_id", "body", "n_bytes", "digest", "refers_to")]
    write_archives(known.select(record_text(*parts).alias("value")), f"{folder}/streams")
    return read_records(normalise(spark, f"{folder}/streams", f"{folder}/members"), f"{folder}/members")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read_table(spark, sf_dir, "pages")
    return round_trip(pages).drop("payload")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS hex,
  min(page_id) OVER (PARTITION BY sha1(body)) AS first FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: list_extract(['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'],
  position(substr(hex, i, 1) IN '0123456789abcdef'))), 'string_agg', '') AS bits FROM d)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
     + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM b"""
