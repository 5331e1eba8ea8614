"""WARC archives with resolved revisits.

Writing: every record's digest is taken where its page is read. The headers (id and digest,
no payload) are shuffled by digest to find the original of each digest; a page meets its
decision again by its own id, so payloads are never shuffled by a digest that a third of
all pages may share. Originals and small records become ``response`` records with their
payload, the others ``revisit`` records that name the original and carry no payload.

Each record is built by column expressions and written by Spark's text writer. A WARC
record ends in two CRLFs, which is the writer's line separator, so the files are plain
WARC/1.1. With ``compression="gzip"`` a file is one gzip stream.

Reading: files are read whole (their size is that of a write task, so bounded by the
partition size), cut by Content-Length and never by searching for separators; record
bodies may hold anything. Revisits are then joined to their originals by digest.

Edge cases: a null payload is empty; payloads under ``least`` bytes are always responses;
a null id is written as an empty id and never chosen as original; if all copies of a payload
have null ids, all are responses; rows that repeat the id of the original are responses
too; null URLs are written without target URI. Line breaks in a URL are percent-encoded.
Empty tables give an empty archive. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch

CRLF = "\r\n"
END = CRLF + CRLF
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_PAGE = "urn:page:"
RECORD = "page_id long, url string, record_type string, digest string, refers_to long, body_bytes long, body_digest string"


def decisions(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per distinct (page_id, digest): the original it refers to, or null."""
    headers = (
        pages.filter(F.octet_length("payload") >= least)
        .select("page_id", F.sha2("payload", 256).alias("digest"))
        .distinct()
    )
    originals = headers.groupBy(F.col("digest").alias("of")).agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    # Digests of a single page need no join: the page is its own original.
    shared = originals.filter("n > 1 AND original IS NOT NULL").drop("n")
    revisit = ~F.col("page_id").eqNullSafe(F.col("original"))
    return headers.join(shared, headers.digest == shared.of).filter(revisit).select("page_id", "digest", "original")


def line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{NO_PAGE}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def one_line(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, least: int = LEAST, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """One column ``record``: header, blank line and block of each page's record."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    found = decisions(rows, least).select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "original")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.join(found, F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    revisit = F.col("original").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", page_urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, page_urn(F.col("original")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(CRLF), block).alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write ``(page_id, url, html)`` as deduplicated archives."""
    records(pages, least).write.option("lineSep", END).option("compression", "gzip").text(path)


class Window:
    """Bytes of one archive, unpacked a piece at a time."""

    def __init__(self, content: bytes, piece: int = 1 << 20):
        packed = content[:2] == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if packed else None
        self.content, self.piece, self.at, self.have = memoryview(content), piece, 0, bytearray()

    def _more(self) -> bool:
        if self.inflate is not None and self.inflate.eof:
            if not self.inflate.unused_data:
                return False
            rest = self.inflate.unused_data
            self.inflate = zlib.decompressobj(31)
            self.have += self.inflate.decompress(rest)
            return True
        if self.at >= len(self.content):
            return False
        piece = self.content[self.at : self.at + self.piece]
        self.at += len(piece)
        self.have += self.inflate.decompress(piece) if self.inflate is not None else piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and without ``mark``; None at the end of the archive."""
        seen = 0
        while (found := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark))
            if not self._more():
                if self.have.strip():
                    raise ValueError("the archive ends within a header")
                return None
        out = bytes(self.have[:found])
        del self.have[: found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive."""
    archive = Window(content)
    while (head := archive.until(END.encode())) is not None:
        first, *lines = head.decode("utf-8", "surrogateescape").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        yield fields, archive.take(int(fields["content-length"]))
        if archive.take(len(END)) != END.encode():
            raise ValueError("a record does not end in two line breaks")


def _page(urn: str | None) -> int | None:
    found = (urn or "").strip("<>").removeprefix(NO_PAGE)
    return int(found) if found else None


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            for fields, block in parse(content.as_py()):
                rows.append(
                    (
                        _page(fields.get("warc-record-id")),
                        fields.get("warc-target-uri"),
                        fields["warc-type"],
                        fields["warc-payload-digest"].removeprefix("sha256:"),
                        _page(fields.get("warc-refers-to")),
                        len(block),
                        hashlib.sha256(block).hexdigest(),
                    )
                )
            names = ["page_id", "url", "record_type", "digest", "refers_to", "body_bytes", "body_digest"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``, with size and digest of its block."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_headers, RECORD)


def resolve(headers: DataFrame) -> DataFrame:
    """Give each revisit the size and digest of its original's payload.

    Headers are shuffled by digest; only digests that some revisit names are looked up.
    A revisit whose original is missing keeps a null size.
    """
    revisits = headers.filter("record_type = 'revisit'")
    responses = headers.filter("record_type = 'response'")
    named = revisits.select(F.col("digest").alias("of")).distinct()
    originals = (
        responses.join(named, responses.digest == named.of, "left_semi")
        .groupBy(F.col("digest").alias("of"))
        .agg(F.first("body_bytes").alias("payload_bytes"), F.first("body_digest").alias("payload_digest"))
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    own = responses.withColumns({"payload_bytes": F.col("body_bytes"), "payload_digest": F.col("body_digest")})
    back = revisits.join(originals, revisits.digest == originals.of, "left")
    return own.select(*columns).unionByName(back.select(*columns))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op1")
    path = scratch.path("archives")
    with scratch.shuffles_removed():
        write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return resolve(scratch.save(read_headers(spark, path), "headers"))


OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p
), o AS (
  SELECT payload_digest, min(page_id) AS original FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN o.original IS NOT NULL AND d.page_id IS DISTINCT FROM o.original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.original IS NOT NULL AND d.page_id IS DISTINCT FROM o.original THEN o.original END AS refers_to,
       u.url
FROM d LEFT JOIN o USING (payload_digest) JOIN pages u ON u.page_id IS NOT DISTINCT FROM d.page_id
"""
