"""Web archives: records written and read back, and an index merged from sorted runs.

Archives are WARC 1.1 files. Spark's text writer ends every row with the record separator, so a
row is a record; a file, packed by gzip, holds at most ``RECORDS_PER_ARCHIVE`` of them. A page whose payload was
captured before is a revisit record, without the payload.

Each archive read gives one run of index rows, sorted by URL key and time. Runs are dealt to
ranges of the key and merged there by a loser tree, so that the ranges in their order hold the
capture histories of all URLs.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.workspace import Workspace

RECORDS_PER_ARCHIVE = 4000
LEAST_BYTES = 0

_END = "\r\n\r\n"
_FIRST_CAPTURE = 1_704_067_200
_RADIX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE_32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hex_digest: Column) -> Column:
    """Base 32 of a 160-bit digest in hex: ten hex digits are eight of base 32."""
    eights = [F.lpad(F.conv(F.substring(hex_digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*eights)), _RADIX_32, _BASE_32)


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uri(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), page.cast("string"), F.lit(">"))


def write_archives(ws: Workspace, pages: DataFrame, least_bytes: int = LEAST_BYTES, records: int = RECORDS_PER_ARCHIVE) -> str:
    """Write ``pages (page_id, url, html)`` as archives in the shared folder, and return theirs.

    Of the pages with equal payloads of at least ``least_bytes`` bytes, those with the least
    ``page_id`` (a null one counts as the greatest) are responses and the others revisits.
    Digests are counted before pages move, and only the pages' own rows are joined to the counts.
    The pages carry no time of capture, so it follows their ids.
    """
    payload = F.coalesce("html", F.lit(""))
    page = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        # Control characters and spaces would break the header.
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("bigint").alias("size"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    firsts = page.groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = firsts.filter("copies > 1").select(F.col("digest").alias("_digest"), F.col("size").alias("_size"), "first")
    joined = page.join(firsts, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (F.col("size") >= least_bytes)
    body = F.when(F.col("_revisit"), F.lit("")).otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(_END)
    )
    seconds = F.lit(_FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 28))
    utc = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("_revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uri(F.col("page_id"))),
        _line("WARC-Date", F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("digest")))),
        _line("WARC-Profile", F.when(F.col("_revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", F.when(F.col("_revisit"), _uri(F.col("first")))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(F.concat(http, body)).cast("string")),
        F.lit("\r\n"),
    )
    folder = f"{ws.folder}/archives"
    rows = joined.withColumn("_revisit", revisit).select(F.concat(head, http, body).alias("value"))
    rows.write.mode("overwrite").option("lineSep", _END).option("maxRecordsPerFile", records).text(folder, compression="gzip")
    return folder


def _records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, header, block)`` of the records of an archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        header = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(header["Content-Length"])
        yield at, stop - at, header, archive[end + 4 : stop]
        at = stop + len(_END)


def url_key(url: str | None) -> str:
    """Host parts from the last to the first, then path and query, so that a site sorts together."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    path = parts.path or "/"
    return f"{','.join(reversed(host.split('.')))}){path.lower()}" + f"?{parts.query.lower()}" * bool(parts.query)


def _page_of(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


_INDEX = [
    ("run", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("offset", pa.int64()), ("length", pa.int64()),
]
_INDEX_SCHEMA = ", ".join(f"{name} {'string' if kind == pa.string() else 'bigint'}" for name, kind in _INDEX)
_KEY = ["url_key", "captured", "page_id"]


def index_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One sorted run of index rows per archive, read from the archives.

    A response's digest is taken from its payload again, and must be the one in its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for offset, length, header, block in _records(gzip.decompress(content.as_py())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(line[15:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length:"))
                    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                    if header["WARC-Type"] == "response" and (
                        len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
                    ):
                        raise ValueError(f"payload at {offset} of {name} is not the one that was written")
                    rows.append((
                        url_key(header.get("WARC-Target-URI")), header["WARC-Date"], _page_of(header.get("WARC-Record-ID")),
                        header["WARC-Type"], _page_of(header.get("WARC-Refers-To")), size, digest, offset, length,
                    ))
                rows.sort(key=_order_of)
                columns = list(zip(*rows, strict=True)) if rows else [()] * 9
                arrays = [[name.as_py()] * len(rows), range(len(rows)), *columns]
                yield pa.record_batch([pa.array(list(c), t) for c, (_, t) in zip(arrays, _INDEX, strict=True)], names=[n for n, _ in _INDEX])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, _INDEX_SCHEMA)


def _order_of(row: Sequence) -> tuple:
    """By key, time and id, a null id first as Spark sorts it."""
    return row[0].encode(), row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merge sorted lists: each inner node keeps the loser of its match, the root the winner.

    Putting forth the next row replays one path of the tree, a comparison per level.
    """

    def __init__(self, runs: Sequence[Sequence], order) -> None:
        self.runs, self.order = runs, order
        self.next = [0] * len(runs)
        self.keys = [self._key(run) for run in range(len(runs))]
        self.losers = [-1] * len(runs)
        for run in range(len(runs)):
            self._replay(run, building=True)

    def _key(self, run: int):
        at = self.next[run]
        return (1,) if at == len(self.runs[run]) else (0, self.order(self.runs[run][at]), run)

    def _replay(self, run: int, building: bool = False) -> None:
        node = (run + len(self.runs)) // 2
        while node > 0:
            if building and self.losers[node] < 0:
                self.losers[node] = run
                return
            if self.keys[self.losers[node]] < self.keys[run]:
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator:
        while self.runs and self.next[self.losers[0]] < len(self.runs[self.losers[0]]):
            run = self.losers[0]
            yield self.runs[run][self.next[run]]
            self.next[run] += 1
            self.keys[run] = self._key(run)
            self._replay(run)


def merge_runs(runs: DataFrame) -> DataFrame:
    """Index rows in the global order of URL key, time and id: partition by partition, row by row.

    Rows are dealt to ranges of the whole key, so a URL or host with very many captures is
    divided as well. A task holds the rows of its range.
    """
    names = [name for name, _ in _INDEX]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema(_INDEX)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        column = table.column("run").to_pylist()
        edges = [0, *(i for i in range(1, len(column)) if column[i] != column[i - 1]), len(column)]
        keys = list(zip(*(table.column(c).to_pylist() for c in _KEY), range(table.num_rows), strict=True))
        merged = LoserTree([keys[a:b] for a, b in zip(edges, edges[1:], strict=False)], _order_of)
        for batch in table.take(pa.array([row[3] for row in merged])).to_batches():
            yield batch

    dealt = runs.select(*names).repartitionByRange(*_KEY).sortWithinPartitions("run", "place")
    return dealt.mapInArrow(run, _INDEX_SCHEMA)


def capture_histories(
    ws: Workspace, pages: DataFrame, least_bytes: int = LEAST_BYTES, records: int = RECORDS_PER_ARCHIVE
) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return the merged index, a row per page.

    A null html is an empty payload, and empty payloads are equal ones. A null url has the empty
    key. Rows that repeat an id and a payload are of one type; a null id is a response if all
    pages with its payload have none. An empty table gives archives without records and no rows.
    Other columns are not read.
    """
    folder = write_archives(ws, pages, least_bytes, records)
    return merge_runs(ws.save(index_runs(ws.spark, folder), "index_runs"))
