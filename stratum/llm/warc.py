"""WARC archives of pages and their capture index, merged from sorted runs.

Writing: one record per page, plain WARC/1.1, by Spark's text writer with the record separator as line
separator, so archives land on any file system Spark writes to. Of pages with equal payloads of at
least ``LEAST_REVISIT`` bytes the one with the largest id is a response, the others are revisits
that name it. Reading: archives of about ``ARCHIVE_BYTES`` are read whole, records found by their
Content-Length, payloads hashed again and held against the header.

Index: each archive gives a run of captures sorted by URL key and timestamp. The runs are dealt by ranges
of (URL key, timestamp, id), so a url with a third of all captures is cut by time; in each range the
ascending runs that arrive are merged by a loser tree, and the ranges in order are the history.

Defined results: a null html is an empty payload, a null url an empty one. Rows that repeat the largest
id of a payload are responses each. A null id is no id: it is largest only among null ids.
Pages have no capture time; without a ``date`` column the record dates follow from the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import shared_dir

from .scratch import stored

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 8 << 20
LARGEST_ARCHIVE = 1 << 30
RANGE_ROWS = 100_000
VERSION = b"WARC/1.1\r\n"
BLANK = b"\r\n\r\n"
CRLF = "\r\n"
EPOCH = 1_704_067_200
YEAR = 31_536_000
CAPTURES = (
    "url_key string, timestamp string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "archive string, offset long, length long"
)
FIELDS = [part.split()[0] for part in CAPTURES.split(", ")]


def url_key(url: Column) -> Column:
    """Sort key: the host's labels in reverse, then path and query, in lower case, without scheme and fragment."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.lower(rest))
    return F.coalesce(F.when(F.instr(url, "://") > 0, key).otherwise(F.lower(url)), F.lit(""))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str | None = None) -> DataFrame:
    """One string column ``value`` per page: a whole record without its closing separator."""
    payload = F.coalesce(F.col(html), F.lit(""))
    size, digest = F.octet_length(payload).cast("long"), F.sha1(payload.cast("binary"))
    rows = pages.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"),
        size.alias("size"), digest.alias("digest"),
        (F.col(date) if date else F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(YEAR)))).alias("date"),
    )
    first = pages.select(F.col(key).cast("long").alias("id"), size.alias("size"), digest.alias("digest"))
    # Only payloads that come again; written, so that the join knows the size.
    again = stored(
        first.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n"),
        "warc-again",
    )
    joined = rows.join(again, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("id").eqNullSafe(F.col("kept"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    name = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: <urn:page:"), name, F.lit(">" + CRLF),
        F.lit("WARC-Date: "), F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(CRLF),
        F.lit("WARC-Target-URI: "), F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), F.lit(CRLF),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF),
            F.lit("WARC-Refers-To: <urn:page:"), F.col("kept").cast("string"), F.lit(">" + CRLF),
        )).otherwise(""),
        F.lit("WARC-URL-Key: "), F.regexp_replace(url_key(F.col("url")), "[\r\n]", ""), F.lit(CRLF),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2),
    )
    return joined.select(F.concat(header, block).alias("value"))


def write_archives(pages: DataFrame, path: str, **columns) -> None:
    """Archives of about ``ARCHIVE_BYTES``, and of at most ``LARGEST_ARCHIVE`` whatever the pages' sizes are, without a shuffle."""
    size = F.octet_length(F.coalesce(F.col(columns.get("html", "html")), F.lit(""))) + F.octet_length(F.coalesce(F.col(columns.get("url", "url")), F.lit(""))) + 700
    mean, most = pages.agg(F.avg(size), F.max(size)).first()
    per_file = max(1, min(int(ARCHIVE_BYTES / (mean or 1)), LARGEST_ARCHIVE // (most or 1)))
    records(pages, **columns).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file).text(path)


def parse(name: str, data: bytes) -> Iterator[tuple]:
    """Captures of one archive in file order; raises on a record that is not whole or not what it says."""
    at = 0
    while at < len(data):
        end = data.find(BLANK, at)
        if not data.startswith(VERSION, at) or end < 0:
            raise ValueError(f"{name}: no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in data[at + len(VERSION) : end].decode("utf-8").split(CRLF))
        body = end + len(BLANK)
        close = body + int(fields["Content-Length"])
        if data[close : close + len(BLANK)] != BLANK:
            raise ValueError(f"{name}: the record at byte {at} does not end at byte {close}")
        split = data.find(BLANK, body, close) + len(BLANK)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            size = close - split
            if hashlib.sha1(data[split:close]).hexdigest() != digest:
                raise ValueError(f"{name}: the payload at byte {split} is not the one of its digest")
        else:
            size = int(data[body:split].rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
        number = fields["WARC-Record-ID"][len("<urn:page:") : -1]
        refers = fields.get("WARC-Refers-To")
        yield (
            fields["WARC-URL-Key"], fields["WARC-Date"], None if number == "none" else int(number), kind, digest, size,
            int(refers[len("<urn:page:") : -1]) if refers else None, name, at, close + len(BLANK) - at,
        )
        at = close + len(BLANK)


def order_of(capture: tuple) -> tuple:
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[7], capture[8]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    columns = list(zip(*rows)) if rows else [[]] * len(FIELDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kinds[part.split()[1]]) for values, part in zip(columns, CAPTURES.split(", "))], names=FIELDS
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            yield _batch(sorted(parse(path.as_py().rsplit("/", 1)[-1], content.as_py()), key=order_of))


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the winner goes up and out."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.size = max(1, len(runs))
        self.losers = [-1] * self.size
        self.keys = [order_of(run[0]) if run else None for run in runs]
        for run in range(len(runs)):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return a < 0
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and self.keys[a] is not None
        return self.keys[a] <= self.keys[b]

    def _play(self, run: int) -> None:
        """From a run's leaf up: the loser stays, the winner goes on; an empty place beats all while the tree is filled."""
        winner, node = run, (run + self.size) // 2
        while node > 0:
            if self._beats(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.keys[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.keys[run] = order_of(self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else None
            self._play(run)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: list[list[tuple]] = []
    last = None
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            key = order_of(row)
            if last is None or key < last:
                runs.append([])
            runs[-1].append(row)
            last = key
    out = []
    for row in LoserTree(runs):
        out.append(row)
        if len(out) == 10_000:
            yield _batch(out)
            out = []
    yield _batch(out)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, each archive a sorted run."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0").select("path", "content")
    return files.mapInArrow(_runs, CAPTURES)


def merge_index(runs: DataFrame) -> DataFrame:
    """The captures in global order of URL key, timestamp and id: partitions are ranges, rows sorted within."""
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    return runs.repartitionByRange(ranges, "url_key", "timestamp", "page_id").mapInArrow(_merge, CAPTURES)


def capture_history(pages: DataFrame, **columns) -> DataFrame:
    """Archive the pages in the shared folder, read the archives back and merge their index."""
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_archives(pages, path, **columns)
    return merge_index(stored(read_captures(spark, path), "warc-runs"))
