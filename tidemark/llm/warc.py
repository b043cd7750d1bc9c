"""WARC archives: pages written as records, read back, and indexed in global order.

Each task writes archives of bounded size to the shared folder; records with a
payload written already are revisits. Reading an archive gives a run of captures,
sorted by URL key and time. Runs are dealt into ranges of keys, and in each range
a loser tree merges them, so that the ranges together hold all capture histories
in order.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_run_folder

#: Bytes after which a task begins another archive.
ARCHIVE_BYTES = 32 << 20
#: Bytes of archives that a task reads, one archive after the other.
READ_BYTES = 256 << 20
#: Captures in a range of the global order; its task holds about so many at once.
RANGE_CAPTURES = 50_000
LEVEL = 3
#: Captures without a time of their own get this one and a second for each id.
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=UTC)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ENTRY = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, urlkey string, captured_at string, run string, offset long, length long"
)


def url_key(url: str) -> str:
    """Host labels in reverse, then what follows the host; in lower case."""
    rest = url.lower().split("://", 1)[-1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut], rest[cut:].split("#", 1)[0]
    return ",".join(reversed(host.split("."))) + ")" + (path or "/")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def _capture_time(page_id: int | None) -> str:
    seconds = (page_id or 0) % (10 * 365 * 86400)
    return (FIRST_CAPTURE + timedelta(seconds=seconds)).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id: int | None, url: str, payload: bytes, revisit_of: int | None, is_revisit: bool) -> bytes:
    """A record of a page: its HTTP response, or a revisit of an equal one without a payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    target = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {_capture_time(page_id)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        head[6:6] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(revisit_of)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """A record's named fields, the length its payload has in full, and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    sizes = [int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")]
    return fields, sizes[0], payload


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and contents of each gzip member."""
    at = 0
    while at < len(data):
        stream = zlib.decompressobj(31)
        body = [stream.decompress(data[at : at + (1 << 16)])]
        end = min(len(data), at + (1 << 16))
        while not stream.eof and end < len(data):
            body.append(stream.decompress(data[end : end + (1 << 20)]))
            end = min(len(data), end + (1 << 20))
        if not stream.eof:
            raise ValueError(f"archive ends within the record at {at}")
        end -= len(stream.unused_data)
        yield at, end - at, b"".join(body)
        at = end


def write_archives(pages: DataFrame, folder: str, id_col: str, url: str, html: str) -> DataFrame:
    """Writes all pages as records; ``run`` and ``size``, path and bytes of each archive, are returned.

    Of equal payloads that with the largest id is a response and the others revisit
    it; a null payload is empty, a null URL too. Rows with the largest id repeated
    are all responses; payloads whose rows all lack an id too. Archives of tasks that
    were run again are not returned, so readers do not see them.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    heads = (
        rows.groupBy("digest")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("copies"))
        .filter("copies > 1 AND head IS NOT NULL")
        .select("digest", "head")
    )
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    records = rows.join(heads, "digest", "left").select(
        "page_id", "url", "payload", "head", revisit.alias("is_revisit")
    )
    filesystem, path = filesystem_path(folder)
    filesystem.create_dir(path, recursive=True)

    def listed(path: str, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size])], names=["run", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = filesystem_path(folder)
        archive, size = None, 0
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for page_id, target, text, head, is_revisit in zip(*columns):
                if archive is None or size >= ARCHIVE_BYTES:
                    if archive is not None:
                        archive.close()
                        yield listed(path, size)
                    path, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    archive = filesystem.open_output_stream(path, compression=None)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                raw = record(page_id, target, text.encode(), head, is_revisit)
                archive.write(packer.compress(raw) + packer.flush())
                size = archive.tell()
        if archive is not None:
            archive.close()
            yield listed(path, size)

    return records.mapInArrow(run, "run string, size long")


def filesystem_path(folder: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(folder)


def read_archives(runs: DataFrame, folder: str) -> DataFrame:
    """The index entries of all records, each archive's sorted by URL key and time.

    Digests of payloads are checked; a record that differs from its digest, or an
    archive cut short, fails the job.
    """
    names = [c.split()[0] for c in _ENTRY.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _ENTRY.split(", ")])

    def entries(path: str, data: bytes) -> Iterator[tuple]:
        for offset, length, raw in _members(data):
            fields, size, payload = parse(raw)
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = fields["WARC-Type"]
            if kind == "response":
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if found != digest or len(payload) != size:
                    raise ValueError(f"{path}: the record at {offset} is damaged")
            refers = _page_id(fields["WARC-Refers-To"]) if kind == "revisit" else None
            yield (
                _page_id(fields["WARC-Record-ID"]), size, digest, kind, refers,
                url_key(fields["WARC-Target-URI"]), fields["WARC-Date"], path, offset, length,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = filesystem_path(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with filesystem.open_input_stream(path, compression=None) as archive:
                    found = sorted(entries(path, archive.read()), key=_order)
                columns = [pa.array(c, t) for c, t in zip(zip(*found), schema.types)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # rows here are small, but what they name is not: tasks by the bytes of their archives,
    # ranges of the random names, so that each has about as many
    listed, total = runs.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    spread = min(listed, runs.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, spread, -(-total // READ_BYTES))
    return runs.repartitionByRange(tasks, "run").select("run").mapInArrow(run, _ENTRY)


def _order(entry: tuple) -> tuple:
    return entry[5], entry[6], -1 if entry[0] is None else entry[0]


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, the
    winner goes up, and after a step only the path of the last winner is replayed."""

    def __init__(self, runs: list[Iterator[tuple]]) -> None:
        self.runs = runs
        self.heads = [self._next(i) for i in range(len(runs))]
        self.losers = [-1] * len(runs)
        self.winner = 0
        for i in range(len(runs)):
            self._replay(i)

    def _next(self, run: int) -> tuple | None:
        entry = next(self.runs[run], None)
        return None if entry is None else (_order(entry), entry)

    def _loses(self, a: int, b: int) -> bool:
        """Whether run a comes after run b; a run at its end comes last, equals by number."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is None
        return (x[0], a) > (y[0], b)

    def _replay(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # while the tree fills: wait for an opponent
                self.losers[node] = run
                return
            if self._loses(run, other):
                self.losers[node], run = run, other
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run][1]
            self.heads[run] = self._next(run)
            self._replay(run)


def merge_runs(entries: DataFrame) -> DataFrame:
    """All entries in order of URL key, time and id, from runs that are each sorted.

    Partitions are ranges of that order, also within one URL, so a page captured
    very often is spread. Each gets its slices of all runs and merges them. Their
    number follows from the number of captures, so that a task's slices are bounded.
    """
    keys = ["urlkey", "captured_at", "page_id"]
    names = entries.columns
    at = names.index("run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[pa.RecordBatch]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            column = batch.column(at).to_pylist()
            first = 0
            for i in range(1, len(column) + 1):
                if i == len(column) or column[i] != column[first]:
                    slices.setdefault(column[first], []).append(batch.slice(first, i - first))
                    first = i

        def rows(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
            for part in parts:
                yield from zip(*(c.to_pylist() for c in part.columns))

        out: list[tuple] = []
        for entry in LoserTree([rows(parts) for parts in slices.values()]):
            out.append(entry)
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], names=names)

    ranges = max(1, -(-entries.count() // RANGE_CAPTURES))
    ranged = entries.repartitionByRange(ranges, *keys).sortWithinPartitions("run", *keys)
    return ranged.mapInArrow(run, entries.schema)


def capture_histories(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Index entries of all pages, written to archives and read back, in global order.

    Archives and the list of them go to the shared folder, and so do the runs.
    """
    spark = pages.sparkSession
    folder = new_run_folder(spark, "warc")
    archives = f"{folder}/archives"
    write_archives(pages, archives, id_col, url, html).write.parquet(f"{folder}/list")
    runs = read_archives(spark.read.parquet(f"{folder}/list"), archives)
    runs.write.parquet(f"{folder}/runs")
    return merge_runs(spark.read.parquet(f"{folder}/runs"))
