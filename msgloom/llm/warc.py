"""Web archives: writing, reading back, and one ordered capture history over all of them.

Writing: the task of each partition writes one archive, its records sorted by URL key and
time: a locally sorted run. Reading gives the captures of every archive in its order.
Merging: captures are dealt to tasks by ranges of (URL key, time, page), so that a much
captured URL fills several ranges; each task merges what it has of the k runs with a loser
tree. The ranges in order are the capture history of the whole collection.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, open_folder, stored
from msgloom.session import shared_dir

LEAST_REVISIT = 100  # bytes; equal payloads below that are stored each
EPOCH = "2024-01-01T00:00:00Z"
CAPTURE = pa.schema([("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()),
                     ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("archive", pa.string()),
                     ("run", pa.int64()), ("position", pa.int64()), ("offset", pa.int64()),
                     ("length", pa.int64())])
CAPTURE_SQL = ("url_key string, captured_at string, page_id bigint, url string, record_type string, "
               "payload_digest string, payload_bytes bigint, refers_to bigint, archive string, run bigint, "
               "position bigint, offset bigint, length bigint")  # fmt: skip
ARCHIVES_SQL = "run bigint, archive string, records bigint, size bigint"


def url_key(url: Column) -> Column:
    """The host's labels from the top down, then path and query: pages of a site side by side."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(lower, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(lower, r"(?s)^.*?://[^/?#]*", ""), r"(?s)#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _quoted(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unquoted(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(row: dict) -> bytes:
    """One WARC record. A revisit holds the HTTP head only, with the payload's full length."""
    revisit = row["refers_to"] is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n']}\r\n\r\n"
    block = head.encode() + (b"" if revisit else row["payload"])
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{row['page_id']} {row['url']} {row['digest']}")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {row['captured_at']}",
             f"WARC-Payload-Digest: sha256:{row['digest']}", f"X-URL-Key: {_quoted(row['url_key'])}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_quoted(row['url'])}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [f"X-Refers-To-Page: {row['refers_to']}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The capture in a record; checks the payload against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(http.decode().rsplit("Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload and digest differ")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"url_key": _unquoted(fields["X-URL-Key"]), "captured_at": fields["WARC-Date"],
            "page_id": number("X-Page-ID"), "record_type": kind, "payload_digest": digest,
            "url": _unquoted(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
            "payload_bytes": length, "refers_to": number("X-Refers-To-Page"), "payload": payload}


def _write_run(folder: str):
    def write(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sink, run, records, size = None, TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if sink is None:
                files, top = open_folder(folder)
                files.create_dir(top, recursive=True)
                # Each attempt has a file of its own; the list of archives names the one that counts.
                name = f"run-{run:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
                sink = files.open_output_stream(f"{top}/{name}", compression=None)
            for row in batch.to_pylist():
                # One gzip member per record, so that each can be read by its offset.
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record(row)) + packer.flush()
                sink.write(data)
                records, size = records + 1, size + len(data)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"run": [run], "archive": [f"{folder}/{name}"],
                                              "records": [records], "size": [size]})

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", time_col: str | None = None) -> DataFrame:
    """Write a record per row; returns the archives, one row each.

    A null payload is empty. Of the records with one payload of at least 100 bytes, that
    with the smallest id is the response; the others revisit it, save rows that repeat
    this very id, which are responses too. Null ids revisit like others and are never
    referred to. Without a time column the time is a fixed day plus the id in seconds. An
    empty table writes nothing.
    """
    number = F.col(id_col).cast("long")
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    seconds = F.coalesce(number, F.lit(0)) % (1 << 31)
    time = F.col(time_col) if time_col else F.timestamp_seconds(
        F.unix_timestamp(F.lit(EPOCH), "yyyy-MM-dd'T'HH:mm:ssX") + seconds)
    stamp = F.coalesce(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(EPOCH))
    rows = pages.select(
        number.alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        stamp.alias("captured_at"), url_key(F.col(url_col).cast("string")).alias("url_key"),
    ).withColumns({"digest": F.sha2("payload", 256), "n": F.octet_length("payload").cast("long")})
    firsts = (
        rows.filter(F.col("n") >= LEAST_REVISIT)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1").select("digest", "first")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(firsts, "digest", "left").withColumn("refers_to", F.when(other, F.col("first")))
    runs = joined.drop("first").sortWithinPartitions("url_key", "captured_at", "page_id")
    return stored(runs.mapInArrow(_write_run(folder), ARCHIVES_SQL), "archives")


def records_of(uri: str, block: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """Offset, stored length and content of each record of an archive, one at a time."""
    files, path = open_folder(uri)
    with files.open_input_file(path) as source:
        at, start, data = 0, 0, b""
        parts, unpacker = [], zlib.decompressobj(31)
        while data or (data := source.read(block)):
            parts.append(unpacker.decompress(data))
            if unpacker.eof:
                at += len(data) - len(unpacker.unused_data)
                yield start, at - start, b"".join(parts)
                data, start = unpacker.unused_data, at
                parts, unpacker = [], zlib.decompressobj(31)
            else:
                at, data = at + len(data), b""
        if parts:
            raise ValueError(f"archive ends inside a record: {uri}")


def read_record(uri: str, offset: int, length: int) -> dict:
    """One record by its place in an archive."""
    files, path = open_folder(uri)
    with files.open_input_file(path) as source:
        source.seek(offset)
        return parsed(zlib.decompress(source.read(length), 31))


def _read_runs(batches: Batches) -> Iterator[pa.RecordBatch]:
    out = Rows(CAPTURE)
    for batch in batches:
        for run, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for position, (offset, length, data) in enumerate(records_of(uri)):
                row = parsed(data) | {"archive": uri, "run": run, "position": position, "offset": offset,
                                      "length": length}
                out.add(*(row[name] for name in CAPTURE.names))
                yield from out.ready()
    yield from out.rest()


def read_archives(archives: DataFrame) -> DataFrame:
    """The captures of all archives, each archive in its order."""
    tasks = max(1, archives.count())  # a task for each archive, however few bytes its name has
    return archives.select("run", "archive").repartition(tasks, "archive").mapInArrow(_read_runs, CAPTURE_SQL)


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the top the winner."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.heads, self.k = runs, [0] * len(runs), len(runs)
        self.tree = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._play(leaf)

    def _less(self, a: int, b: int) -> bool:
        """Whether list a's head comes before b's; an ended list comes last."""
        if self.heads[a] >= len(self.runs[a]):
            return False
        if self.heads[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.heads[a]], self.runs[b][self.heads[b]]
        return x < y or (x == y and a < b)

    def _play(self, leaf: int) -> None:
        """Carry a list from its leaf to the top; the first to reach an empty node waits there."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            winner = self.tree[0]
            if self.heads[winner] >= len(self.runs[winner]):
                return
            yield self.runs[winner][self.heads[winner]]
            self.heads[winner] += 1
            self._play(winner)


def _merge(batches: Batches) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), schema=CAPTURE)
    keys = zip(*(table.column(c).to_pylist() for c in ("url_key", "captured_at", "page_id", "run", "position")))
    runs: dict[int, list[tuple]] = {}
    for row, (key, time, page, run, position) in enumerate(keys):
        runs.setdefault(run, []).append((position, (key, time, page is not None, page or 0), row))
    # What arrives of a run may be in pieces; its own positions give their order.
    lists = [[(k, run, p, row) for p, k, row in sorted(rows)] for run, rows in sorted(runs.items())]
    order = [row for *_, row in LoserTree(lists)]
    for at in range(0, len(order), 10_000):
        yield from table.take(pa.array(order[at : at + 10_000], pa.int64())).combine_chunks().to_batches()


def merge_captures(captures: DataFrame, rows_per_task: int = 100_000) -> DataFrame:
    """All captures, ordered by URL key, time and page within and across partitions.

    A task holds about ``rows_per_task`` narrow rows, without their payloads.
    """
    kept = stored(captures, "captures")  # the ranges are sampled from it
    tasks = max(1, -(-kept.count() // rows_per_task))
    order = ("url_key", "captured_at", F.col("page_id").asc_nulls_first(), "run", "position")
    return kept.repartitionByRange(tasks, *order).mapInArrow(_merge, CAPTURE_SQL)


def round_trip(pages: DataFrame, **settings: object) -> DataFrame:
    """Write ``pages`` to a fresh folder, read the archives back and merge their captures."""
    folder = shared_dir(pages.sparkSession, "warc")
    return merge_captures(read_archives(write_archives(pages, folder, **settings)))
