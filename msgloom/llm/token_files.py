"""Token ids in binary shards with keyed access through a minimal perfect hash.

A shard holds the packed ids of a range of keys, in ascending key order, then its index::

    "TOKSHRD1" | ids | keys | validity | starts | levels | fingerprints | rows | footer (JSON)
               | footer length (4 bytes) | "TOKSHRD1"

The index places each distinct key in a slot of its own: keys are hashed into a bit table,
those alone in their place stay, the others go on to the next, smaller table; a key's slot
is the number of set bits before its own. A slot stores a fingerprint, so that a key that
was never written is found out, and the first row of its key. Finding a key costs a few
hashes and no search. Shards of a table are listed in its manifest, one row each.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, open_folder, stored, text_or_empty
from msgloom.llm.encoders import encoder, id_kind, slices
from msgloom.session import shared_dir

MAGIC = b"TOKSHRD1"
ROOM = 2  # places in a level for each key that is left
MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_rows", pa.int64()),
                      ("n_tokens", pa.int64()), ("lowest", pa.int64()), ("highest", pa.int64())])
MANIFEST_SQL = "shard bigint, path string, n_rows bigint, n_tokens bigint, lowest bigint, highest bigint"
FOUND = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])
FOUND_SQL = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits for each key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 … n-1 for n distinct keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray, prints: np.ndarray):
        self.sizes, self.bits, self.prints = sizes, bits, prints
        self.before = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, tables = np.arange(len(keys)), [], []
        while len(left):
            size = max(2, ROOM * len(left))
            places = (mixed(keys[left], len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            tables.append(alone)
            left = left[~alone[places]]
        made = cls(sizes, np.concatenate(tables) if tables else np.zeros(0, bool), np.zeros(len(keys), "<u4"))
        made.prints[made._slots(keys)] = mixed(keys, 0).astype("<u4")
        return made

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            places = base + (mixed(keys[left], level + 1) % np.uint64(size)).astype(np.int64)
            here = self.bits[places]
            slots[left[here]] = self.before[places[here]]
            left, base = left[~here], base + size
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not stored."""
        slots = self._slots(keys)
        known = slots >= 0
        wrong = self.prints[slots[known]] != mixed(keys[known], 0).astype("<u4")
        slots[np.flatnonzero(known)[wrong]] = -1
        return slots


def _write_shards(folder: str, vocab: str, end_id: int, kind: str):
    def write(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        enc, sink = encoder(vocab, kind), None
        end, width = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize
        keys, valid, sizes = [], [], []
        for batch in batches:
            if sink is None:
                files, top = open_folder(folder)
                files.create_dir(top, recursive=True)
                # Each attempt writes a file of its own; the manifest names the one that counts.
                path = f"{top}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}.bin"
                sink = files.open_output_stream(path)
                sink.write(MAGIC)
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                for packed in enc.many(texts[a:b]):
                    sink.write(packed + end)
                    sizes.append(len(packed) // width + 1)
            keys += [i or 0 for i in ids]
            valid += [i is not None for i in ids]
        if sink is None:
            return
        with sink:
            n_tokens = _write_index(sink, keys, valid, sizes, kind)
        known = [k for k, v in zip(keys, valid) if v]
        name = f"{folder}/{path.rsplit('/', 1)[1]}"
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": name, "n_rows": len(keys), "n_tokens": n_tokens,
              "lowest": known[0] if known else None, "highest": known[-1] if known else None}],
            schema=MANIFEST,
        )

    return write


def _write_index(sink, keys: list, valid: list, sizes: list, kind: str) -> int:
    key, ok = np.array(keys, "<i8"), np.array(valid, np.uint8)
    starts = np.concatenate([[0], np.cumsum(np.array(sizes, "<i8"))]).astype("<i8")
    distinct, first = np.unique(key[ok == 1], return_index=True)
    first = first + np.flatnonzero(ok == 1)[:1].sum()
    index = PerfectHash.build(distinct)
    rows = np.zeros(len(distinct), "<i8")
    rows[index._slots(distinct)] = first
    parts = {"keys": key, "valid": ok, "starts": starts, "bits": np.packbits(index.bits),
             "prints": index.prints, "rows": rows}
    at, places = len(MAGIC) + int(starts[-1]) * np.dtype(kind).itemsize, {}
    for name, part in parts.items():
        data = part.tobytes()
        sink.write(data)
        places[name], at = [at, len(data), part.dtype.str], at + len(data)
    footer = json.dumps({"ids": kind, "levels": index.sizes, "places": places}).encode()
    sink.write(footer + len(footer).to_bytes(4, "little") + MAGIC)
    return int(starts[-1])


class Shard:
    """One shard file: its index in memory, its ids read where they are asked for."""

    def __init__(self, uri: str):
        files, path = open_folder(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = self._at(size - len(MAGIC) - 4, len(MAGIC) + 4)
        if tail[4:] != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"no token shard: {uri}")
        length = int.from_bytes(tail[:4], "little")
        footer = json.loads(self._at(size - len(tail) - length, length))
        self.kind = np.dtype(footer["ids"])
        part = {n: np.frombuffer(self._at(a, b), kind) for n, (a, b, kind) in footer["places"].items()}
        self.keys, self.valid, self.starts, self.rows = (part[n] for n in ("keys", "valid", "starts", "rows"))
        bits = np.unpackbits(part["bits"])[: sum(footer["levels"])].astype(bool)
        self.index = PerfectHash(footer["levels"], bits, part["prints"])

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def rows_of(self, keys: np.ndarray) -> list[range]:
        """For each key the rows that hold it, none if it was not written."""
        slots = self.index.slots(keys)
        out = []
        for key, slot in zip(keys.tolist(), slots.tolist()):
            first = int(self.rows[slot]) if slot >= 0 else 0
            if slot < 0 or self.keys[first] != key:
                out.append(range(0))
                continue
            after = first + 1
            while after < len(self.keys) and self.keys[after] == key:
                after += 1
            out.append(range(first, after))
        return out

    def ids(self, row: int) -> np.ndarray:
        start, end = int(self.starts[row]), int(self.starts[row + 1])
        data = self._at(len(MAGIC) + start * self.kind.itemsize, (end - start) * self.kind.itemsize)
        return np.frombuffer(data, self.kind).astype("<u4")


def write_token_files(docs: DataFrame, folder: str, vocab: str = "word_bpe_49k.json", end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as shards in key order; returns the manifest, one row per shard.

    The id ``end_id`` follows each document. Null texts are empty; rows with a null key come
    first and are reached by position only; repeated keys stand side by side and are all
    found. Ties of one key are spread by their text, so that a frequent key fills several
    shards. An empty table gives an empty manifest. Files of attempts that failed may
    remain in the folder; no manifest names them.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    spread = F.xxhash64("text")
    ordered = (
        rows.repartitionByRange("doc_id", spread)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), spread)
    )
    kind = id_kind(vocab)
    if end_id >= 1 << 8 * np.dtype(kind).itemsize:
        kind = "<u4"
    return stored(ordered.mapInArrow(_write_shards(folder, vocab, end_id, kind), MANIFEST_SQL),
                  "token-manifest")


def _read_shards(batches: Batches) -> Iterator[pa.RecordBatch]:
    out = Rows(FOUND)
    for batch in batches:
        for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = Shard(uri)
            nulls = np.flatnonzero(shard.valid == 0)
            known = np.unique(shard.keys[shard.valid == 1])
            for key, rows in [(None, nulls), *zip(known.tolist(), shard.rows_of(known))]:
                for row in rows:
                    ids = shard.ids(int(row))
                    out.add(key, base + int(shard.starts[row]), len(ids), zlib.crc32(ids.tobytes()))
                yield from out.ready()
    yield from out.rest()


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, read by its key."""
    # One row per shard: the window sums few numbers.
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("path", F.coalesce(before, F.lit(0)).alias("base"))
    tasks = max(1, shards.count())  # a task for each shard, however few bytes its name has
    return shards.repartition(tasks, "path").mapInArrow(_read_shards, FOUND_SQL)


def _shards_of(bounds: list[tuple[int, int, str]]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """A map from keys to the shards whose range holds them, by binary search.

    Shards are cut by ranges of the key, so that both their ends rise from shard to shard; a key
    at which two shards touch goes to both.
    """
    lowest = np.array([low for low, _, _ in bounds], np.int64)
    highest = np.array([high for _, high, _ in bounds], np.int64)
    paths = pa.array([path for *_, path in bounds], pa.string())

    def assign(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            first = np.searchsorted(highest, keys, "left")
            count = np.maximum(np.searchsorted(lowest, keys, "right") - first, 0)
            held = np.repeat(keys, count)
            place = np.arange(len(held)) - np.repeat(np.cumsum(count) - count, count)
            shard = pa.array(np.repeat(first, count) + place)
            yield pa.record_batch([paths.take(shard), pa.array(held, pa.int64())], names=["path", "key"])

    return assign


def lookup(manifest: DataFrame, wanted: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """doc_id and ids (array) of the wanted keys; keys that were never written give no row.

    The manifest's ranges, one row for each shard, come to the driver and go to the tasks, which
    find a key's shard by binary search; only pairs of shard and key are shuffled.
    """

    def find(batches: Batches) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
        out, uri, shard = Rows(schema), None, None
        for batch in batches:
            for path, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != uri:
                    uri, shard = path, Shard(path)
                for row in shard.rows_of(np.array([key], np.int64))[0]:
                    ids = shard.ids(row).tolist()
                    out.add(key, ids, weight=8 * len(ids))
                yield from out.ready()
        yield from out.rest()

    keys = wanted.select(F.col(key_col).cast("long").alias("key")).dropna().distinct()
    ranges = manifest.select("lowest", "highest", "path").dropna()
    bounds = sorted((tuple(row) for row in ranges.collect()), key=lambda b: b[:2])
    hits = keys.mapInArrow(_shards_of(bounds), "path string, key bigint")
    return (hits.repartition("path").sortWithinPartitions("path", "key")
            .mapInArrow(find, "doc_id bigint, ids array<bigint>"))


def token_files(docs: DataFrame, **settings: object) -> DataFrame:
    """Write ``docs`` to a fresh folder and read every document back."""
    folder = shared_dir(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, **settings))
