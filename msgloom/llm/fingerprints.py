"""Document fingerprints from improbable features.

Every 64 bytes of a text are a window, and the entropy of its bytes has one of 1001 levels.
Over all documents the levels are counted; a window is the more improbable the rarer its
level. Among each 64 neighbouring windows the most improbable one (of equals the first) gets
a point, and windows with 16 points and more (or, in a text with fewer neighbourhoods, as
many as it has) are the text's features. Features go in order
into Bloom filters of 2048 bits, five bits each, a new filter after every 160: the chain is
the fingerprint. Two fingerprints are compared by the bits that their filters share, less
those that chance would make them share, scaled to 0 … 1.

Tasks count entropies in numpy over many texts at a time; the counts of the levels are one
row of fixed size for each task. Nothing else is gathered, and fingerprints are made where
the text is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, packed_texts, stored, text_or_empty
from msgloom.llm.hashing import sliding_min

WINDOW = 64  # bytes
LEVELS = 1001
NEIGHBOURS = 64
POINTS = 16
FILTER_BITS = 2048
BITS_PER_FEATURE = 5
FEATURES_PER_FILTER = 160
# Overlap under this share of the way from chance to all counts as none.
CHANCE_SHARE = 0.3
# Texts are worked on together up to so many bytes, one longer text alone.
TOGETHER = 1 << 18
AT_ONCE = 1 << 16
# Texts under this many bytes have too few windows to choose from; all their smaller windows count.
SHORT, SHORT_WINDOW = 2 * WINDOW, 16

# c * log2(c) for a byte that stands c times in a window, in whole numbers.
_UNIT = 1 << 20
_COUNTS = np.arange(WINDOW + 1)
_PARTS = np.round(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * _UNIT).astype(np.int64)
_STEP = np.diff(_PARTS)  # what one more of a byte adds, from c to c + 1
_MOST = int(_PARTS[WINDOW])  # all bytes equal
_BIT = np.arange(BITS_PER_FEATURE, dtype=np.uint64) * np.uint64(11)


def levels(data: np.ndarray) -> np.ndarray:
    """The entropy level, 0 … 1000, of each window of ``data`` (bytes).

    From one window to the next one byte leaves and one comes; how often each of them stands
    in the window is found for all positions at once, one distance at a time.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    if len(data) > AT_ONCE:  # in pieces that stay in the processor's cache
        step = AT_ONCE - WINDOW + 1
        return np.concatenate([levels(data[a : a + AT_ONCE]) for a in range(0, n, step)])
    same_ahead = np.zeros(len(data), np.uint8)  # equal bytes among the next 63
    same_before = np.zeros(len(data), np.uint8)
    held = np.empty(len(data), bool)
    for away in range(1, WINDOW):
        same = np.equal(data[:-away], data[away:], out=held[away:]).view(np.uint8)
        np.add(same_ahead[:-away], same, out=same_ahead[:-away])
        np.add(same_before[away:], same, out=same_before[away:])
    sums = np.empty(n, np.int64)
    sums[0] = _PARTS[np.bincount(data[:WINDOW], minlength=256)].sum()
    if n > 1:
        # The leaving byte stands 1 + same_ahead times in its window, the coming one same_before
        # times in what is left.
        change = _STEP[same_before[WINDOW:]] - _STEP[same_ahead[: n - 1]]
        sums[1:] = sums[0] + np.cumsum(change)
    return ((_MOST - sums) * (LEVELS - 1) // _MOST).astype(np.int32)


def _laid_out(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], ends])


def _inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` that lie within one part."""
    sizes = np.maximum(np.diff(bounds) - size + 1, 0)
    first = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return first + np.arange(sizes.sum())


def together(sizes: list[int], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if sizes:
        yield start, len(sizes)


def rarity(docs: DataFrame, text_col: str = "text") -> list[int]:
    """For each entropy level its place, 0 for the rarest, over every window of all texts."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(LEVELS, np.int64)
        for batch in batches:
            texts = [t.encode() for t in batch.column(0).to_pylist()]
            for a, b in together([len(t) for t in texts]):
                data, bounds = _laid_out(texts[a:b])
                found = levels(data)
                seen += np.bincount(found[_inside(bounds, WINDOW)], minlength=LEVELS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"level": pa.array(at, pa.int32()), "n": pa.array(seen[at], pa.int64())})

    texts = docs.select(text_or_empty(text_col).alias("text"))
    counted = texts.mapInArrow(count, "level int, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS, np.int64)
    for row in counted.collect():  # one row for each level
        counts[row["level"]] = row["n"]
    places = np.empty(LEVELS, np.int64)
    places[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    return places.tolist()


def features(parts: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of texts: which text each is of, in order, and its hash; no two alike in a text."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    sizes = np.array([len(p) for p in parts], np.int64)
    long = np.flatnonzero(sizes >= SHORT)
    data, bounds = _laid_out([parts[i] for i in long])
    at, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(long):
        starts = _inside(bounds, WINDOW)
        # Rarity first, then position: the first of equals has the least key.
        keys = (places[levels(data)[starts]] << 40) | starts
        windows = np.diff(bounds) - WINDOW + 1
        edges = np.concatenate([[0], np.cumsum(windows)])
        best = sliding_min(keys, NEIGHBOURS)[_inside(edges, NEIGHBOURS)] & ((1 << 40) - 1)
        at, points = np.unique(best, return_counts=True)
        owner = np.searchsorted(bounds, at, "right") - 1
        # A text with few windows cannot give many points.
        enough = points >= np.minimum(POINTS, windows[owner] - NEIGHBOURS + 1)
        at, owner = at[enough], long[owner[enough]]
    raw = data.tobytes()
    hashes, owners = [digest(raw[p : p + WINDOW]) for p in at.tolist()], owner.tolist()
    for i in np.flatnonzero((sizes > 0) & (sizes < SHORT)).tolist():
        made = [digest(parts[i][a : a + SHORT_WINDOW]) for a in range(max(1, sizes[i] - SHORT_WINDOW + 1))]
        hashes, owners = hashes + made, owners + [i] * len(made)
    # Of features that are alike in a text the first counts.
    hashes, owner = np.array(hashes, np.uint64), np.array(owners, np.int64)
    by = np.lexsort((np.arange(len(owner)), hashes, owner))
    new = np.ones(len(by), bool)
    new[1:] = (owner[by][1:] != owner[by][:-1]) | (hashes[by][1:] != hashes[by][:-1])
    keep = np.sort(by[new])
    keep = keep[np.argsort(owner[keep], kind="stable")]
    return owner[keep], hashes[keep]


def chains(parts: list[bytes], places: np.ndarray) -> list[np.ndarray]:
    """For each text its Bloom filters: rows of packed bits. An empty text has none."""
    owner, hashes = features(parts, places)
    counts = np.bincount(owner, minlength=len(parts))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    filters = -(-counts // FEATURES_PER_FILTER)
    base = np.cumsum(filters) - filters
    which = base[owner] + nth // FEATURES_PER_FILTER
    bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
    at = (hashes[:, None] >> _BIT) & np.uint64(FILTER_BITS - 1)
    bits[which[:, None], at.astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return np.split(packed, np.cumsum(filters)[:-1]) if parts else []


def fingerprint_of(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def chain_of(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, FILTER_BITS // 8)


def _best(some: np.ndarray, others: np.ndarray) -> float:
    """How well each of some filters is found among others, weighed by its bits."""
    theirs = np.unpackbits(others, axis=1).astype(np.float32)
    their_bits, found, weight = theirs.sum(axis=1), 0.0, 0.0
    for a in range(0, len(some), 512):
        ours = np.unpackbits(some[a : a + 512], axis=1).astype(np.float32)
        bits = ours.sum(axis=1)
        best = np.zeros(len(ours))
        for b in range(0, len(theirs), 4096):
            shared = ours @ theirs[b : b + 4096].T
            most = np.minimum(bits[:, None], their_bits[None, b : b + 4096])
            chance = bits[:, None] * their_bits[None, b : b + 4096] / FILTER_BITS
            floor = chance + CHANCE_SHARE * (most - chance)
            best = np.maximum(best, ((shared - floor) / (most - floor)).max(axis=1))
        found, weight = found + float(best @ bits), weight + float(bits.sum())
    return found / weight


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Likeness of two fingerprints, 0 … 1, whichever comes first; that of equal ones is 1."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    if one.shape == other.shape and (one == other).all():
        return 1.0
    if len(one) == len(other):
        return (_best(one, other) + _best(other, one)) / 2
    return _best(*sorted((one, other), key=len))


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])
DIGEST_SQL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")  # fmt: skip


# The end of a task: its number, its first text and, under its id, its last one.
ENDS_SQL = f"{DIGEST_SQL}, part int, first binary, last binary"
ENDS = pa.schema([*DIGEST, ("part", pa.int32()), ("first", pa.binary()), ("last", pa.binary())])


def edited(text: str, following: str) -> str:
    """The text, its last quarter replaced by as much of the start of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


class _Pairs:
    """Digests of texts and the texts after them, many at a time."""

    def __init__(self, places: list[int], schema: pa.Schema = DIGEST):
        self.places, self.out = np.array(places, np.int64), Rows(schema)
        self.blank = [None] * (len(schema) - len(DIGEST))

    def add(self, keys: list, texts: list[str], following: list[str], chains_: list, chains_after: list) -> None:
        changed = [edited(t, f) for t, f in zip(texts, following)]
        raw = [t.encode() for t in changed]
        made = chains(raw, self.places)
        for key, text, data, own, new, after in zip(keys, texts, raw, chains_, made, chains_after):
            row = (key, len(text), hashlib.sha256(data).hexdigest(), fingerprint_of(own), fingerprint_of(new),
                   likeness(own, new), likeness(own, after))
            self.out.add(*row, *self.blank, weight=len(row[3]) + len(row[4]))


def _unpacked(packed: list[bytes]) -> list[str]:
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    return [expand(p).decode() for p in packed]


def _in_order(places: list[int]):
    """Digests of all rows of a sorted task but its last, whose next text is elsewhere."""

    def digest(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        work, held, first, last = _Pairs(places, ENDS), None, None, None
        for batch in batches:
            ids, packed = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if packed:
                first, last = first or packed[0], packed[-1]
            for a in range(0, len(ids), 64):
                some = _unpacked(packed[a : a + 64])
                for b, c in together([len(t) for t in some]):
                    keys, texts = ids[a + b : a + c], some[b:c]
                    made = chains([t.encode() for t in texts], work.places)
                    if held:
                        keys, texts, made = [held[0], *keys], [held[1], *texts], [held[2], *made]
                    held = (keys[-1], texts[-1], made[-1])
                    if len(keys) > 1:
                        work.add(keys[:-1], texts[:-1], texts[1:], made[:-1], made[1:])
                        yield from work.out.ready()
        if held:
            work.out.add(held[0], *[None] * (len(DIGEST) - 1), TaskContext.get().partitionId(), first, last)
        yield from work.out.rest()

    return digest


def _at_ends(places: list[int]):
    def digest(batches: Batches) -> Iterator[pa.RecordBatch]:
        work = _Pairs(places)
        for batch in batches:
            for key, last, first in zip(*(c.to_pylist() for c in batch.columns)):
                text, after = _unpacked([last, first])
                own, then = chains([text.encode(), after.encode()], work.places)
                work.add([key], [text], [after], [own], [then])
                yield from work.out.ready()
        yield from work.out.rest()

    return digest


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint, its edited text's, and how alike it is to that and to the next text.

    The edited text has its last quarter (of code points) replaced by the start of the next
    text, or all of it. Next is the row with the next id, null ids first, rows of one id by
    the hash of their text; the last row's next is the first. A null text is empty; an empty
    text has an empty fingerprint, which is like another empty one (1) and like no other (0).
    Texts of fewer than 128 bytes have all their windows of 16 bytes as features. Repeated rows each have a row; no other
    column is read; an empty table gives no row.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    places = rarity(rows)
    # Rows of one id, however many, are spread by their text and, if that is the same, by where
    # they come from; which of equal rows comes first makes no difference.
    spread = rows.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("m"), "text")
    packed = spread.mapInArrow(packed_texts(), "doc_id bigint, h bigint, m bigint, packed binary")
    order = [F.asc_nulls_first("doc_id"), F.asc("h"), F.asc("m")]
    parts = max(1, rows.rdd.getNumPartitions())
    in_order = packed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "packed")
    made = stored(in_order.mapInArrow(_in_order(places), ENDS_SQL), "fingerprints")
    # One row for each task: its last row goes with the first text of the next task.
    ends = made.filter("part is not null").select("part", "doc_id", "first", "last")
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    pairs = ends.select("part", after.alias("after")).join(ends.select("part", "doc_id", "last"), "part")
    met = pairs.join(ends.select(F.col("part").alias("after"), "first"), "after").select("doc_id", "last", "first")
    inner = made.filter("part is null").select(*DIGEST.names)
    return inner.unionByName(met.mapInArrow(_at_ends(places), DIGEST_SQL))
