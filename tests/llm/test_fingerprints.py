"""Fingerprints against a plain count of every window, and what their likeness should say."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np

from msgloom.llm import fingerprints as fp

WORDS = [f"{a}{b}" for a in ("lor", "ip", "do", "sit", "am", "con") for b in ("em", "sum", "lor", "et", "us")]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choices(WORDS, k=n))


def level(window):
    parts = [round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values()]
    most = round(64 * 6 * (1 << 20))
    return (most - sum(parts)) * 1000 // most


def chain_by_hand(data, places):
    """Features and filters of one text, window by window."""
    import xxhash

    if len(data) < 128:
        found = [data[i : i + 16] for i in range(max(1, len(data) - 15))] if data else []
    else:
        ranks = [places[level(data[i : i + 64])] for i in range(len(data) - 63)]
        points = Counter()
        for i in range(len(ranks) - 63):
            points[min(range(i, i + 64), key=lambda j: (ranks[j], j))] += 1
        least = min(16, len(ranks) - 63)
        found = [data[i : i + 64] for i in sorted(points) if points[i] >= least]
    hashes = list(dict.fromkeys(xxhash.xxh3_64_intdigest(f) for f in found))
    filters = []
    for i in range(0, len(hashes), 160):
        bits = np.zeros(2048, bool)
        for h in hashes[i : i + 160]:
            bits[[h >> 11 * k & 2047 for k in range(5)]] = True
        filters.append(np.packbits(bits))
    return np.array(filters, np.uint8).reshape(-1, 256)


def test_levels_of_all_windows(monkeypatch):
    rng = np.random.default_rng(1)
    for at_once in (100, 1 << 16):
        monkeypatch.setattr(fp, "AT_ONCE", at_once)
        for n in (0, 63, 64, 65, 700):
            data = rng.integers(97, 97 + rng.integers(1, 25), n).astype(np.uint8)
            want = [level(data[i : i + 64].tolist()) for i in range(n - 63)]
            assert fp.levels(data).tolist() == want


def test_chains_of_many_texts():
    places = np.random.default_rng(2).permutation(fp.LEVELS)
    given = ["", "a", "x" * 15, "y" * 40, "z" * 127, "q" * 500, prose(1, 20), prose(2, 400), prose(3, 3000),
             prose(4, 14) * 30, "漢字かな" * 60]
    raw = [t.encode() for t in given]
    for got, data in zip(fp.chains(raw, places), raw):
        assert got.tolist() == chain_by_hand(data, places).tolist()
        assert fp.chain_of(fp.fingerprint_of(got)).tolist() == got.tolist()


def test_likeness():
    places = np.arange(fp.LEVELS)
    one, other = prose(5, 2000), prose(6, 2000)
    made = fp.chains([t.encode() for t in (one, other, one[: len(one) * 3 // 4] + other, one + " " + other, "", "")], places)
    a, b, mixed, both, none, empty = made
    assert fp.likeness(a, a) == 1 and fp.likeness(none, empty) == 1 and fp.likeness(a, none) == 0
    assert fp.likeness(a, b) < 0.1 < 0.5 < fp.likeness(a, mixed) < 1 and fp.likeness(a, both) > 0.5
    assert fp.likeness(a, both) == fp.likeness(both, a) and fp.likeness(a, mixed) == fp.likeness(mixed, a)


def rows_of(spark):
    rnd = random.Random(7)
    rows = [(i, prose(i, rnd.choice([1, 5, 30, 200])), "p", "x") for i in rnd.sample(range(1000), 120)]
    rows += [(None, "null key " * 40, "p", "x"), (2000, None, "p", "x"), (2001, "", "p", "x")]
    return rows + [(5000, prose(9, 100), "p", "x")] * 40 + [(5000, prose(8, 90), "p", "x")] * 2


def test_digests_of_all_rows(spark):
    rows = rows_of(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, packed string, part string").repartition(5)
    got = Counter(tuple(r) for r in fp.digests(docs).collect())
    places = np.array(fp.rarity(docs))
    seen = Counter(level(t.encode()[i : i + 64]) for _, t, _, _ in rows if t for i in range(len(t.encode()) - 63))
    assert [seen[k] for k in np.argsort(places)] == sorted(seen[k] for k in range(fp.LEVELS))
    # Rows of one id go by the hash of their text.
    order = docs.selectExpr("doc_id", "coalesce(text, '') as t", "xxhash64(coalesce(text, '')) as h").collect()
    order = sorted(order, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    want, one = Counter(), lambda t: fp.chains([t.encode()], places)[0]
    for r, after in zip(order, order[1:] + order[:1]):
        k = len(r.t) // 4
        changed = r.t[: len(r.t) - k] + after.t[:k]
        own, new, then = one(r.t), one(changed), one(after.t)
        want[r.doc_id, len(r.t), hashlib.sha256(changed.encode()).hexdigest(), fp.fingerprint_of(own),
             fp.fingerprint_of(new), fp.likeness(own, new), fp.likeness(own, then)] += 1
    assert got == want


def test_one_row_and_none(spark):
    schema = "doc_id long, text string"
    one = fp.digests(spark.createDataFrame([(1, prose(1, 50))], schema)).collect()
    assert len(one) == 1 and one[0].near_next == 1 and 0 < one[0].near_edited <= 1
    assert fp.digests(spark.createDataFrame([], schema)).count() == 0
    nulls = fp.digests(spark.createDataFrame([(None, None)], schema)).collect()
    assert [tuple(r) for r in nulls] == [(None, 0, hashlib.sha256(b"").hexdigest(), "", "", 1.0, 1.0)]
