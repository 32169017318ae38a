"""Token alignment against groups and links found token by token on whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from msgloom.llm import alignment

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SIGNS = ["a", "b", " ", " ", "\n", "the", " cat", "é", "漢", "\t", "▁", "<|endoftext|>", "'s", "'", "1", "23", ".",
         ",", " ", "\x85", "\x1c", "🙂", "\r\n", "  ", "<0x0A>", "</s>", "x" * 30, "\0", "ﬁ"]
FIXED = [None, "", " ", "a", " a", "a ", "\na", "a\n", " \n a", "\n\nfoo bar", "a b\nc", "it's the cat\n 's",
         "not ▁ given back", "word " * 3000, "x" * 5000, "a" * 400 + "\n" + "the cat"]


def by_hand(text):
    """Tokens of whole texts, groups between common ends, links by comparing ranges."""
    tokens = alignment.tokens_of(A, B)
    if not text:
        return None
    ids = tokens.a.encode(f" {text}", add_special_tokens=False).ids, tokens.b.encode(text)
    raw = [[of[i] for i in own] for own, of in zip(ids, (tokens.a_bytes, tokens.b_bytes))]
    if any(b"".join(r) != f" {text}".encode() for r in raw):
        return None
    a, b = (np.cumsum([len(t) for t in r]).tolist() for r in raw)
    groups, i, j = [], 0, 0
    for end in sorted(set(a) & set(b)):
        i_to, j_to = a.index(end) + 1, b.index(end) + 1
        groups.append(",".join(map(str, ids[0][i:i_to])) + "|" + ",".join(map(str, ids[1][j:j_to])))
        i, j = i_to, j_to
    links, j = [], 0
    for token, start, end in zip(ids[0], [0, *a], a):
        while b[j] <= start:
            j += 1
        k = j
        while k < len(b) and (b[k - 1] if k else 0) < end:
            links.append((token, ids[1][k]))
            k += 1
    return len(a), len(b), ";".join(groups), links


def texts():
    rnd = random.Random(4)
    return FIXED + ["".join(rnd.choices(SIGNS, k=rnd.randint(1, 40))) for _ in range(400)]


def test_groups_of_many_texts():
    given = texts()
    assert alignment.tokens_of(A, B).cuts
    for text, got in zip(given, alignment.groups_of([t or "" for t in given])):
        want = by_hand(text)
        assert got == (want[2] if want else ""), text


def test_pointers_meet_at_the_last_token():
    # Tokens end at 1 2 3 4 6 and 2 3 5 6: they have 2, 3 and 6 in common.
    a, b, first = alignment.group_labels(np.array([1, 2, 3, 4, 6]), np.array([2, 3, 5, 6]))
    assert a.tolist() == [1, 1, 2, 4, 4] and b.tolist() == [1, 2, 4, 4] and first.tolist() == [0, 0, 1, 2, 2]
    # A chain over the whole text: each token overlaps the next of the other side only.
    long = 2 * np.arange(1, 5001)
    a, b, _ = alignment.group_labels(np.concatenate([long, [10001]]), np.concatenate([long - 1, [10001]]))
    assert set(a.tolist()) == set(b.tolist()) == {5000}


@pytest.mark.parametrize("bundle", [50, 4000, 1 << 23])
def test_figures_of_all_rows(spark, bundle):
    given = texts()
    rows = [(i, t, "x", "y") for i, t in enumerate(given)]
    rows += [(None, "the cat", "x", "y"), (3, "a", None, "y"), (3, "a", None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair string, bundle string").repartition(3)
    got = Counter(map(tuple, alignment.align(docs, bundle_chars=bundle).collect()))
    known = [(k, by_hand(t)) for k, t, _, _ in rows]
    counts = Counter(link for _, w in known if w for link in w[3])
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    want = Counter()
    for key, w in known:
        if not w:
            want[key, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        best = sum(counts[link] == most[link[1]] for link in w[3])
        digest = hashlib.sha256(w[2].encode()).hexdigest()
        want[key, w[0], w[1], w[2].count(";") + 1, len(w[3]), best, sum(counts[x] for x in w[3]), digest] += 1
    assert got == want
    table = {(r.a_id, r.b_id): r.n_links for r in alignment.pair_counts(docs, bundle_chars=bundle).collect()}
    assert table == counts


def test_other_vocabularies_are_encoded_whole():
    other = alignment.Tokens("word_bpe_49k.json", B)
    assert not other.cuts and other.split("a b") == [" a b"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(only).collect())) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]
