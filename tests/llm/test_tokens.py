"""Token counts, packing and token files against the tokenizer itself."""

from __future__ import annotations

import random
import re
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext

from msgloom.llm import packing, token_counts, token_files
from msgloom.llm.common import few_rows, tidy
from msgloom.llm.encoders import encoder, tokenizer
from msgloom.session import shared_dir

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
TEXTS = [
    None, "", " ", "a", "  a  b ", "a b", "it's  a\tb\r\n\nc d \n e", "ÉTÉ é x y ́z",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c <|startoftext|>", "1 22 333 .,; #$%", "ΑΣ ΣΑΣ\x1cb \x85 c",
    "naïve 漢字 かな 🙂🙂 e", "word " * 300, "x" * 3000, " " * 500 + "a", "a\n" * 200,
    "one two  three\n\n  four 'll 's I'd " * 80, "z" * 900 + " " + "the cat <|endoftext|> " * 90,
]
TO_LETTERS = str.maketrans("0123456789", "ghijklmnop")
EXTRA = "doc_id long, text string, ids string, part int, n_bytes string"


def frame(spark, texts):
    rows = [(i, t, "x", 1, None) for i, t in enumerate(texts)] + [(None, "null key", "x", 1, None)]
    rows += [(3, "a", "x", 1, None)] * 2 + [(13, TEXTS[13], "x", 1, None)]
    return spark.createDataFrame(rows, EXTRA)


def ids_of(vocab, text):
    return tokenizer(vocab).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("vocab", [WORDS, BYTES])
def test_encoder_gives_the_ids_of_the_library(vocab):
    texts = [t or "" for t in TEXTS]
    for got, text in zip(encoder(vocab).many(texts), texts):
        assert np.frombuffer(got, "<u4").tolist() == ids_of(vocab, text), text
    assert encoder(vocab, counts=True).many(texts) == [len(ids_of(vocab, t)) for t in texts]


def test_a_task_leaves_little_in_the_encoder(monkeypatch):
    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    rare = [f"the {random.Random(k).getrandbits(60):x}qz".translate(TO_LETTERS) for k in range(3000)]
    texts = [" ".join(rare), "naïve 漢字 かな", TEXTS[13]]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts})
    made = [r for b in packing._encode(WORDS, 2, "<u2")(iter([batch])) for r in b.to_pylist()]
    assert [np.frombuffer(r["ids"], "<u2").tolist() for r in made] == [[*ids_of(WORDS, t), 2] for t in texts]
    enc = encoder(WORDS, "<u2")
    held = enc.young | enc.elder
    assert "the" in held and all(len(ids_of(WORDS, part)) == 1 for part in held)
    assert not enc.kept and not enc.word_parts
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.many(texts)] == [ids_of(WORDS, t) for t in texts]


@pytest.mark.parametrize(("chunk", "overlap"), [(200, 70), (1000, 300), (1 << 15, 1 << 10)])
def test_counts_of_cut_texts(spark, chunk, overlap):
    docs = frame(spark, TEXTS)
    got = token_counts.count_tokens(docs, chunk_chars=chunk, overlap_chars=overlap).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(ids_of(BYTES, r.text))) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_packing_holds_every_id_once(spark):
    docs = frame(spark, TEXTS).repartition(3)
    pieces = packing.pack(docs, window=64, with_ids=True).cache()
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in rows:
        assert r.sequence_id * 64 + r.offset == at
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.length
    want = sorted(([*ids_of(WORDS, r.text), 2] for r in docs.collect()))
    whole, got = [], []
    for r in rows:
        whole += np.frombuffer(r.ids, "<u4").tolist()
        assert r.boundary == (r.length != r.doc_tokens)
        if r.start + r.length == r.doc_tokens:
            got.append(whole)
            whole = []
    assert sorted(got) == want and not whole
    made = packing.sequences(pieces, 64).collect()
    assert {len(s.ids) // 4 for s in made if s.sequence_id < rows[-1].sequence_id} == {64}
    last = next(s for s in made if s.sequence_id == rows[-1].sequence_id)
    used = rows[-1].offset + rows[-1].length
    assert len(last.ids) // 4 == rows[-1].padded_to == 1 << (used - 1).bit_length()


def test_token_files_round_trip(spark):
    docs = frame(spark, TEXTS)
    folder = shared_dir(spark, "token-test")
    manifest = token_files.write_token_files(docs, folder)
    got = token_files.read_token_files(manifest).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, at = [], 0
    for r in rows:
        ids = [*ids_of(WORDS, r.text), 1]
        want.append((r.doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, got), key=key) == want
    wanted = spark.createDataFrame([(13,), (13,), (5,), (99,), (None,)], "doc_id long")
    found = token_files.lookup(manifest, wanted).collect()
    assert sorted(r.doc_id for r in found) == [5, 13, 13]
    assert all(r.ids == [*ids_of(WORDS, TEXTS[r.doc_id]), 1] for r in found)


@pytest.mark.parametrize("bounds", [[], [(3, 9, "a")], [(-5, 0, "a"), (0, 0, "b"), (0, 4, "c"), (8, 20, "d")]])
def test_shards_of_keys_against_a_range_join(bounds):
    keys = list(range(-8, 24))
    batch = pa.record_batch([pa.array(keys, pa.int64())], names=["key"])
    got = [(r["path"], r["key"]) for b in token_files._shards_of(bounds)([batch]) for r in b.to_pylist()]
    assert sorted(got) == sorted((path, k) for low, high, path in bounds for k in keys if low <= k <= high)


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    made = token_files.PerfectHash.build(np.unique(keys))
    slots = made.slots(np.unique(keys))
    assert sorted(slots.tolist()) == list(range(len(np.unique(keys))))
    others = np.random.default_rng(2).integers(-(2**62), 2**62, 20_000)
    assert (made.slots(others) >= 0).sum() < 5


def test_empty_tables(spark):
    none = frame(spark, TEXTS).limit(0)
    assert packing.pack(none).count() == 0
    assert token_counts.count_tokens(none).count() == 0
    assert token_files.token_files(none).count() == 0


def test_a_task_gives_its_memory_back():
    def held():
        found = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return int(found[0]) >> 10

    def task(batches):
        for batch in few_rows(batches):
            assert len(batch) <= 500
            texts = [t * 3 for t in batch.column(0).to_pylist()]
            kept.extend(texts)
            yield pa.RecordBatch.from_pydict({"text": pa.array([t[:9] for t in texts])})
        pins.append("x" * 5000)  # stands above what is freed, so that the C library keeps that
        kept.clear()

    kept, pins, batch = [], [], pa.RecordBatch.from_pydict({"text": [str(k) * 300 for k in range(40_000)]})
    list(task(iter([batch])))
    before = held()
    assert sum(map(len, tidy(task)(iter([batch])))) == len(batch)
    assert held() <= before - 30
