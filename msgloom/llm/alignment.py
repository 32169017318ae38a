"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes. Every token points to the farthest-right token of the
other side that it overlaps, or to itself where none reaches farther (of two that end
together the first tokenizer's). Pointers are doubled, each taking its target's, for all
tokens at once until nothing changes: then each token points to the last one of its
component, which labels its group. Groups end where tokens of both sides end.

Where both vocabularies are sure to cut a text, at a single blank or line end between other
characters, it is split into pieces. A piece is encoded and aligned once, however often it
stands. Tasks form bundles of documents of bounded size: the numbers of a document's pieces,
and for each piece its linked pairs of ids. Only a bundle's distinct pairs with their counts
are shuffled, summed up over the corpus, and sent back to their bundles.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, stored, text_or_empty
from msgloom.llm.encoders import SIGNS, cut_kind, slices, vocabulary

# A bundle ends after so many characters; one longer document is a bundle of its own.
BUNDLE_CHARS = 1 << 23
# Pieces are forgotten at the end of a bundle beyond these numbers.
KEPT_PIECES, KEPT_CHARS = 500_000, 1 << 25
# A single blank or line end between other characters.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
BLANK = "▁"  # sentencepiece writes a blank so

STORED_SQL = ("bundle bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups binary, "
              "pieces binary, ends binary, links binary, pairs binary, counts binary")  # fmt: skip
STORED = pa.schema([("bundle", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("groups", pa.binary()), ("pieces", pa.binary()),
                    ("ends", pa.binary()), ("links", pa.binary()), ("pairs", pa.binary()),
                    ("counts", pa.binary())])
ALIGNED_SQL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
               "count_sum bigint, groups_sha256 string")  # fmt: skip
ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                     ("groups_sha256", pa.string())])


class Tokens:
    """Both tokenizers, the bytes of their ids and where a text may be cut."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(vocabulary(a))
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(b))
        byte_of = {sign: byte for byte, sign in SIGNS.items()}
        added = {t["id"] for t in json.loads(self.a.to_str())["added_tokens"]}
        self.a_bytes = {
            i: token.encode() if i in added else bytes(byte_of[c] for c in token)
            for token, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # No piece may reach over a blank or line end into what follows, and line ends are bytes.
        inner = any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        prefix = self.b.encode("\na")
        line_end = len(prefix) > 2 and pieces[prefix[0]] == BLANK and self.b_bytes[prefix[1]] == b"\n"
        self.cuts = cut_kind(a) == "blank" and not inner and line_end

    def split(self, text: str) -> list[str]:
        """Pieces of " " + text; a blank before a piece that starts with none is left out."""
        if not self.cuts:
            return [f" {text}"]
        flat = text.replace("\n", " ")
        if " ".join(flat.split()) == flat:  # single blanks and line ends only
            return text.replace("\n", " \n").split(" ")
        cut = CUT.split(f" {text}")
        return [p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n") else p for p in cut]

    def encode(self, pieces: list[str]) -> tuple[list[str], list[list[int]], list[list[int]]]:
        """The pieces in full and the ids that each tokenizer gives them."""
        full = [p if p[:1] in (" ", "\n") else f" {p}" for p in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(full, add_special_tokens=False)]
        # Sentencepiece puts a blank before a text: that of a piece with a blank of its own, while
        # before a line end it is a token that is taken off.
        b = self.b.encode([p[1:] if p[0] == " " else p for p in full], num_threads=1)
        return full, a, [ids[1:] if p[0] == "\n" else ids for p, ids in zip(full, b)]


@lru_cache(maxsize=4)
def tokens_of(a: str, b: str) -> Tokens:
    return Tokens(a, b)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terminal tokens of the components, by pointer jumping.

    Both sides cover the same bytes from 0 on; tokens end where given, rising. Tokens are
    numbered through, those of A first. Gives each A and each B token's terminal token, and
    for each A token the first B token that it overlaps.
    """
    n = len(a_ends)
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    first = np.searchsorted(b_ends, a_starts, "right")
    last_b = np.searchsorted(b_starts, a_ends, "left") - 1
    last_a = np.searchsorted(a_starts, b_ends, "left") - 1
    to = np.arange(n + len(b_ends))
    to[:n] = np.where(b_ends[last_b] > a_ends, n + last_b, to[:n])
    to[n:] = np.where(a_ends[last_a] >= b_ends, last_a, to[n:])
    while True:
        farther = to[to]
        if (farther == to).all():
            return to[:n], to[n:], first
        to = farther


class Pieces:
    """Aligned pieces by number: their groups as text, figures and linked pairs of ids."""

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.pairs, self.ends, self.chars = array("q"), array("q", [0]), 0

    def add(self, pieces: list[str]) -> None:
        """Encode and align pieces that are not known yet; n_a is -1 where the bytes differ."""
        tokens = self.tokens
        full, a_ids, b_ids = tokens.encode(pieces)
        raw = [p.encode() for p in full]
        a_of, b_of = tokens.a_bytes.__getitem__, tokens.b_bytes.__getitem__
        good = [
            b"".join(map(a_of, a)) == p == b"".join(map(b_of, b)) for p, a, b in zip(raw, a_ids, b_ids)
        ]
        a_flat = [i for ids, ok in zip(a_ids, good) if ok for i in ids]
        b_flat = [i for ids, ok in zip(b_ids, good) if ok for i in ids]
        a_ends = np.cumsum([len(a_of(i)) for i in a_flat], dtype=np.int64)
        b_ends = np.cumsum([len(b_of(i)) for i in b_flat], dtype=np.int64)
        if a_flat:
            a_label, b_label, first = group_labels(a_ends, b_ends)
            a_starts = np.concatenate([[0], a_ends[:-1]])
            last = np.searchsorted(np.concatenate([[0], b_ends[:-1]]), a_ends, "left") - 1
            links = last - first + 1
            before = np.cumsum(links) - links
            b_at = np.arange(links.sum()) - np.repeat(before - first, links)
            a_array, b_array = np.array(a_flat, np.int64), np.array(b_flat, np.int64)
            pairs = (np.repeat(a_array, links) << 32) | b_array[b_at]
            # Labels are terminal tokens, which rise with the text: groups end where they change.
            a_cut = np.concatenate([np.flatnonzero(np.diff(a_label)) + 1, [len(a_flat)]]).tolist()
            b_cut = np.concatenate([np.flatnonzero(np.diff(b_label)) + 1, [len(b_flat)]]).tolist()
            a_text, b_text = list(map(str, a_flat)), list(map(str, b_flat))
            link_ends, at, group, a, b = np.concatenate([[0], np.cumsum(links)]), 0, 0, 0, 0
        for piece, ok, a_own, b_own in zip(pieces, good, a_ids, b_ids):
            self.numbers[piece] = len(self.groups)
            self.chars += len(piece)
            if not ok:
                self.groups.append("")
                self.n_a.append(-1), self.n_b.append(0), self.n_groups.append(0), self.ends.append(len(self.pairs))
                continue
            found, stop = [], a + len(a_own)
            start = a
            while a < stop:
                a_to, b_to = a_cut[group], b_cut[group]
                found.append(f"{','.join(a_text[a:a_to])}|{','.join(b_text[b:b_to])}")
                a, b, group = a_to, b_to, group + 1
            self.groups.append(";".join(found))
            self.n_a.append(len(a_own)), self.n_b.append(len(b_own)), self.n_groups.append(len(found))
            self.pairs.frombytes(pairs[link_ends[start] : link_ends[a]].tobytes())
            self.ends.append(len(self.pairs))

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's pieces."""
        split = [self.tokens.split(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for pieces in split for p in pieces if p not in self.numbers))
        for a, b in slices(new, 1 << 20):
            self.add(new[a:b])
        number = self.numbers.__getitem__
        return [np.fromiter(map(number, pieces), np.int64, len(pieces)) for pieces in split]


def _bundles(a: str, b: str, bundle_chars: int):
    def make(batches: Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bundle = TaskContext.get().partitionId() << 32
        pieces, out = Pieces(tokens_of(a, b)), Rows(STORED)
        docs: list[tuple[int | None, np.ndarray]] = []
        chars = 0

        def close() -> Iterator[pa.RecordBatch]:
            """The bundle's documents, a row each, and a row of its pieces and pairs."""
            n_a, n_b, n_groups = (np.frombuffer(v, np.int64) for v in (pieces.n_a, pieces.n_b, pieces.n_groups))
            # A text with a piece whose bytes differ has no tokens.
            docs_ = [(k, ids if (n_a[ids] >= 0).all() else ids[:0]) for k, ids in docs]
            used, local = np.unique(np.concatenate([ids for _, ids in docs_]), return_inverse=True)
            at, times = 0, np.bincount(local, minlength=len(used))
            for key, ids in docs_:
                text = ";".join(map(pieces.groups.__getitem__, ids.tolist()))
                digest = hashlib.sha256(text.encode()).digest() if text else None
                own = _packed(local[at : at + len(ids)].astype(np.uint32))
                at += len(ids)
                out.add(bundle, key, int(n_a[ids].sum()), int(n_b[ids].sum()), int(n_groups[ids].sum()), digest,
                        own, None, None, None, None, weight=len(own) + 100)
                yield from out.ready()
            ends = np.frombuffer(pieces.ends, np.int64)
            sizes = ends[used + 1] - ends[used]
            stops = np.cumsum(sizes)
            where = np.arange(sizes.sum()) + np.repeat(ends[used] - stops + sizes, sizes)
            pairs, links = np.unique(np.frombuffer(pieces.pairs, np.int64)[where], return_inverse=True)
            counts = np.zeros(len(pairs), np.int64)
            np.add.at(counts, links, np.repeat(times, sizes))
            packed = [_packed(v) for v in (stops, links.astype(np.uint32), pairs, counts)]
            out.add(bundle, None, None, None, None, None, None, *packed, weight=sum(map(len, packed)))
            yield from out.rest()

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in slices(texts, 1 << 20):
                docs += zip(keys[i:j], pieces.many(texts[i:j]))
                chars += sum(map(len, texts[i:j]))
                if chars >= bundle_chars:
                    yield from close()
                    docs, chars, bundle = [], 0, bundle + 1
                    if len(pieces.groups) > KEPT_PIECES or pieces.chars > KEPT_CHARS:
                        pieces.clear()
        if docs:
            yield from close()

    return make


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pairs(batches: Batches) -> Iterator[pa.RecordBatch]:
    """A row for each distinct pair of a bundle, with its count there."""
    for batch in batches:
        for bundle, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
            pairs, counts = _unpacked(pairs, np.int64), _unpacked(counts, np.int64)
            for i in range(0, len(pairs), 100_000):
                part = pairs[i : i + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "bundle": pa.array(np.full(len(part), bundle), pa.int64()), "pair": pa.array(part),
                    "n": pa.array(counts[i : i + 100_000]),
                })


def _figures(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one bundle with what the corpus says of their links."""
    left, right = left.combine_chunks(), right.combine_chunks()
    docs = left.filter(pa.compute.is_valid(left["pieces"]))
    own = left.filter(pa.compute.is_valid(left["links"]))
    stops = _unpacked(own["ends"][0].as_py(), np.int64)
    links = _unpacked(own["links"][0].as_py(), np.uint32)
    order = np.argsort(right["pair"].to_numpy(), kind="stable")
    counts = right["total"].to_numpy()[order][links]
    best = right["best"].to_numpy(zero_copy_only=False)[order][links].astype(np.int64)
    at = np.concatenate([[0], stops])

    def per_piece(values: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(values)])
        return summed[at[1:]] - summed[at[:-1]]

    count_of, best_of, links_of = per_piece(counts), per_piece(best), np.diff(at)
    found = [_unpacked(p, np.uint32) for p in docs["pieces"].to_pylist()]
    digests = [g.hex() if g else "" for g in docs["groups"].to_pylist()]
    columns = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups")]
    columns += [pa.array([int(v[p].sum()) for p in found], pa.int64()) for v in (links_of, best_of, count_of)]
    return pa.Table.from_arrays([*columns, pa.array(digests, pa.string())], schema=ALIGNED)


def bundles(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text",
            bundle_chars: int = BUNDLE_CHARS) -> DataFrame:
    """Stored bundles: a row for each document and one for the pieces and pairs of a bundle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return stored(rows.mapInArrow(_bundles(a, b, bundle_chars), STORED_SQL), "alignment")


def bundle_pairs(made: DataFrame) -> DataFrame:
    """bundle, pair (A id in the upper 32 bits, B id in the lower) and its links there."""
    packed = made.filter("pairs is not null").select("bundle", "pairs", "counts")
    return packed.mapInArrow(_pairs, "bundle bigint, pair bigint, n bigint")


def with_totals(pairs: DataFrame) -> DataFrame:
    """Pairs with their links in the whole corpus, and whether their B id has none with more.

    A pair has a row for each bundle at most, however often it stands.
    """
    total = F.sum("n").over(Window.partitionBy("pair"))
    summed = pairs.select("bundle", "pair", total.alias("total"))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id")
    # A row for each B id that occurs: as many as the vocabulary has at most.
    most = summed.groupBy(b_id).agg(F.max("total").alias("most"))
    known = summed.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
    return known.select("bundle", "pair", "total", (F.col("total") == F.col("most")).alias("best"))


def pair_counts(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
                **columns: str) -> DataFrame:
    """The table of linked ids: a_id, b_id, their links in the corpus."""
    summed = bundle_pairs(bundles(docs, a, b, **columns)).groupBy("pair").agg(F.sum("n").alias("n_links"))
    return summed.select(F.shiftrightunsigned("pair", 32).alias("a_id"),
                         F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "n_links")


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id",
          text_col: str = "text", bundle_chars: int = BUNDLE_CHARS) -> DataFrame:
    """One row for each row of ``docs``: tokens of both sides, groups, links and their counts.

    ``n_links`` are overlapping pairs of an A and a B token, ``n_best`` those whose pair of ids
    is linked as often in the corpus as any with that B id, ``count_sum`` adds up the corpus
    counts of all of them. ``groups_sha256`` is that of the groups' ids as text.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty text. A null id stays, repeated rows each have a row and count
    in the corpus each; other columns are not read; an empty table gives no row.
    """
    made = bundles(docs, a, b, id_col, text_col, bundle_chars)
    answers = with_totals(bundle_pairs(made)).groupBy("bundle")
    left = made.drop("pairs", "counts").groupBy("bundle")
    return left.cogroup(answers).applyInArrow(_figures, ALIGNED_SQL)


def groups_of(texts: list[str], a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> list[str]:
    """The groups of texts, ``a1,a2|b1;…``; empty for texts without tokens."""
    pieces = Pieces(tokens_of(a, b))
    found = pieces.many(texts)
    return [
        "" if any(pieces.n_a[i] < 0 for i in ids) else ";".join(pieces.groups[i] for i in ids.tolist())
        for ids in found
    ]
