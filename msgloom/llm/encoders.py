"""Token ids of whole texts, with the library's ids of repeated words kept in memory.

Both vocabularies cut a text into pieces that merges never cross. Where such a cut is
certain, the text is split there and each distinct piece is encoded once by the library:

* ``word_bpe``: white space is dropped and no piece of its pattern holds any, so every
  blank, tab and line end is a cut;
* ``byte_bpe``: a single blank between two characters that are no white space starts a
  piece (its pattern takes a blank only as the first character of a piece, or in a run of
  white space).

Any other vocabulary is encoded text by text. The kept pieces are bounded in number.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

KEPT_PIECES = 400_000
# Word parts of two generations: what the younger one lacks is taken over from the elder.
KEPT_PARTS = 350_000
# A blank beside other white space, at which a split would not be certain.
UNCERTAIN = re.compile(r"\s | \s")
CERTAIN = re.compile(r"(?<=\S) (?=\S)")
# Words of printable ASCII without the apostrophe and of Latin-1 letters: what the patterns
# of both vocabularies make of them can be said with their own letters and digits.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SAFE = re.compile(rf" ?[{LETTERS}0-9!-&(-/:-@\[-`{{-~]+")
SAFE_TEXT = re.compile(rf"[{LETTERS}0-9 !-&(-/:-@\[-`{{-~]*")
LOW_PARTS = re.compile(rf"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9 ]+")
PARTS = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+| ?[^{LETTERS}0-9 ]+")
# The sign that byte-level vocabularies write for each byte: printable ones stand for
# themselves, the others, in order, for characters from 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PRINTED]
SIGNS = {b: chr(b) for b in PRINTED} | {b: chr(256 + k) for k, b in enumerate(OTHERS)}
PIECE_CHARS = 400  # longer pieces are not kept


def vocabulary(name: str) -> str:
    """The path of a vocabulary file; a name without a folder is a public one."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=8)
def tokenizer(name: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def cut_kind(name: str) -> str:
    """How texts may be split for a vocabulary: ``space``, ``blank`` or not at all."""
    tok = tokenizer(name)
    described = json.loads(tok.to_str())
    added = [t["content"] for t in described["added_tokens"]]
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"]
                and not re.search(r"\s", t["content"]) for t in described["added_tokens"])
    pre, normal = described["pre_tokenizer"] or {}, described["normalizer"]
    if not plain or not added:
        return "none"
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not normal:
        return "blank"
    first = (pre.get("pretokenizers") or [{}])[0]
    steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
    if (first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
            and first["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+")
            and steps == ["NFC", "Replace", "Lowercase"]):
        return "space"
    return "none"


class Encoder:
    """Ids of texts as packed numbers, or only how many there are."""

    def __init__(self, name: str, kind: str = "<u4", counts: bool = False):
        self.name, self.kind, self.counts = name, kind, counts
        self.code, self.width = {"<u2": ("H", 2), "<u4": ("I", 4)}[kind]
        self.cut, self.kept = cut_kind(name), {}
        self.tok = tokenizer(name)
        self.model, self.word_parts = self.tok.model, {}
        self.parts = (LOW_PARTS if self.cut == "space" else PARTS).findall
        self.young, self.elder = {}, {}

    def _packed(self, ids: list[int]) -> bytes | int:
        return len(ids) if self.counts else array(self.code, ids).tobytes()

    def _made(self, pieces: list[str]) -> list:
        """Results of pieces that are not kept: plain ones word part by word part, others whole."""
        out, whole = [None] * len(pieces), []
        for i, piece in enumerate(pieces):
            plain = self._plain(piece)
            if self.cut != "none" and SAFE.fullmatch(plain) and "<|" not in plain:
                found = [self._part(p) for p in self.parts(plain.lower() if self.cut == "space" else plain)]
                out[i] = sum(found) if self.counts else b"".join(found)
            else:
                whole.append((i, plain))
        ids = self.tok.encode_batch_fast([p for _, p in whole], add_special_tokens=False)
        for (i, _), encoding in zip(whole, ids):
            out[i] = self._packed(encoding.ids)
        return out

    def _part(self, part: str) -> bytes | int:
        """One piece of the vocabulary's pattern, given to the library's merges."""
        found = self.word_parts.get(part)
        if found is None:
            if len(self.word_parts) > KEPT_PIECES:
                self.word_parts.clear()
            signs = part.replace(" ", "\u0120") if part.isascii() else "".join(SIGNS[b] for b in part.encode())
            found = self.word_parts[part] = self._packed([t.id for t in self.model.tokenize(signs)])
        return found

    def _pieces(self, text: str) -> list[str]:
        if self.cut == "space":
            if text.isascii() and "<|" not in text:  # special texts are matched before letters are lowered
                text = text.lower()
            return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if self.cut == "blank" and text:
            parts = CERTAIN.split(text) if UNCERTAIN.search(text) else text.split(" ")
            # The first piece has no blank before it; the line end marks that.
            return [f"\n{parts[0]}", *parts[1:]]
        return [text] if text else []

    def _plain(self, piece: str) -> str:
        if self.cut != "blank":
            return piece
        return piece[1:] if piece.startswith("\n") else f" {piece}"

    def _words(self, text: str) -> list[str] | None:
        """The parts of a text all of whose pieces are plain; None for another."""
        if self.cut != "space" or "<|" in text:
            return None
        flat = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return LOW_PARTS.findall(flat.lower()) if SAFE_TEXT.fullmatch(flat) else None

    def _joined(self, split: list[list[str]]) -> list:
        """Results of texts from those of their distinct parts."""
        if len(self.young) > KEPT_PARTS:
            self.young, self.elder = {}, self.young
        known, elder, tokenize = self.young, self.elder.get, self.model.tokenize
        for part in set().union(*split) - known.keys():
            found = elder(part)
            if found is None:
                signs = part if part.isascii() else "".join(SIGNS[b] for b in part.encode())
                found = self._packed([t.id for t in tokenize(signs)])
            known[part] = found
        get = known.__getitem__
        return [sum(map(get, p)) if self.counts else b"".join(map(get, p)) for p in split]

    def settle(self) -> None:
        """After a task: only parts of one token stay, no more than the vocabulary has.

        They make up most of a text; a worker that goes on to other work holds no more.
        """
        one = 1 if self.counts else self.width
        kept = {p: v for held in (self.elder, self.young) for p, v in held.items()
                if (v if self.counts else len(v)) == one}
        self.young, self.elder = kept, {}
        self.kept, self.word_parts = {}, {}

    def many(self, texts: list[str]) -> list:
        """For each text, its packed ids or their number."""
        words = [self._words(t) for t in texts]
        plain = iter(self._joined([w for w in words if w is not None]))
        others = iter(self._by_piece([t for t, w in zip(texts, words) if w is None]))
        return [next(others if w is None else plain) for w in words]

    def _by_piece(self, texts: list[str]) -> list:
        split = [self._pieces(t) for t in texts]
        kept = self.kept
        new = list({p for pieces in split for p in pieces if p not in kept})
        if len(self.kept) + len(new) > KEPT_PIECES:
            self.kept.clear()
            new = list(set().union(*split))
        once = dict(zip(new, self._made(new))) if new else {}
        self.kept.update(once)
        get = self.kept.__getitem__
        made = [sum(map(get, p)) if self.counts else b"".join(map(get, p)) for p in split]
        for piece in new:
            if len(piece) > PIECE_CHARS:
                del self.kept[piece]
        return made


@lru_cache(maxsize=8)
def encoder(name: str, kind: str = "<u4", counts: bool = False) -> Encoder:
    """One encoder for a Python worker, which keeps its pieces from task to task."""
    return Encoder(name, kind, counts)


def id_kind(name: str) -> str:
    """The smallest of two packed number kinds that holds every id."""
    return "<u2" if tokenizer(name).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def slices(texts: list[str], most: int = 1 << 22):
    """Consecutive ranges of texts with at most so many characters, or one text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)
