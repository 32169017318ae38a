"""Finds test items in training texts: BM25 retrieval by block-max WAND, then an overlap check.

The indexed documents are the items' parts, each question and each answer an entry of its
own, and the passages of every training text are the queries. An item is retrieved when the
BM25 score of a passage reaches a share of the score of one of its parts for its own words. The
most common terms of an entry, as many as make up less than half the threshold, bring up no
candidates: its other, heavy terms must bring the rest, and only blocks with entries for which
a passage's heavy terms do are looked at. A block holds some entries with its highest score per
term, so that whole blocks are passed over without scoring an entry. What is retrieved is
verified: the word 5-grams of question and answer must be in the text or, for near copies,
their words in order in one stretch of it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import Batches, Rows, few_rows, text_or_empty, tidy, unused

WORD = re.compile(r"\w+")
K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
OVERLAP = 75  # percent of the 5-grams, or of the words in order, of question and of answer
GRAM = 5
WHOLE_WORDS = 8  # items with fewer words may also be found as one part
BLOCK_ITEMS = 8
#: Bytes of items in one index; more items are searched in further indexes.
INDEX_BYTES = 32 << 20
FOUND = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()),
                   ("score", pa.float64()), ("question_hits", pa.int64()), ("question_size", pa.int64()),
                   ("answer_hits", pa.int64()), ("answer_size", pa.int64())])
FOUND_SQL = ("doc_id bigint, text_key bigint, item_id bigint, score double, question_hits bigint, "
             "question_size bigint, answer_hits bigint, answer_size bigint")  # fmt: skip


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(words: list[str]) -> set[tuple[str, ...]]:
    if len(words) < GRAM:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(GRAM))))


def halves(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text: its first and second half of words."""
    words = words_of(text)
    middle = -(-len(words) // 2)
    return " ".join(words[:middle]), " ".join(words[middle:])


def wanted(size: int) -> int:
    """How many of a part's words must be in the text in order."""
    return -(-size * OVERLAP // 100)


def stretch(size: int) -> int:
    """Words of text among which they must be: a quarter more than the part has, and at least one."""
    return size + max(1, size - wanted(size))


def in_order(part: list[str], at: dict[str, list[int]]) -> bool:
    """Whether a stretch of the text, of whose words ``at`` has the places, holds the part's words in order."""
    need, reach = wanted(len(part)), stretch(len(part))
    bits: dict[str, int] = {}
    for k, word in enumerate(part):
        bits[word] = bits.get(word, 0) | 1 << k
    hits = sorted((p, b) for word, b in bits.items() for p in at.get(word, ()))
    end, full = 0, (1 << len(part)) - 1
    for start, (place, _) in enumerate(hits):
        while end < len(hits) and hits[end][0] < place + reach:
            end += 1
        if end - start < need:
            continue
        # Longest common subsequence, one bit per word of the part: zeros are matched words.
        left = full
        for _, b in hits[start:end]:
            both = left & b
            left = ((left + both) | (left - both)) & full
        if len(part) - left.bit_count() >= need:
            return True
    return False


class Index:
    """Inverted index of the items' parts: postings by term, scores, and each block's highest score.

    Scores are shares of the entry's own score, so that one threshold holds for all. With
    ``near`` it is lower for an entry whose words that may be missing bring more than the rest.
    """

    def __init__(self, items: list[tuple[int, str, str]], threshold: float = THRESHOLD, near: bool = False):
        kept = [(i, words_of(q), words_of(a)) for i, q, a in items]
        self.wholes = [(i, q, a) for i, q, a in kept if q or a]
        self.grams = [(grams_of(q), grams_of(a)) for _, q, a in self.wholes]
        self.near = near
        # The entries: number of the item and the words of one part.
        self.items = [(k, part) for k, (_, *parts) in enumerate(self.wholes) for part in parts if part]
        counts = [Counter(part) for _, part in self.items]
        sizes = [sum(c.values()) for c in counts]
        mean, n = sum(sizes) / max(1, len(sizes)), len(counts)
        within = Counter(t for c in counts for t in c)
        self.terms = {t: k for k, t in enumerate(sorted(within))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for item, (count, size) in enumerate(zip(counts, sizes)):
            weights = {
                t: math.log(1 + (n - within[t] + 0.5) / (within[t] + 0.5))
                * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean))
                for t, f in count.items()
            }
            whole = sum(weights.values())
            for term, weight in weights.items():
                postings[self.terms[term]].append((item, weight / whole))
        # Per entry the terms that most entries have, up to half the threshold, are light; any
        # choice will do, and these have the longest postings. The others are heavy.
        self.heavy: dict[str, list[tuple[int, float]]] = {}
        self.needed = [0.0] * n  # what the heavy terms must bring for an entry to be retrieved
        self.thresholds = np.full(n, threshold)
        for item, (count, size) in enumerate(zip(counts, sizes)):
            mine = sorted((-within[t], t, dict(postings[self.terms[t]])[item]) for t in count)
            if near:
                least = sum(sorted(w for *_, w in mine)[: max(1, len(mine) - size + wanted(size))])
                self.thresholds[item] = min(threshold, least)
            upto = np.cumsum([w for *_, w in mine])
            light = int(np.searchsorted(upto, self.thresholds[item] / 2))
            self.needed[item] = float(self.thresholds[item] - (upto[light - 1] if light else 0.0) - 1e-9)
            for _, term, weight in mine[light:]:
                self.heavy.setdefault(term, []).append((item, weight))
        self.heavy_words = set(self.heavy)
        # The same as arrays: the number of each heavy word, and where its entries start.
        self.heavy_number = {word: k for k, word in enumerate(self.heavy)}
        self.heavy_at = np.cumsum([0] + [len(p) for p in self.heavy.values()])
        brought = [pair for posting in self.heavy.values() for pair in posting]
        self.heavy_entry = np.array([i for i, _ in brought], np.int64)
        self.heavy_weight = np.array([w for _, w in brought], np.float64)
        self.least = np.array(self.needed) - 1e-9
        self.at = np.cumsum([0] + [len(p) for p in postings])
        flat = [x for p in postings for x in p]
        self.item = np.array([i for i, _ in flat], np.int64)
        self.score = np.array([s for _, s in flat], np.float64)
        self.best = np.array([max(s for _, s in p) for p in postings] + [0.0])
        # Per term its blocks, each with the highest score in it.
        tops = [{} for _ in postings]
        for top, posting in zip(tops, postings):
            for i, s in posting:
                top[i // BLOCK_ITEMS] = max(top.get(i // BLOCK_ITEMS, 0.0), s)
        self.block_at = np.cumsum([0] + [len(t) for t in tops])
        self.block = np.array([b for t in tops for b in t], np.int64)
        self.block_top = np.array([s for t in tops for s in t.values()], np.float64)
        self.blocks = -(-n // BLOCK_ITEMS)
        lowest = np.full(self.blocks * BLOCK_ITEMS, np.inf)
        lowest[:n] = self.thresholds
        self.block_threshold = lowest.reshape(-1, BLOCK_ITEMS).min(axis=1)
        self.longest = max([GRAM, *(map(stretch, sizes) if near else sizes)])

    def __bool__(self) -> bool:
        return bool(self.items)

    def _postings(self, starts: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Places of the postings of some terms."""
        firsts, sizes = starts[terms], starts[terms + 1] - starts[terms]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts - ends + sizes, sizes)

    def _brought(self, words: set[str]) -> dict[int, float]:
        """What these heavy words bring to each entry that has one of them."""
        brought: dict[int, float] = {}
        for word in words:
            for entry, weight in self.heavy[word]:
                brought[entry] = brought.get(entry, 0.0) + weight
        return brought

    def hopeful(self, words: set[str]) -> set[int]:
        """Blocks with an entry that these heavy words bring near enough to the threshold."""
        needed = self.needed
        return {i // BLOCK_ITEMS for i, share in self._brought(words).items() if share >= needed[i]}

    def _passages(self, held: list[set[str]]) -> list[int]:
        """Passages whose two steps together may bring enough to any entry, all steps at once.

        What a passage brings to an entry is at most what its two steps do, each for itself.
        """
        number = self.heavy_number
        terms = np.array([number[word] for step in held for word in step], np.int64)
        steps = np.repeat(np.arange(len(held)), [len(step) for step in held])
        places = self._postings(self.heavy_at, terms)
        steps = np.repeat(steps, self.heavy_at[terms + 1] - self.heavy_at[terms])
        # One key for each entry and step; the next key is the entry's next step.
        wide = len(held) + 1
        keys, where = np.unique(self.heavy_entry[places] * wide + steps, return_inverse=True)
        brought = np.bincount(where, self.heavy_weight[places], len(keys))
        entry, step = keys // wide, keys % wide
        following = np.append(np.where(keys[1:] == keys[:-1] + 1, brought[1:], 0.0), 0.0)[: len(keys)]
        both = step[brought + following >= self.least[entry]]
        alone = step[brought >= self.least[entry]] - 1
        found = np.unique(np.concatenate([both, alone]))
        return found[(found >= 0) & (found < max(1, len(held) - 1))].tolist()

    def retrieve(self, terms: np.ndarray, blocks: set[int]) -> list[tuple[int, float]]:
        """Entries of some blocks whose score for these distinct terms reaches the threshold."""
        seen = np.array(sorted(blocks), np.int64)
        places = self._postings(self.block_at, terms)
        tops = np.bincount(self.block[places], self.block_top[places], self.blocks)
        good = np.zeros(self.blocks, bool)
        good[seen[tops[seen] >= self.block_threshold[seen] - 1e-12]] = True
        if not good.any():
            return []
        places = self._postings(self.at, terms)
        places = places[good[self.item[places] // BLOCK_ITEMS]]
        scores = np.bincount(self.item[places], self.score[places], len(self.items))
        hits = np.flatnonzero(scores >= self.thresholds - 1e-12)
        return list(zip(hits.tolist(), scores[hits].tolist()))

    def search(self, words: list[str]) -> dict[int, float]:
        """The best score of each item of which any passage of a text retrieves a part.

        Passages are twice as long as the longest part (or its stretch) and start at each of
        its lengths, so every run of words as long as a part lies in one.
        """
        if self.heavy_words.isdisjoint(words):
            return {}
        step, found = self.longest, {}
        held = [self.heavy_words.intersection(words[a : a + step]) for a in range(0, len(words), step)]
        for k in self._passages(held):
            blocks = self.hopeful(held[k].union(*held[k + 1 : k + 2]))
            if blocks:
                own = {self.terms[w] for w in words[k * step : (k + 2) * step] if w in self.terms}
                for entry, score in self.retrieve(np.array(sorted(own), np.int64), blocks):
                    item = self.items[entry][0]
                    found[item] = max(score, found.get(item, 0.0))
        return found

    def verify(self, words: list[str], found: dict[int, float]) -> Iterator[tuple]:
        """item_id, score, and the 5-grams of question and answer that the text holds."""
        if not found:
            return
        held: dict[int, set] = {}
        at: dict[str, list[int]] = {w: [] for item in found for part in self.wholes[item][1:] for w in part}
        for place, word in enumerate(words) if self.near else ():
            if word in at:
                at[word].append(place)
        for item, score in sorted(found.items()):
            sizes, hits = [], []
            for grams in self.grams[item]:
                n = len(next(iter(grams), ()))
                if n and n not in held:
                    held[n] = set(zip(*(words[k:] for k in range(n))))
                inside = held.get(n, set())
                sizes.append(len(grams))
                hits.append(len(grams & inside))
            item_id, question, answer = self.wholes[item]
            held_there = all(100 * h >= OVERLAP * s for h, s in zip(hits, sizes))
            if not held_there and self.near:
                held_there = all(in_order(part, at) for part in (question, answer) if part)
                if not held_there and len(question) + len(answer) < WHOLE_WORDS:
                    held_there = in_order(question + answer, at)
            if held_there:
                yield item_id, score, hits[0], sizes[0], hits[1], sizes[1]


def _search(index):
    def search(batches: Batches) -> Iterator[pa.RecordBatch]:
        out, made = Rows(FOUND), index.value
        for batch in few_rows(batches):
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                for row in made.verify(words, made.search(words)) if words else ():
                    out.add(doc_id, key, *row)
                yield from out.ready()
        yield from out.rest()

    return tidy(search)


def indexes(items: DataFrame, id_col: str, question_col: str, answer_col: str | None,
            near: bool = False) -> Iterator[Index]:
    """Indexes of at most INDEX_BYTES of items each (or one item), by ranges of their ids' hash."""
    question = text_or_empty(question_col)
    answer = text_or_empty(answer_col) if answer_col else F.lit(None).cast("string")
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), question.alias("question"), answer.alias("answer"))
    size = rows.agg(F.sum(F.octet_length("question") + F.octet_length(F.coalesce("answer", F.lit(""))))).first()[0]
    parts = -(-(size or 0) // INDEX_BYTES)
    for part in range(parts):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "question"), F.lit(parts)) == part) if parts > 1 else rows
        found = [(r[0], *((r[1], r[2]) if answer_col else halves(r[1]))) for r in mine.collect()]
        made = Index(sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1:])), near=near)
        if made:
            yield made


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", question_col: str = "text",
               answer_col: str | None = None, near: bool = False) -> DataFrame:
    """Pairs of a document and a test item that it holds, one row each.

    A pair has doc_id, item_id, the retrieval's score and the 5-grams of question and answer
    that the text holds, of how many. An item is held if the text has 75 % of the 5-grams of
    each. One changed word undoes that in a part of fewer than 24 words; with ``near`` an item
    is also held if 75 % of the words of each stand in order in a stretch of the text that is
    at most a quarter longer, at least one word. A part of fewer than four words must then be
    there whole, but an item of fewer than eight words may be found as one part. Without an answer column an item's first half of words
    is its question, the second half its answer. Case, marks and white space do not count. A
    null or empty text or item holds nothing and is found nowhere; a part without words is
    taken as held, one with fewer than five is one gram; null and repeated ids give a pair
    for each row; other columns are not read; empty tables give no row. The items are test
    sets: an index holds at most 32 MB of them, and each further index reads the documents
    again.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       text.alias("text"))
    out = spark.createDataFrame([], FOUND_SQL)
    for index in indexes(items, item_col, question_col, answer_col, near):
        out = out.unionByName(rows.mapInArrow(_search(spark.sparkContext.broadcast(index)), FOUND_SQL))
    return out


def without_items(docs: DataFrame, items: DataFrame, **settings: object) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    pairs = find_items(docs, items, **settings)
    key, text = unused(docs, "_id", "_key")
    gone = pairs.select(F.col("doc_id").alias(key), F.col("text_key").alias(text)).distinct()
    same = F.col(settings.get("id_col", "doc_id")).eqNullSafe(F.col(key))
    same &= F.xxhash64(text_or_empty(settings.get("text_col", "text"))) == F.col(text)
    return docs.join(gone, same, "left_anti")
