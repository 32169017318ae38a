"""Quality rules and decontamination against plain Python."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from msgloom.llm import decontaminate, quality, sql


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "to", "of", "house"]) + str(rng.randrange(60)) for _ in range(n))


TEXTS = [None, "", " \n ", "a", "a a a a", "x y z x y z", "# | <b>", "é\x1cé \x85 a\u00a0b", "l\n l\nl\n\n \nl \r\n", "w " * 4000]


def test_counts_of_texts():
    rng = random.Random(1)
    for text in [*TEXTS, *(prose(rng, n).replace(" of", "\n") for n in (10, 60, 200))]:
        assert quality.measure(text or "")[:5] == plain_counts(text), text


def test_verdicts(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 80), "en", "a" if i % 3 else None, "x") for i in range(200)]
    bad = [" ".join(f"{w}###" for w in prose(rng, 80).split()), "same words here " * 40, prose(rng, 80).upper(),
           prose(rng, 40), None, "", " ".join(f"{w}!!" for w in prose(rng, 80).split())]
    rows += [(1000 + i, t, "en", "a", "x") for i, t in enumerate(bad)]
    rows += [(2000, prose(rng, 80), None, None, "x"), (None, prose(rng, 90), "en", "rare", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    got = {r.doc_id: r for r in quality.judge(docs.repartition(3)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (doc_id is None or doc_id < 1000 or doc_id == 2000), doc_id
    assert quality.judge(docs.limit(0)).count() == 0


def test_a_source_of_junk_sets_no_fence_of_its_own(spark):
    rng = random.Random(4)
    spam = lambda: " ".join("###"[: len(w)] + w[3:] for w in prose(rng, 80).split())
    rows = [(prose(rng, 80), "en", f"s{i % 3}", True) for i in range(240)]
    # Over a quarter, and nearly all, of a source; a third of all rows in one source.
    rows += [(spam() if i % 5 < 2 else prose(rng, 80), "en", "part", i % 5 >= 2) for i in range(60)]
    rows += [(spam(), "en", "hot", False) for _ in range(180)] + [(prose(rng, 80), "en", "hot", True) for _ in range(10)]
    # Clean, but in a style of its own: a mark on every fourth word.
    rows += [(" ".join(w + "#" * (i % 4 == 0) for i, w in enumerate(prose(rng, 80).split())), "en", "style", True) for _ in range(60)]
    docs = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.judge(docs.repartition(4)).collect()}
    assert [i for i, r in enumerate(rows) if got[i] != r[3]] == []


def test_sql_has_the_bounds_of_the_fences(spark, tmp_path):
    """On sources of junk, where bounds bind, the query's SQL gives the operator's verdicts."""
    rng = random.Random(6)
    spam = lambda: " ".join("###"[: len(w)] + w[3:] for w in prose(rng, 80).split())
    rows = [(prose(rng, 80), rng.choice(["en", "de"]), f"s{i % 3}") for i in range(200)]
    rows += [(spam(), "en", "hot") for _ in range(150)] + [(prose(rng, 80), "en", "hot") for _ in range(30)]
    rows += [(" ".join(w * 4 for w in prose(rng, 60).split()), "de", "long") for _ in range(40)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    got = quality.judge(docs)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sql.QUALITY})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert 100 < sum(not r[-1] for r in want) < 250


def test_sketches_merge_in_any_way(spark):
    values = [random.Random(5).randrange(10 ** random.Random(i).randrange(1, 8)) for i in range(300)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i int")
    for row in df.select("v", quality.bucket(df["v"]).alias("b")).collect():
        assert row.b <= row.v and row.v - row.b <= row.v / 64
    rows = [(v, "en", "s", 0, *[v] * 8) for v in values]
    measured = spark.createDataFrame(rows, quality.MEASURED_SQL)
    whole = quality.merged(quality.sketches(measured), "lang").collect()
    halves = quality.sketches(measured.filter("doc_id % 2 = 0")).union(quality.sketches(measured.filter("doc_id % 2 = 1")))
    assert sorted(whole) == sorted(quality.merged(halves, "lang").collect())


def items_and_texts(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randrange(6, 40))) for i in range(25)] + [(90, "two words"), (91, None), (None, prose(rng, 12))]
    texts = [None, "", "two words", "Two, WORDS!"]
    for i in range(60):
        text = prose(rng, rng.randrange(0, 300)).split()
        if i % 3 == 0:
            words = (rng.choice(items)[1] or "").split()
            if i % 2:
                words[len(words) // 3 : len(words) // 3 + 1] = ["changed"]
            at = rng.randrange(len(text) + 1)
            text[at:at] = words
        texts.append(" ".join(text).upper() if i % 5 == 0 else "\n".join(text))
    return items, texts


def expected(items, texts):
    out = set()
    for d, text in enumerate(texts):
        held = decontaminate.words_of(text or "")
        for item, passage in items:
            parts = [h.split() for h in decontaminate.halves(passage or "")]
            if not any(parts):
                continue
            good = True
            for words in parts:
                n = min(5, len(words))
                grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
                inside = {tuple(held[i : i + n]) for i in range(len(held) - n + 1)} if words else set()
                good &= 100 * len(grams & inside) >= 75 * len(grams)
            if good:
                out.add((d, item))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_items_in_texts(spark, seed):
    items, texts = items_and_texts(seed)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id int, score string")
    bench = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int")
    got = decontaminate.find_items(docs, bench)
    pairs = {(r.doc_id, r.item_id) for r in got.collect()}
    assert pairs == expected(items, texts) and len(pairs) > 10
    kept = decontaminate.without_items(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in pairs}
    assert decontaminate.find_items(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_items(docs.limit(0), bench).count() == 0


def test_one_changed_word_does_not_hide_an_item(spark):
    rng = random.Random(6)
    items = [(n, prose(rng, n)) for n in range(4, 60)]
    texts, want = [], set()
    for n, passage in items:
        words = passage.split()
        copies = [words] + [words[:k] + new + words[k + 1 :] for k in range(n) for new in (["changed"], [], [words[k], "put"])]
        for copy in copies:
            want.add((len(texts), n))
            texts.append(" ".join([prose(rng, 90), *copy, prose(rng, 90)]))
        # Clean: other prose, the item's words in another order, and one half without the other.
        mixed = words[::-1]
        for clean in ([], mixed, words[: n // 2] if n >= 8 else [], words[-(n // 2) :] if n >= 8 else []):
            texts.append(" ".join([prose(rng, 90), *clean, prose(rng, 90)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, bench, near=True).collect()}
    assert got == want
    kept = decontaminate.without_items(docs, bench, near=True).collect()
    assert {r.doc_id for r in kept} == set(range(len(texts))) - {d for d, _ in want}
    exact = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, bench).collect()}
    assert exact < got


def test_question_and_answer_that_stand_apart(spark):
    rng = random.Random(7)
    question, answer = prose(rng, 24).split(), prose(rng, 24).split()
    text = " ".join([*question[3:21], prose(rng, 300), *answer[3:21]])
    docs = spark.createDataFrame([(1, text), (2, prose(rng, 300))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(question), " ".join(answer))], "item_id long, q string, a string")
    got = decontaminate.find_items(docs, bench, question_col="q", answer_col="a", near=True).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 5)]


def test_several_indexes_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 500)
    items, texts = items_and_texts(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected(items, texts)


def test_retrieval_is_that_of_scoring_every_item():
    items, texts = items_and_texts(4)
    index = decontaminate.Index([(i, *decontaminate.halves(t or "")) for i, t in items], threshold=0.2)
    import numpy as np

    for text in texts:
        words = decontaminate.words_of(text or "")[:60]
        terms = np.unique([index.terms[w] for w in words if w in index.terms]).astype(np.int64)
        if not len(terms):
            continue
        scores = [0.0] * len(index.items)
        for t in terms:
            for p in range(index.at[t], index.at[t + 1]):
                scores[index.item[p]] += index.score[p]
        want = {i for i, s in enumerate(scores) if s >= 0.2 - 1e-12}
        blocks = index.hopeful(index.heavy_words.intersection(words))
        assert {i for i, _ in index.retrieve(terms, blocks)} == want if blocks else not want


def test_passages_are_chosen_for_all_steps_at_once():
    """Every passage that may retrieve an item is looked at, and few others are."""
    dice = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(dice.choices(vocabulary, k=12)), " ".join(dice.choices(vocabulary, k=9))) for i in range(80)]
    index = decontaminate.Index(items, near=True)
    step = index.longest
    looked_at = 0
    for planted in range(40):
        words = dice.choices(vocabulary, k=dice.randint(1, 400))
        if planted % 2:
            at = dice.randrange(len(words))
            words[at:at] = items[planted][1].split()
        held = [index.heavy_words.intersection(words[a : a + step]) for a in range(0, len(words), step)]
        chosen = index._passages(held)
        passages = range(max(1, len(held) - 1))
        assert {k for k in passages if index.hopeful(held[k].union(*held[k + 1 : k + 2]))} <= set(chosen) <= set(passages)
        looked_at += len(chosen)
        assert not planted % 2 or planted in {index.wholes[i][0] for i in index.search(words)}
    assert looked_at > 20
    assert index._passages([set()]) == []
