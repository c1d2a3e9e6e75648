import random

import numpy as np
import pytest

from blocklot.llm import decontaminate as dc


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(1)
    common = words(rng, 60)
    items = [words(rng, 30) for _ in range(12)] + [common[:3] * 12]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [
        (50, None), (51, "too short item"), (52, " ".join(items[3]))], "item_id long, text string")

    def fill(n):
        return [rng.choice(common) for _ in range(n)]

    edited = items[1][:]
    for k in range(0, 30, 7):
        edited[k] = "changed"
    shorter = [w for k, w in enumerate(items[2]) if k % 8]
    longer = [x for k, w in enumerate(items[4]) for x in ([w, "more"] if k % 6 == 0 else [w])]
    rows = [(1, fill(200) + items[0] + fill(100)), (2, fill(50) + edited), (3, shorter + fill(9)), (4, fill(400)),
            (5, items[3]), (6, longer), (7, fill(3) + items[5][:8] + fill(60)), (8, items[6][:18] + fill(30)),
            (9, fill(5000) + [w.upper() for w in items[7]] + fill(5000) + items[8])]
    rows = [(i, "\n ".join(", ".join(w[k:k + 9]) for k in range(0, len(w), 9))) for i, w in rows]
    rows += [(10 + i, " ".join(fill(20) + items[9])) for i in range(40)]  # an item that leaked into much of the corpus
    return bench, rows + [(100, None), (101, ""), (1, rows[0][1]), (None, " ".join(items[10]))]


WANT = {(1, 0), (2, 1), (3, 2), (5, 3), (5, 52), (6, 4), (8, 6), (9, 7), (9, 8), (None, 10)} | {(10 + i, 9) for i in range(40)}


def test_verbatim_and_edited_copies_are_found(case, docs):
    bench, rows = case
    got = dc.contaminated(docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == WANT and len(got) == len(WANT) + 1
    exact = next(r for r in got if r.doc_id == 1)
    assert exact.score == 1 and (exact.first_word, exact.end_word) == (200, 230)


def test_blocks_of_the_benchmark_give_the_same(case, docs, monkeypatch):
    bench, rows = case
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 4)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(docs(rows), bench).collect()} == WANT


def test_clean_keeps_whole_rows(case, docs):
    bench, rows = case
    df = docs(rows)
    out = dc.clean(df, bench)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [4, 7, 100, 101]


def test_equals_alignment_of_every_pair(spark):
    """Seeds lose nothing on the sample tables: every pair aligned by a plain Smith-Waterman."""
    sf = "/root/testdata/sf0.001"
    bench, df = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("benchmark", "documents"))

    def split(t):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        return dc.word_hashes(raw, np.array([0, len(raw)]))[0]
    items = {r.item_id: split(r.text) for r in bench.collect()}
    want = set()
    for r in df.collect():
        w = split(r.text)
        for i, item in items.items():
            if dc.MATCH * np.isin(w, item).sum() >= dc.least_score(len(item)):
                if dc.smith_waterman(w, item)[0] >= dc.least_score(len(item)):
                    want.add((r.doc_id, i))
    assert {(r.doc_id, r.item_id) for r in dc.op3_decontaminate(spark, sf).collect()} == want and want


def test_smith_waterman_equals_the_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 15)).astype(np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH),
                              h[i - 1, j] + dc.GAP, h[i, j - 1] + dc.GAP)
        score, s, e = dc.smith_waterman(a, b)
        assert score == h.max()
        if score:
            assert dc.smith_waterman(a[s:e], b)[0] == score


def test_empty_tables(case, docs, spark):
    bench, rows = case
    assert dc.contaminated(docs([]), bench).count() == 0
    none = bench.where("false")
    assert dc.contaminated(docs(rows), none).count() == 0 and dc.clean(docs(rows), none).count() == len(rows)


def hits(spark, docs, items, rows):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in dc.contaminated(docs(rows), bench).collect()}


def test_short_items(spark, docs):
    items = ["What is the capital of France?", "red green blue", "Paris", "New York", "?!", "four words are few"]
    rows = [(1, "lorem ipsum. WHAT is the capital, of France and so on"), (2, "what is the big capital of France"),
            (3, "what is the capital of"), (4, "red green blue"), (5, "red green red green blue"), (6, "Paris"),
            (7, "in Paris and New York"), (8, "new york!"), (9, "is the capital of Spain? What"), (10, "?!"),
            (11, "what is the capital city of all France"), (12, "what is the name of France"), (13, "red green blues"),
            (14, "four words are so few"), (15, "four words are many")]
    found = hits(spark, docs, items, rows)
    assert found.keys() == {(1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 2), (8, 3), (11, 0), (12, 0), (14, 5)}
    at = found[1, 0]
    assert (at.score, at.first_word, at.end_word) == (1, 2, 8)
    assert (found[8, 3].first_word, found[8, 3].end_word) == (0, 2)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert sorted(r.doc_id for r in dc.clean(docs(rows), bench).collect()) == [7, 9, 10, 13, 15]


def test_scripts_without_spaces(spark, docs):
    items = ["世界上最高的山峰叫什么名字？", "日本の首都はどこですか。", "เมืองหลวงของประเทศไทยคืออะไร", "法国的首都"]
    rows = [(i, f"前文这里{t}后面还有" + "字" * 30) for i, t in enumerate(items)]
    rows += [(10, "「世界上，最高的山峰——叫甚么名字」"), (11, "完全没有关系的一段文字，谈的是天气和农业。"), (12, "法国美丽的首都"),
             (13, "美国的首都")]
    assert hits(spark, docs, items, rows).keys() == {(0, 0), (1, 1), (2, 2), (3, 3), (10, 0), (12, 3), (13, 3)}


def hashed(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return dc.word_hashes(raw, np.array([0, len(raw)]))[0]


def grams(w):
    return {tuple(w[k:k + 3].tolist()) for k in range(len(w) - 2)}


@pytest.mark.parametrize("length", [3, 4, 5, 6, 7, 8, 12, 40])
def test_copies_with_many_edits_equal_all_pairs(spark, docs, length):
    """Copies with words put in, left out and changed, against the alignment of every pair that shares a seed."""
    rng = random.Random(length)
    items = [words(rng, length) for _ in range(8)]
    rows = []
    for k in range(240):
        item, rate = rng.choice(items), rng.choice([0.05, 0.2, 0.4])
        copy = []
        for w in item:
            kind = rng.random() / rate
            copy += [] if kind < 0.3 else [rng.choice(["changed", "other"])] if kind < 0.6 else [w] + ["put", "in"][:rng.randint(1, 2)] \
                if kind < 1 else [w]
        rows.append((k, " ".join(words(rng, rng.randint(0, 5)) + copy + words(rng, rng.randint(0, 5)))))
    # Two words put in after every second one, the last words intact: a copy of nearly twice the item's length.
    stretched = [x for i, w in enumerate(items[0]) for x in ([w, "put", "in"] if i % 2 and i < length - 12 else [w])]
    rows.append((1000, " ".join(stretched)))
    want = {}
    for d, t in rows:
        for i, item in enumerate(items):
            w, target = hashed(t), hashed(" ".join(item))
            score = dc.smith_waterman(w, target)
            if score[0] >= dc.least_score(length) and grams(w[score[1]:score[2]]) & grams(target):
                want[d, i] = score[0] / (2 * length)
    got = hits(spark, docs, [" ".join(w) for w in items], rows)
    assert got.keys() == want.keys() and len(want) > 20
    assert (1000, 0) in got
    assert all(abs(got[k].score - want[k]) < 1e-9 for k in want)


def test_rare_seeds_are_the_rarer_half():
    block = dc.Items([1, 2], ["a b c d e f g", "c d e x y z"])
    counts = np.arange(len(block.distinct))[::-1].copy()
    block.mark_rare(counts)
    for item in (0, 1):
        own = block.owner == item
        n = counts[np.searchsorted(block.distinct, block.grams[own])]
        assert sorted(n[block.rare[own]]) == sorted(n)[:(len(n) + 1) // 2]


def test_words_of_mixed_text():
    def split(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return dc.word_hashes(raw, np.array([0, len(raw)]))[0].tolist()
    for text, words in [("Été，naïve—word", ["été", "naïve", "word"]), ("x≤5€", ["x", "≤", "5", "€"]),
                        ("GPT是什么", ["gpt", "是", "什", "么"]), ("नमस्ते।दुनिया", ["नमस्ते", "दुनिया"]), ("한국어 말", ["한국어", "말"]),
                        ("。，", []), ("😀a\u2028𠀀b", ["😀", "a", "𠀀", "b"]), ("", [])]:
        assert split(text) == [split(w)[0] for w in words], text
    raw = np.frombuffer("é山山é".encode(), np.uint8)
    assert dc.word_hashes(raw, np.array([0, 2, 5, 5, 10]))[1].tolist() == [0, 1, 2, 2, 4]


def test_seeds_that_are_common_in_the_corpus_find_edited_copies(spark, docs):
    """All pairs, where the intact 3-grams of a copy are the commonest of its item."""
    rng = random.Random(7)
    items = [words(rng, 24) for _ in range(12)]
    rows = [(100 * i + k, " ".join(words(rng, 5) + item[:10])) for i, item in enumerate(items) for k in range(30)]
    rows += [(5000 + i, " ".join(w if k < 10 or k % 3 != 1 else "changed" for k, w in enumerate(item)))
             for i, item in enumerate(items)]

    def split(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return dc.word_hashes(raw, np.array([0, len(raw)]))[0]
    want = {(d, i) for i, item in enumerate(items) for d, t in rows
            if dc.smith_waterman(split(t), split(" ".join(item)))[0] >= dc.THRESHOLD * dc.MATCH * 24}
    assert want >= {(5000 + i, i) for i in range(12)}
    assert hits(spark, docs, [" ".join(w) for w in items], rows).keys() == want


def test_items_of_one_text_go_to_different_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 50)
    bench = spark.createDataFrame([(i, "one and the same text of a benchmark") for i in range(200)], "item_id long, text string")
    sizes = [len(b.value.ids) for b in dc.blocks(docs([(1, "x")]), bench)]
    assert sum(sizes) == 200 and len(sizes) == 4 and max(sizes) < 100
