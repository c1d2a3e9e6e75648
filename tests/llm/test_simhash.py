import random

import numpy as np
import xxhash

from blocklot.llm import simhash
from blocklot.llm.components import components


def brute_fingerprint(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """{doc: smallest doc reachable} for (doc, fingerprint) pairs."""
    parent = {i: i for i, _ in pairs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, x in pairs:
        for b, y in pairs:
            if a < b and (x ^ y).bit_count() <= 3:
                r, s = sorted((find(a), find(b)))
                parent[s] = r
    return {i: find(i) for i, _ in pairs}


def test_fingerprint_equals_its_definition():
    random.seed(1)
    texts = [None, "", " \n", "one", "One two", "a b c", "Éa éA b", "x\x1cy z w", "a b c d e"]
    texts += [" ".join(random.choice(["a", "Bc", "déf", "x\ny"]) for _ in range(random.randint(0, 40))) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t


def test_fingerprint_of_a_text_of_many_chunks(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    import itertools
    for k in range(1, 4):
        for bits in itertools.combinations(range(64), k):
            diff = sum(1 << b for b in bits)
            assert any(not m & diff for m in masks)


def test_refined_buckets_lose_no_pair_and_are_bounded():
    random.seed(2)
    for m in simhash.covering_masks():
        level = [m]
        for _ in range(simhash.REFINEMENTS):
            level = [f for x in level for f in simhash.finer_masks(x)]
        assert all(64 - (x & (1 << 64) - 1).bit_count() <= 14 for x in level)
        free = [i for i in range(64) if not m >> i & 1]
        for _ in range(200):
            diff = sum(1 << i for i in random.sample(free, 3))
            assert any(not f & diff for f in simhash.finer_masks(m))


def test_query_links_equal_brute_force(spark, docs):
    random.seed(3)
    base = " ".join(random.choice("abcdefgh") + str(i) for i in range(400))
    rows = [(100 + i, base.replace(f" a{i}", "") if i % 2 else base + f" tail{i}") for i in range(40)]
    rows += [(i, " ".join(random.choices(["red", "green", "blue", "up"], k=random.randint(0, 9)))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, " "), (203, base), (203, base)]
    got = simhash.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    prints = {(i, brute_fingerprint(t)) for i, t in rows}
    want = brute_components(sorted(prints))
    for r in got:
        assert (r.doc_id, r.fp & (1 << 64) - 1) in prints
        assert r.component_id == want[r.doc_id]


def test_small_buckets_give_the_same_components(spark):
    """A cluster of thousands of fingerprints: refining its buckets changes nothing."""
    rng = np.random.default_rng(4)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 700:
        fps.add(int(rng.choice(list(fps))) ^ (1 << int(rng.integers(64))))
    fps |= {int(x) for x in rng.integers(1, 1 << 62, 200)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    want = brute_components([(x, x & (1 << 64) - 1) for x in signed])
    for bucket in (4, 5000):
        got = {r.node: r.root for r in components(simhash.links(nodes, bucket)).collect()}
        roots = {x: got.get(x, x) for x in signed}
        classes, expected = {}, {}
        for x in signed:
            classes.setdefault(roots[x], set()).add(x)
            expected.setdefault(want[x], set()).add(x)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (1000, 1001), (1001, 1000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1200)}


def test_keep_one_of_each_component(docs):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (2, None), (4, "q w e r t y"), (None, "only one"), (1, "a b c d e")]
    df = docs(rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert len(got) == 4 and (2, "") in got and (4, "q w e r t y") in got and (1, "a b c d e") in got


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0
