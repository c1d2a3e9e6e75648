import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from blocklot.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_witness(levels, k):
    out = []
    for nodes in levels[:-1]:
        if k % 2:
            out.append((merkle.LEFT, nodes[k - 1]))
        else:
            out.append((merkle.RIGHT, nodes[k + 1]) if k + 1 < len(nodes) else (merkle.NONE, ""))
        k //= 2
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 33, 70])
def test_appender_equals_the_plain_tree(n):
    nodes = [h(str(k)) for k in range(n)]
    levels = plain_levels(nodes)
    tree = merkle.Appender(None)
    for x in nodes:
        tree.append(x)
    assert tree.close() == levels[-1][0]
    for k in range(n):
        assert tree.witness[k] == plain_witness(levels, k)
        assert merkle.fold(nodes[k], tree.witness[k]) == levels[-1][0]


def test_open_subtrees_have_their_partial_witnesses():
    nodes = [h(str(k)) for k in range(6)]
    tree = merkle.Appender(None)
    for x in nodes:
        tree.append(x)
    assert [o[0] for o in tree.open] == [2, 1]
    assert [len(w) for w in tree.witness] == [2, 2, 2, 2, 1, 1]


def test_a_block_is_lifted_to_its_height():
    tree = merkle.Appender(3)
    tree.append("x")
    assert tree.close() == h(h(h("x"))) and tree.witness[0] == [(merkle.NONE, "")] * 3


def plain(rows):
    """The contract, row by row: (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    def leaf(r, more=0):
        i, text, lang, source, n = r
        fields = (i, source, lang, None if n is None else n + more, text)
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = plain_levels([leaf(r) for r in groups[lang]])
    top = plain_levels([trees[lang][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        for k, r in enumerate(groups[lang]):
            witness = plain_witness(trees[lang], k) + plain_witness(top, g)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = merkle.fold(leaf(r, 1 if hit else 0), witness)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], h(*[s for _, s in witness]), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def query(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, 9, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, "
                               "n_chars long, at long, node string, group string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in merkle.op13_merkle(spark, str(tmp_path)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, merkle.BLOCK_LEVELS])
def test_query_equals_the_plain_version(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (levels,))
    random.seed(levels)
    rows = [(i, random.choice(["", "é" * 3, None, "text\x00", "w " * 9000]), random.choice(["en", "en", "en", "é", None, "E", ""]),
             random.choice(["a", None]), random.choice([None, 5, -1])) for i in range(77)]
    rows += [(None, "t", "en", "a", 1), (None, None, None, None, None), (3, "t", "en", "a", 1), (3, "t", "en", "a", 1), (-7, "only", "zz", "a", 2)]
    got = query(spark, rows, tmp_path)
    assert got == plain(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_one_row_and_one_group(spark, tmp_path):
    row = (5, "text", "en", "src", 4)
    [got] = query(spark, [row], tmp_path)
    assert got[1] == got[2] == got[3] and got[4] == h("") and [got] == plain([row])


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == []


def test_missing_columns_count_as_null(spark):
    rows = spark.createDataFrame([(1,), (2,)], "doc_id long")
    assert sorted(r.node for r in merkle.document_leaves(rows).collect()) == sorted(h(f"1:{i}----") for i in (1, 2))


def test_fold_of_a_changed_leaf_differs(spark):
    leaves = spark.range(20).select(F.lit("en").alias("lang"), F.col("id").alias("doc_id"), F.sha2(
        F.col("id").cast("string").cast("binary"), 256).alias("node"))
    found = merkle.manifest(leaves, levels=2).select("root", merkle.folded(F.col("node"), F.col("witness")).alias("same"),
                                                   merkle.folded(F.lit("x"), F.col("witness")).alias("other")).collect()
    assert all(r.same == r.root != r.other for r in found) and len(found) == 20
