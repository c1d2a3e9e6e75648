import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blocklot.llm import packed_ids as pk
from blocklot.llm.common import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 20, 31, 32])
def test_pack_and_unpack_any_range(width):
    x = np.random.default_rng(width).integers(0, 1 << width, 3000, dtype=np.uint64).astype(np.uint32)
    block = pk.pack(x, width)
    assert len(block) == (3000 * width + 7) // 8 + 8
    for a, b in ((0, 3000), (1, 2), (1234, 1300), (2999, 3000), (7, 7)):
        assert (pk.unpack(block, width, a, b) == x[a:b]).all()


def test_width_is_the_minimum():
    assert [pk.width_of(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("width", [5, 16])
def test_file_random_access(width):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 50, 200)
    ids = rng.integers(0, 1 << width, lengths.sum()).astype(np.uint32)
    writer = pk.Writer(width, block_ids=64)
    cut = np.concatenate([[0], np.cumsum(lengths)])
    for a in range(0, 200, 30):
        b = min(200, a + 30)
        writer.add(ids[cut[a]:cut[b]], lengths[a:b])
    out = io.BytesIO()
    writer.write(out)
    reader = pk.Reader(io.BytesIO(out.getvalue()))
    assert (reader.width, reader.total, reader.docs) == (width, len(ids), 200)
    for k in rng.permutation(200)[:60].tolist():
        assert (reader.document(k) == ids[cut[k]:cut[k + 1]]).all()
    assert (reader.ids(0, len(ids)) == ids).all()


def buffers(texts):
    parts = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def same_as_the_library(texts, size=500, cache=1000):
    want = [e.ids + [2] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    encoder = pk.WordEncoder(PATH, 2, cache=cache)
    for a in range(0, len(texts), size):
        ids, lengths = encoder.encode(*buffers(texts[a:a + size]))
        cut = np.concatenate([[0], np.cumsum(lengths)])
        for k in range(len(lengths)):
            assert ids[cut[k]:cut[k + 1]].tolist() == want[a + k], texts[a + k]


def test_word_encoder_equals_the_library(documents):
    import random
    random.seed(2)
    parts = list("ab cdeéß漢字😀\n\t  '’sllveTHE the 0123½!!--___    \x1c\x85é́İΣς가각ᄀ")
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    texts += [r.text for r in documents.select("text").collect()]
    same_as_the_library(texts)
    same_as_the_library(texts, 4000, 10)


def test_special_strings_are_what_the_library_makes_of_them():
    import random
    random.seed(5)
    parts = ["<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<|", "|>", "<", " ", "a", "B,", "\n", ".", "é"]
    same_as_the_library(["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(1500)], 7)


def test_control_characters_and_word_ends():
    import random
    random.seed(6)
    same_as_the_library(["hello", "a\x00b", "a", "cat", "a cat"])
    control = [chr(i) for i in range(0x20)] + ["\x7f", "\x80", "\xa0", "\u2028", "\ufeff", "\u0301", "\u0338", "\u200d"]
    marks = list(".,;:'\"!?<>=_~%&*") + ["'s", "n't", "a", "B", "9", "é", "…", " ", " "]
    same_as_the_library(["".join(random.choice("a " + "".join(control)) for _ in range(random.randint(0, 8))) for _ in range(2000)], 50)
    same_as_the_library(["".join(random.choice(marks + ["\u0338"]) for _ in range(random.randint(0, 9))) for _ in range(3000)], 11)


def test_query_equals_brute_force(spark, docs):
    rows = [(7, "the end"), (3, None), (5, ""), (1, "Word " * 20_000), (None, "null id"), (9, "é漢 😀!"), (4, "b"), (4, "b"),
            (11, "a\x00b"), (12, "x<|endoftext|>y")]
    library = Tokenizer.from_file(PATH)
    manifest, where = pk.write_packed(docs(rows).repartition(3), PATH, shared_path(spark, "test-packed"))
    got = where.join(pk.read_packed(manifest), ["shard", "place"]).collect()
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=lambda r: r[1]) == want


def test_empty_table(spark, docs):
    manifest, where = pk.write_packed(docs([]), PATH, shared_path(spark, "test-packed"))
    assert where.join(pk.read_packed(manifest), ["shard", "place"]).count() == 0
