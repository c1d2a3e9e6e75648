import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from blocklot.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = "ab cdeéß漢字😀\n\t  '’sllveTHE the 0123½!!--___    \x1c\x85.,"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                             special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def all_ids(encoder, texts):
    parts = [t.encode() for t in texts]
    found, lengths = encoder.encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    ends = np.cumsum(lengths)
    return [found[e - n:e].tolist() for e, n in zip(ends.tolist(), lengths.tolist())]


def ids(encoder, text):
    return all_ids(encoder, [text])[0]


def test_encoding_equals_the_library(encoder, reference, documents):
    random.seed(1)
    texts = ["".join(random.choice(ALPHABET) for _ in range(random.randint(0, 40))) for _ in range(4000)]
    texts += [random.choice("ab") * random.randint(1, 500) for _ in range(50)]
    texts += ["".join(random.choices("abcdefgtheiongr", k=400)) for _ in range(50)]
    texts += [r.text for r in documents.select("text").collect()]
    for a in range(0, len(texts), 700):
        for t, got in zip(texts[a:a + 700], all_ids(encoder, texts[a:a + 700])):
            assert got == reference.encode_ordinary(t), t


def test_white_space_and_punctuation_at_the_cuts(encoder, reference):
    random.seed(4)
    marks = ["a", "B", "9", "é", "漢", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x00", "\x7f", "\x85", "\xa0",
             "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "\ufeff", "’", "'s", "'ll", "'", "''", ".", ",,", "_",
             "-", "<|", "\u0301", "½", "😀"]
    texts = ["".join(random.choice(marks) for _ in range(random.randint(0, 12))) for _ in range(20_000)]
    for a in range(0, len(texts), 500):
        for t, got in zip(texts[a:a + 500], all_ids(encoder, texts[a:a + 500])):
            assert got == reference.encode_ordinary(t), repr(t)


def test_small_caches_change_nothing(encoder):
    small = bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN, chunks=5)
    small.transducer.most_states, small.transducer.most_pairs = 20, 10
    random.seed(2)
    for _ in range(300):
        t = "".join(random.choice(ALPHABET) for _ in range(30)) + "漢" * random.choice([0, 0, 200])
        assert ids(small, t) == ids(encoder, t)


def test_transducer_equals_the_merge_rule_on_a_small_vocabulary():
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate([b"ab", b"bc", b"abc", b"ca", b"aa", b"aab", b"caa", b"abcab", b"bcabc"]):
        ranks[t] = 256 + k
    random.seed(3)
    machine = bpe.Transducer(ranks)
    for _ in range(3000):
        piece = bytes(random.choices(b"abc", k=random.randint(1, 14)))
        want = [ranks[piece]] if piece in ranks else [ranks[t] for t in bpe.merge(piece, ranks)]
        assert machine.encode(piece) == want, piece


def test_streaming_decode_at_every_cut():
    text = "aé漢😀z".encode() + b"\xe2\x82" + b"A\xed\xa0\x80B\xf0\x9f" + "ü".encode() + b"\xff\xc2"
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            stream = bpe.Utf8Stream()
            out = stream.feed(text[:a]) + stream.feed(text[a:b]) + stream.feed(text[b:]) + stream.close()
            assert out == text.decode("utf-8", "replace")


def test_decoding_streams_over_tokens(encoder, reference):
    text = "aé漢😀 words, words\x00 ß" * 30
    found = ids(encoder, text)
    parts = [reference.decode_single_token_bytes(i) for i in found]
    ends = np.cumsum([len(p) for p in parts])
    for tokens in (1, 2, 7, 4096):
        assert bpe.stream_text(b"".join(parts), ends, tokens) == text
    assert bpe.stream_text(b"", np.empty(0, np.int64)) == ""


def test_streaming_decode_gives_a_character_with_its_last_byte():
    stream = bpe.Utf8Stream()
    assert [stream.feed(bytes([b])) for b in "😀é".encode()] == ["", "", "", "😀", "", "é"]


def test_query_on_edge_cases(docs, reference):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "Hello, the world's  end."), (4, "Hello, the world's  end."),
            (None, "漢字 😀"), (5, "word " * 30_000), (6, "<|endoftext|>")]
    got = sorted(bpe.round_trip(docs(rows)).collect(), key=repr)
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        x = reference.encode_ordinary(t or "")
        want.append((i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_encode_then_decode_equals_one_pass(docs, rows_of):
    df = docs([(1, "a b"), (2, None)])
    two = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    assert rows_of(two) == rows_of(bpe.encode_and_decode(df, PATH, public_tokenizers.PATTERN))


def test_empty_table(docs):
    assert bpe.round_trip(docs([])).count() == 0
