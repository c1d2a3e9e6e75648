"""Byte-level BPE encoding and decoding (operator 10).

*Encoder.* The merges of a rank file are compiled into a finite-state
transducer that reads a piece byte by byte. Every prefix of a piece has one
encoding, and its last token follows from those of shorter prefixes: it is the
one token that ends there and that may stand after the token before it (two
tokens may stand side by side when merging their bytes gives them back). A
state holds what the future can still depend on: the last token written, the
bytes after it, and the last token of each prefix that a later token can start
from. Prefixes that no later token can start from are dropped, and when all
that are left pass through one place, the tokens up to there are written: the
lookahead is bounded by the longest tokens. States and transitions are made
when first met (lazy determinisation) and kept, up to a bound; states beyond it
last for one piece. Caches cost time when they are full and change no result.

Pieces are the matches of the split pattern. A piece that is itself a token is
that token. Texts are cut into chunks where no match of the pattern can cross
(``chunk_cuts``). Arrow finds the distinct chunks of a batch, as whole byte strings; each goes
through the transducer once, and its ids are kept for the batches that follow.

*Decoder.* Ids become the bytes of their tokens, which are fed, some tokens at a time, to
``Utf8Stream``, an incremental UTF-8 state machine: it holds an unfinished character back
until its last byte comes, and replaces what can't become one by U+FFFD. The ids of a text
always decode to its own bytes.

Defined results: null and empty texts have no ids and decode to no bytes.
Repeated rows give repeated results, an empty table an empty one. Columns of
the input with other names are not read.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, read_table, row_blocks, ship_package, text_buffer, worker_cache
from .word_ids import ALPHANUMERIC, PUNCTUATION, WordIds, byte_table, pieces, taken

#: What a worker keeps: states of the transducer, token pairs that were tried, chunks with their ids.
STATES, PAIRS, CHUNKS = 110_000, 50_000, 300_000
#: Tokens that are fed to the decoder at a time.
STREAM_TOKENS = 4096
#: Of each byte: a visible ASCII character.
VISIBLE = byte_table(lambda c: c.isprintable() and c != " ")
#: Above every rank: a pair that no merge joins.
NEVER = 1 << 40
#: Below it, Python and the pattern agree for good on what a letter is.
LATIN_END = "\u0250"
#: Bytes of text per batch that goes back to Spark.
OUT_BYTES = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of ``piece`` by the merge rule itself: join the pair of lowest rank, leftmost first."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    rank = ranks.get
    costs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while costs:
        best = min(costs)
        if best == NEVER:
            break
        i = costs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i < len(costs):
            costs[i] = rank(parts[i] + parts[i + 1], NEVER)
        if i:
            costs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
    return parts


class Transducer:
    """Lazily determinised transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES, pairs: int = PAIRS):
        self.ranks, self.most_states, self.most_pairs = ranks, states, pairs
        self.same = {t: t for t in ranks}  # one object per token, however many states hold it
        self.prefixes = {t[:i] for t in ranks for i in range(len(t) + 1)}
        self.pairs: dict[tuple[bytes | None, bytes], bool] = {}
        self._clear()

    def _clear(self) -> None:
        # A state: last token written (None if no token can follow it any more), pending bytes, last
        # token of each prefix of them (None: no longer needed). Moves are kept by state * 256 + byte.
        start = (None, b"", ())
        self.number, self.states = {start: 0}, [start]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.final: dict[int, tuple[int, ...]] = {}
        self.passing: list[int] = []  # moves to states above the bound; they last for one piece

    def _fits(self, left: bytes | None, token: bytes) -> bool:
        """Whether ``token`` may stand after ``left`` (at the start, if that is None)."""
        key = (left, self.same[token])
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            whole = [token] if left is None else [left, token]
            found = self.pairs[key] = merge(b"".join(whole), self.ranks) == whole
        return found

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Makes the transition of ``state`` on ``byte``: the next state and the ids written."""
        before, pending, last = self.states[state]
        pending += bytes((byte,))
        n, prefixes = len(pending), self.prefixes
        token, live = None, []
        for s in range(n):
            if s and last[s - 1] is None:
                continue
            tail = pending[s:]
            if tail in prefixes:
                live.append(s)
            if token is None and tail in self.ranks and self._fits(last[s - 1] if s else before, tail):
                token = self.same[tail]
        live.append(n)
        if live[0] == 0:  # a token can still start at the base: nothing is decided yet
            written = ()
            new = (before, pending, (*last, token))
        else:
            last = [*last, token]
            # Walk back from the live prefixes, longest first, until their paths have met.
            heads, passed = set(live), set(live)
            while len(heads) > 1:
                top = max(heads)
                heads.remove(top)
                top -= len(last[top - 1])
                heads.add(top)
                passed.add(top)
            base = at = heads.pop()
            written = []
            while at:
                written.append(last[at - 1])
                at -= len(last[at - 1])
            written.reverse()
            if base not in live:
                before = None
            elif written:
                before = written[-1]
            new = (before, pending[base:], tuple([last[k] if k + 1 in passed else None for k in range(base, n)]))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        if number >= self.most_states or state >= self.most_states:
            self.passing.append(state << 8 | byte)
        return number, tuple([self.ranks[t] for t in written])

    def _forget(self) -> None:
        """Drops the states above the bound."""
        for move in self.passing:
            del self.moves[move]
        for number in range(self.most_states, len(self.states)):
            del self.number[self.states[number]]
            self.final.pop(number, None)
        del self.states[self.most_states:]
        self.passing.clear()

    def _end(self, state: int) -> tuple[int, ...]:
        _, pending, last = self.states[state]
        out, at = [], len(pending)
        while at:
            out.append(self.ranks[last[at - 1]])
            at -= len(last[at - 1])
        return tuple(reversed(out))

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        out: list[int] = []
        state, moves = 0, self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = moves[state << 8 | byte] = self._step(state, byte)
            state, ids = move
            if ids:
                out += ids
        end = self.final.get(state)
        if end is None:
            end = self.final[state] = self._end(state)
        out += end
        if self.passing:
            self._forget()
        return out


def chunk_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the texts ``bounds`` of UTF-8 ``data`` can be cut, so that no match of the pattern crosses a cut.

    At a space between two characters that are not white space, before ASCII
    punctuation that follows an ASCII letter or digit, and at the bounds themselves. A
    character beside a space is taken for white space if its first bytes are those of one.
    """
    mark = np.zeros(len(data) + 1, bool)
    mark[bounds] = True
    if len(data) > 1:
        mark[1:-1] |= PUNCTUATION[data[1:]] & ALPHANUMERIC[data[:-1]]
    padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(2, np.uint8)])
    at = np.flatnonzero(data == 0x20)
    third, second, last, first, then = (padded[at + k] for k in (0, 1, 2, 4, 5))
    before = VISIBLE[last] | (last >= 0x80) & ~(
        (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third == 0xE1) & (second == 0x9A)
        | (third == 0xE2) & ((second == 0x80) | (second == 0x81)) | (third == 0xE3) & (second == 0x80))
    after = VISIBLE[first] | (first >= 0x80) & ~(
        (first == 0xC2) & ((then == 0x85) | (then == 0xA0)) | (first == 0xE1) & (then == 0x9A)
        | (first == 0xE2) & ((then == 0x80) | (then == 0x81)) | (first == 0xE3) & (then == 0x80))
    mark[at[before & after]] = True
    return np.flatnonzero(mark)


class Encoder:
    """Texts to ids: distinct chunks by Arrow, split pattern, transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, chunks: int = CHUNKS):
        self.transducer = Transducer(ranks)
        self.pieces = regex.compile(pattern).findall
        self.known = WordIds(self._learn, chunks)

    def whole(self, text: str) -> list[int]:
        """The ids of one chunk."""
        if text[:1] == " " and text[1:].isalpha() and max(text) < LATIN_END:  # letters after a space: one piece
            return self.transducer.encode(text.encode())
        out = []
        for piece in self.pieces(text):
            out += self.transducer.encode(piece.encode())
        return out

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = array("i"), np.empty(len(chunks), np.int64)
        for k, chunk in enumerate(chunks):
            own = self.whole(chunk)
            ids.extend(own)
            counts[k] = len(own)
        return np.array(ids, np.int32), counts

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text) of the texts ``bounds`` of ``raw``."""
        cuts = chunk_cuts(raw, bounds)
        found = pieces(raw, cuts)
        at, lists = self.known.find(found.dictionary)
        return taken(at[found.indices.to_numpy()], lists, np.searchsorted(cuts, bounds))


def _follow(byte: int) -> int:
    """Bytes that follow a first byte of UTF-8."""
    if 0xC2 <= byte <= 0xDF:
        return 1
    if 0xE0 <= byte <= 0xEF:
        return 2
    if 0xF0 <= byte <= 0xF4:
        return 3
    return 0


class Utf8Stream:
    """Incremental UTF-8 decoding: text as soon as its bytes are whole.

    The state is the unfinished character: up to three bytes held back.
    """

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:  # a first byte: unfinished if more must follow, and what follows may
                keep = back if _follow(byte) >= back and self._open(data[-back:]) else 0
                break
            if byte < 0x80:
                break
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    @staticmethod
    def _open(part: bytes) -> bool:
        """Whether more bytes can make ``part`` a character (no overlong form, surrogate or value too large)."""
        if len(part) < 2:
            return True
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(part[0], 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(part[0], 0xBF)
        return low <= part[1] <= high

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def _encoder(ranks_path: str, pattern: str) -> Encoder:
    return worker_cache("bpe", (ranks_path, pattern), lambda: Encoder(read_ranks(ranks_path), pattern))


def _tokens(ranks_path: str) -> pa.Array:
    """The bytes of every token by its id; null for an id that no token has."""
    def make() -> pa.Array:
        tokens = {i: t for t, i in read_ranks(ranks_path).items()}
        return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.large_binary())
    return worker_cache("bpe", (ranks_path,), make)


def encode_batches(batches: Iterator[pa.RecordBatch], ranks_path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, text) to batches (doc_id, ids)."""
    encoder = _encoder(ranks_path, pattern)
    for batch in batches:
        raw, bounds = text_buffer(batch.column(1))
        for a, b in row_blocks(bounds, OUT_BYTES):
            ids, lengths = encoder.encode(raw[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])
            pa.default_memory_pool().release_unused()  # the worker shares the executor's memory


def stream_text(data: bytes, ends: np.ndarray, tokens: int = STREAM_TOKENS) -> str:
    """The text of tokens that end at ``ends`` in ``data``, fed to the state machine some tokens at a time."""
    stream, at, out = Utf8Stream(), 0, []
    for k in range(tokens - 1, len(ends) + tokens - 1, tokens):
        end = int(ends[min(k, len(ends) - 1)])
        out.append(stream.feed(data[at:end]))
        at = end
    out.append(stream.close())
    return "".join(out)


def decode_batches(batches: Iterator[pa.RecordBatch], ranks_path: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, ids) to batches (doc_id, ids, decoded)."""
    tokens = _tokens(ranks_path)
    for batch in batches:
        ids = batch.column(1)
        first = ids.offsets.to_numpy()
        got = tokens.take(ids.values.slice(int(first[0]), int(first[-1] - first[0])))
        if got.null_count:
            raise ValueError("an id that no token has")
        first = first - first[0]
        ends = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1]
        data = pa.py_buffer(got.buffers()[2]) if got.buffers()[2] is not None else pa.py_buffer(b"")
        out = [stream_text(data.slice(int(ends[a]), int(ends[b] - ends[a])).to_pybytes(), ends[a + 1:b + 1] - ends[a])
               for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], ["doc_id", "ids", "decoded"])


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    ship_package(docs.sparkSession)
    return (docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text")),
            docs.schema["doc_id"].dataType.simpleString())


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of each row of ``docs``."""
    texts, kind = _texts(docs)
    return texts.mapInArrow(lambda batches: encode_batches(batches, ranks_path, pattern), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the text that the ids of each row stand for; null ids stand for none."""
    ship_package(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        lambda batches: decode_batches(batches, ranks_path), f"doc_id {kind}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass over the batches, so that the ids don't cross to the JVM in between."""
    texts, kind = _texts(docs)
    return texts.mapInArrow(lambda batches: decode_batches(encode_batches(batches, ranks_path, pattern), ranks_path),
                            f"doc_id {kind}, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(encode_and_decode(docs, path, public_tokenizers.PATTERN))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs)


QUERIES = {"op10_bpe_transducer": op10_bpe_transducer}
ORACLE_SQL: dict[str, str] = {}
