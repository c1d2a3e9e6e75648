"""Ids of distinct words, kept from batch to batch in Arrow and numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A longer word (in bytes) is encoded anew in each batch where it stands.
LONGEST = 128


class WordIds:
    """Number 0 stands for ``mark``, the ids of no word; every other number for a word that was learnt.

    ``learn`` takes a list of words and gives (ids of all one after the other, ids per word).
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int, mark: Sequence[int] = ()):
        self.learn, self.most = learn, most
        self.words = pa.array([None], pa.large_string())
        self.flat, self.first = np.array(mark, np.int32), np.array([0, len(mark)], np.int64)

    def _forget(self) -> None:
        """Drops the older half of the words."""
        n = len(self.words) // 2
        marks, size = int(self.first[1]), int(self.first[-1] - self.first[n])
        self.words = pa.concat_arrays([self.words.slice(0, 1), self.words.slice(n)])
        self.flat = np.concatenate([self.flat[:marks], self.flat[len(self.flat) - size:]])
        self.first = np.concatenate([[0], self.first[n:] - self.first[n] + marks])

    def find(self, words: pa.Array) -> tuple[np.ndarray, pa.LargeListArray]:
        """(number of each of ``words``, which are distinct; ids by number), good until the next call."""
        if len(self.words) > self.most:
            self._forget()
        found = pc.index_in(words, value_set=self.words)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        flat, first = self.flat, self.first
        if found.null_count:
            missing = found.is_null()
            new = words.filter(missing)
            size = pc.binary_length(new).to_numpy()
            # Words that are kept come first, so that they have the same numbers afterwards.
            order = np.argsort(size > LONGEST, kind="stable")
            short = int((size <= LONGEST).sum())
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            at[missing.to_numpy(zero_copy_only=False)] = len(self.words) + place
            new = new.take(pa.array(order))
            ids, counts = self.learn(new.to_pylist())
            flat = np.concatenate([flat, ids.astype(np.int32)])
            first = np.concatenate([first, first[-1] + np.cumsum(counts)])
            if short:
                self.words = pa.concat_arrays([self.words, new.slice(0, short)])
            self.first = first[:len(self.words) + 1]
            self.flat = flat[:self.first[-1]]
        return at, pa.LargeListArray.from_arrays(pa.array(first), pa.array(flat))


def taken(at: np.ndarray, lists: pa.LargeListArray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the words numbered ``at``, one after the other; ids in each range ``stop``[k] to ``stop``[k + 1] of them)."""
    total = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy())[at])])
    return lists.take(pa.array(at)).flatten().to_numpy(), np.diff(total[stop])


def byte_table(kind: Callable[[str], bool]) -> np.ndarray:
    """Whether each byte is an ASCII character of a kind."""
    return np.array([kind(chr(i)) if i < 128 else False for i in range(256)])


#: Of each byte: ASCII punctuation, ASCII letter or digit.
PUNCTUATION = byte_table(lambda c: c.isprintable() and not c.isalnum() and c != " ")
ALPHANUMERIC = byte_table(str.isalnum)


def pieces(data: np.ndarray, cuts: np.ndarray) -> pa.DictionaryArray:
    """The strings between ``cuts`` of UTF-8 ``data``, each distinct one once; compared whole, byte by byte."""
    return pa.LargeStringArray.from_buffers(
        len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
