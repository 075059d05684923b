"""Sparse features of texts, computed with numpy over whole Arrow columns."""

from __future__ import annotations

import numpy as np

from studylake.llm.common import _U, grams, mix, string_buffers, words

#: Byte classes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 white space, 5 line end, 6 sentence mark, 7 other ASCII sign, 8 beyond ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[32, 9, 11, 12, 13]] = 4
_CLASS[10] = 5
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 6
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 7
_CLASS[128:] = 8
N_CLASS = 9

STATS = ("log_bytes", "log_words", "word_bytes", "longest_word", "lower", "upper", "digit", "space", "line_end", "sentence", "sign", "wide",
         "distinct_words", "distinct_trigrams", "distinct_lines", "signed_words", "upper_words", "log_n_chars")


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _distinct(keys: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys per owner, told apart by 44 bits of the key."""
    k = np.sort((own.astype(_U) << _U(44)) | (mix(keys) >> _U(20)))
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    return np.bincount((k[new] >> _U(44)).astype(np.int64), minlength=n)


class Texts:
    """Word hashes and structure statistics of an Arrow string column."""

    def __init__(self, column):
        self.data, self.off = string_buffers(column)
        self.n = len(self.off) - 1
        self.hash, self.start, self.end, self.first = words(self.data, self.off)
        self.own = np.repeat(np.arange(self.n), np.diff(self.first))

    def hashed_words(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, count, first): the distinct word buckets of text i are first[i]:first[i + 1]."""
        key, count = np.unique((self.own.astype(np.int64) << bits) | (self.hash >> _U(64 - bits)).astype(np.int64), return_counts=True)
        return key & ((1 << bits) - 1), count, np.searchsorted(key >> bits, np.arange(self.n + 1))

    def stats(self, n_chars: np.ndarray | None = None) -> np.ndarray:
        """One row of STATS per text; empty texts have zeros."""
        n, off = self.n, self.off
        size = np.diff(off).astype(float)
        text_of = np.repeat(np.arange(n), np.diff(off))
        kinds = np.zeros(n * N_CLASS)
        for lo in range(0, len(self.data), 1 << 22):  # in blocks: bounded memory for very long texts
            b = slice(lo, lo + (1 << 22))
            kinds += np.bincount(text_of[b] * N_CLASS + _CLASS[self.data[b]], minlength=n * N_CLASS)
        kinds = kinds.reshape(n, N_CLASS)
        share = kinds / np.maximum(size, 1)[:, None]
        n_words = np.diff(self.first).astype(float)
        length = self.end - self.start
        longest = np.zeros(n)
        some = np.flatnonzero(np.diff(self.first))
        if len(some):
            longest[some] = np.maximum.reduceat(length, self.first[some])
        last = self.data[self.end - 1] if len(self.end) else np.zeros(0, dtype=np.uint8)
        lead = self.data[self.start] if len(self.start) else last
        second = self.data[np.minimum(self.start + 1, self.end - 1)] if len(self.start) else last
        g, at = grams(self.hash, self.first, 3)
        tri = np.bincount(self.own[at], minlength=n) if len(at) else np.zeros(n)
        ends = np.flatnonzero(self.data == 10)
        line_start = np.unique(np.r_[off[:-1], ends + 1])
        line_start = line_start[line_start < len(self.data)]
        if len(line_start):
            # a line's hash: the sum of the mixed hashes of its words, in order of place
            total = np.zeros(len(self.hash) + 1, dtype=_U)
            np.cumsum(mix(self.hash), out=total[1:])
            w = np.searchsorted(self.start, np.r_[line_start, len(self.data)])
            line = total[w[1:]] - total[w[:-1]]
            owner = np.searchsorted(off, line_start, side="right") - 1
            full = w[1:] > w[:-1]
            lines = np.bincount(owner[full], minlength=n)
            distinct_lines = _distinct(line[full], owner[full], n) / np.maximum(lines, 1)
        else:
            distinct_lines = np.zeros(n)
        letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
        chars = np.zeros(n) if n_chars is None else np.nan_to_num(n_chars.astype(float))
        per_word = np.maximum(n_words, 1)
        return np.column_stack([
            np.log1p(size), np.log1p(n_words), size / per_word, longest,
            share[:, 1], kinds[:, 2] / letters, share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 7], share[:, 8],
            _distinct(self.hash, self.own, n) / per_word,
            _distinct(g, self.own[at], n) / np.maximum(tri, 1) if len(at) else np.zeros(n),
            distinct_lines,
            _per_text((_CLASS[last] == 7).astype(float), self.first) / per_word,
            _per_text(((_CLASS[lead] == 2) & (_CLASS[second] == 2)).astype(float), self.first) / per_word,
            np.log1p(np.maximum(chars, 0)),
        ])
