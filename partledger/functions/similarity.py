"""Edit similarity of many strings at once.

``ratio = 2 * LCS(a, b) / (len(a) + len(b))``. The longest common subsequence is counted with the bit-parallel
recurrence of Crochemore et al. (2001) and Hyyrö (2004): one 64-bit word per string of the block, one step per
character of the other string. Strings beyond 64 characters use Python's long integers, one pair at a time.
"""

from __future__ import annotations

import numpy as np

WORD = 64


def lcs_length(a: str, b: str) -> int:
    """LCS of two strings of any length."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


class StringBlock:
    """Strings prepared for ``ratios``; those that fit a word are compared together."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.short = np.flatnonzero(self.lengths <= WORD)
        self.long = np.flatnonzero(self.lengths > WORD)
        letters = sorted({ch for i in self.short for ch in strings[i]})
        self.column = {ch: n for n, ch in enumerate(letters)}
        self.masks = np.zeros((len(letters), len(self.short)), dtype=np.uint64)
        for row, i in enumerate(self.short):
            for place, ch in enumerate(strings[i]):
                self.masks[self.column[ch], row] |= np.uint64(1 << place)
        widths = self.lengths[self.short]
        self.full = np.array([(1 << int(w)) - 1 for w in widths], dtype=np.uint64)

    def ratios(self, text: str) -> np.ndarray:
        """Similarity of ``text`` to every string of the block: 1 for equal, 0 if just one is empty."""
        common = np.zeros(len(self.strings), dtype=np.int64)
        if len(self.short):
            v = np.full(len(self.short), np.iinfo(np.uint64).max, dtype=np.uint64)
            for ch in text:
                at = self.column.get(ch)
                if at is not None:
                    u = v & self.masks[at]
                    v = (v + u) | (v - u)
            common[self.short] = np.bitwise_count(~v & self.full)
        for i in self.long:
            common[i] = lcs_length(text, self.strings[i])
        total = self.lengths + len(text)
        return np.where(total == 0, 1.0, 2.0 * common / np.maximum(total, 1))


def pair_ratios(left: list[str], right: list[str], step: int = 2048) -> np.ndarray:
    """Similarity of each pair, all pairs of a step at once: bit vectors of 64 places, carries from word to word."""
    out = np.empty(len(left))
    for start in range(0, len(left), step):
        a, b = (np.array(x[start : start + step], dtype=str) for x in (left, right))
        size_a, size_b = np.char.str_len(a), np.char.str_len(b)
        letters_a, letters_b = (x.view(np.uint32).reshape(len(x), -1) for x in (a, b))
        words = max(1, -(-letters_b.shape[1] // WORD))
        v = np.full((len(a), words), np.iinfo(np.uint64).max, np.uint64)
        for i in range(int(size_a.max(initial=0))):
            letter, carry = letters_a[:, i : i + 1], np.zeros(len(a), np.uint64)
            for k in range(words):
                part = letters_b[:, k * WORD : (k + 1) * WORD]
                same = (part == letter) & (letter > 0)
                mask = (same.astype(np.uint64) << np.arange(part.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                u = v[:, k] & mask
                total = v[:, k] + u
                summed = total + carry
                carry = ((total < u) | (summed < total)).astype(np.uint64)
                v[:, k] = summed | (v[:, k] & ~u)
        common = np.zeros(len(a), np.int64)
        for k in range(words):
            inside = np.clip(size_b - k * WORD, 0, WORD).astype(np.uint64)
            full = np.where(inside == WORD, np.iinfo(np.uint64).max, (np.uint64(1) << np.minimum(inside, np.uint64(WORD - 1))) - np.uint64(1))
            common += np.bitwise_count(~v[:, k] & full)
        total = size_a + size_b
        out[start : start + step] = np.where(total == 0, 1.0, 2.0 * common / np.maximum(total, 1))
    return out


def score(ratio: np.ndarray) -> np.ndarray:
    """Ratio as an integer from 0 to 100, rounded half to even."""
    return np.rint(100.0 * ratio).astype(np.int32)
