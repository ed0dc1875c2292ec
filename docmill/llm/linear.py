"""Hashed word features and linear models trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib

import numpy as np
import xxhash

BITS = 18
DIM = 1 << BITS
MEMO = 300_000
#: Words of more characters are not remembered.
LONG = 64
SIGNS = ".,;:!?\"'()[]*#%&$"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slot(x: np.ndarray, salt: int) -> np.ndarray:
    """Feature numbers 0..DIM-1 of 64-bit hashes, another place for each salt."""
    y = (x ^ np.uint64(salt)) * _MIX
    return (y >> np.uint64(64 - BITS)).astype(np.int32)


_RUNS = ((re.compile(r"[^\W\d_a-z]+"), lambda m: "".join(dict.fromkeys("A" if c.isupper() else "a" for c in m[0]))), (re.compile(r"[a-z]+"), "a"), (re.compile(r"\d+"), "9"), (re.compile(r"(.)\1+"), r"\1"))


def shape(word: str) -> str:
    """The word with letters as a or A, digits as 9, runs shortened, and signs as they are."""
    if word.isalpha():
        return "a" if word.islower() else "A" if word.isupper() else "Aa" if word[1:].islower() else "aA"
    for run, one in _RUNS:
        word = run.sub(one, word)
    return word


class Words:
    """64-bit hashes of words, the last 16 bits from their shapes, remembered for up to MEMO words."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def hashes(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        new = set(words).difference(memo)
        for w in new:
            memo[w] = xxhash.xxh3_64_intdigest(w.lower()) & ~0xFFFF | zlib.crc32(shape(w).encode()) & 0xFFFF
        out = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        for w in new:
            if len(w) > LONG:
                del memo[w]
        return out


def _bigrams(h: np.ndarray) -> np.ndarray:
    return h[:-1] * np.uint64(3) + (h[1:] ^ (h[1:] >> np.uint64(29)))


#: A text's n-grams of each kind weigh this much in all, however many there are.
MASS = 8.0


class QualityFeatures(Words):
    """Word and word-shape n-grams (1 and 2) of a whole text, and repetition of neighbours.

    Gives feature numbers and their weights; a number may come several times.
    """

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        if not words:
            return np.empty(0, np.int32), np.empty(0)
        h = self.hashes(words)
        w, s = h & np.uint64(0xFFFFFFFFFFFF0000), h & np.uint64(0xFFFF)
        parts, n = [_slot(w, 11), _slot(s, 12)], len(words)
        x = [np.full(2 * n, MASS / n)]
        if n > 1:
            parts += [_slot(_bigrams(w), 13), _slot(_bigrams(s), 14), _slot(np.array([1], np.uint64), 15)]
            x += [np.full(2 * n - 2, MASS / (n - 1)), np.array([(w[1:] == w[:-1]).mean()])]
        return np.concatenate(parts), np.concatenate(x)


def summed(idx: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once, its weights added."""
    one, at = np.unique(idx, return_inverse=True)
    return one, np.bincount(at, x, len(one))


class TermFeatures:
    """Which words and word beginnings a whole text holds (no counts, no cut)."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words, memo = set(text.lower().split()), self.memo
        if not words:
            return np.empty(0, np.int32), np.empty(0)
        if len(memo) > MEMO:
            memo.clear()
        new = words.difference(memo)
        for w in new:
            v = w.strip(SIGNS)
            memo[w] = zlib.crc32(v.encode()) << 32 | zlib.crc32(v[:4].encode())
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        for w in new:
            if len(w) > LONG:
                del memo[w]
        idx = np.unique(np.concatenate([_slot(h >> np.uint64(32), 21), _slot(h & np.uint64(0xFFFFFFFF), 22)]))
        return idx, np.ones(len(idx))


class Ftrl:
    """Logistic regression by follow-the-regularised-leader updates, a learning rate for each weight."""

    def __init__(self, dim: int = DIM, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.1, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(dim + 1), np.zeros(dim + 1)

    def at(self, idx: np.ndarray) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, idx: np.ndarray, x: np.ndarray, y: int) -> None:
        idx, x = np.append(idx, len(self.z) - 1), np.append(x, 1.0)
        w = self.at(idx)
        g = (probability(w @ x) - y) * x
        n = self.n[idx]
        step = np.sqrt(n + g * g)
        self.z[idx] += g - (step - np.sqrt(n)) / self.alpha * w
        self.n[idx] = n + g * g

    def weights(self) -> np.ndarray:
        return self.at(np.arange(len(self.z))).astype(np.float32)


def probability(score: float) -> float:
    return float(1.0 / (1.0 + np.exp(-min(max(score, -30.0), 30.0))))


def dot(weights: np.ndarray, idx: np.ndarray, x: np.ndarray) -> float:
    """Score of a text: a sparse dot product and the intercept."""
    return float(weights[idx] @ x + weights[-1])
