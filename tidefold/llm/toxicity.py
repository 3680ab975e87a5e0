"""Toxicity: a factorization machine over hashed terms, learnt with numpy.

A text's terms are its distinct words (A-Z lower-cased; digits, letters and what is beyond
ASCII) and the 4- and 5-byte beginnings of the longer ones, hashed into ``buckets`` rows.  With w
the linear weights and v the factors, a text scores
``sigmoid(w0 + sum w_i + (|sum v_i|**2 - sum |v_i|**2) / 2)``: every pair of terms
interacts through its factors, at the cost of one pass over the terms, so an insult beside a
group mention can weigh more than both alone.  The driver learns from a bounded sample of
labelled rows (``train_rows`` documents of at most ``max_bytes`` bytes): the linear weights
by follow-the-regularised-leader with an L1 threshold, which leaves the hundreds of neutral
terms of a text at zero, the factors by AdaGrad, for terms whose weight isn't zero or that stand in
``pair_rows`` rows of the sample, so that terms which are neutral alone can tell in pairs.

Executors hold the model (``buckets * (factors + 2)`` floats) and a bounded cache of words.
Texts are scored whole and where they are; nothing is shuffled.

Defined results: a text without words scores ``sigmoid(w0)``; without usable labels every score
is 0.5; repeated rows get equal scores; extra columns are ignored.  Labels, language, source and id are no
inputs of a score.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame

from .labelled import training_rows
from .license_scan import WORD_TABLE

CACHE_WORDS = 400_000
_caches: dict[str, dict] = {}


def word_terms(word: bytes, buckets: int) -> tuple[int, ...]:
    terms = [b"=" + word] + [b"^" + word[:n] for n in (4, 5) if len(word) >= n]
    return tuple(zlib.crc32(t) % buckets for t in terms)


class FactorizationMachine:
    def __init__(
        self, buckets: int = 1 << 18, factors: int = 4, epochs: int = 5, rate: float = 0.5, l1: float = 5.0, l2: float = 1.0,
        factor_rate: float = 0.02, min_rows: int = 3, pair_rows: int = 100, seed: int = 1,
    ):
        self.buckets, self.factors, self.epochs, self.rate, self.l1, self.l2 = buckets, factors, epochs, rate, l1, l2
        self.factor_rate, self.min_rows, self.pair_rows, self.seed = factor_rate, min_rows, pair_rows, seed
        self.bias = 0.0
        self.weights = np.zeros(buckets, np.float32)
        self.vectors = np.zeros((buckets, factors), np.float32)
        self.paired = np.zeros(buckets, bool)
        self.name = uuid.uuid4().hex

    def terms(self, text: bytes, cache: dict) -> np.ndarray:
        found: set[int] = set()
        for w in set(text.translate(WORD_TABLE).split()):
            got = cache.get(w)
            if got is None:
                got = word_terms(w, self.buckets)
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                if len(w) <= 64:
                    cache[w] = got
            found.update(got)
        return np.fromiter(found, np.int64, len(found))

    def margin(self, ids: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The margin of a set of terms, those that take part, their factors and the factors' sum."""
        own = ids[(self.weights[ids] != 0) | self.paired[ids]]
        v = self.vectors[own]
        total = v.sum(axis=0)
        return self.bias + float(self.weights[own].sum()) + 0.5 * float(total @ total - (v * v).sum()), own, v, total

    def fit(self, texts: list[bytes], labels: list[int]) -> FactorizationMachine:
        if not texts:
            return self
        rng = np.random.default_rng(self.seed)
        self.vectors = rng.normal(0, 0.05, self.vectors.shape).astype(np.float32)
        cache: dict = {}
        rows = [np.sort(self.terms(t, cache)) for t in texts]
        seen_in = np.bincount(np.concatenate(rows), minlength=self.buckets)
        often, self.paired = seen_in >= self.min_rows, seen_in >= self.pair_rows
        rows = [r[often[r]] for r in rows]
        n = np.bincount(labels, minlength=2) + 1.0
        self.bias = float(np.log(n[1] / n[0]))
        pull, squares = np.zeros(self.buckets), np.zeros(self.buckets)
        seen = np.ones(self.vectors.shape, np.float32)
        for _ in range(self.epochs):
            for k in rng.permutation(len(rows)):
                ids = rows[k]
                z, own, v, total = self.margin(ids)
                g = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[k]
                before = np.sqrt(squares[ids])
                squares[ids] += g * g
                after = np.sqrt(squares[ids])
                pull[ids] += g - (after - before) / self.rate * self.weights[ids]
                p = pull[ids]
                shrunk = -np.sign(p) * np.maximum(np.abs(p) - self.l1, 0)
                self.weights[ids] = shrunk / ((1 + after) / self.rate + self.l2)
                grad = g * (total - v) + 1e-3 * v
                seen[own] += grad * grad
                self.vectors[own] -= self.factor_rate * grad / np.sqrt(seen[own])
        return self

    def scores(self, texts: list[bytes]) -> list[float]:
        if self.name not in _caches:
            _caches.clear()
            _caches[self.name] = {}
        cache = _caches[self.name]
        z = np.array([self.margin(self.terms(t, cache))[0] for t in texts])
        return (1 / (1 + np.exp(-np.clip(z, -60, 60)))).tolist()


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", train_rows: int = 8000, max_bytes: int = 24_000, modulus: int = 4, remainder: int = 2, **model) -> FactorizationMachine:
    texts, y = training_rows(docs, labels, label_col, modulus, remainder, train_rows, max_bytes)
    return FactorizationMachine(**model).fit(texts, y)
