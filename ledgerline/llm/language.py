"""Language identification with string kernels.

A text is the set of its 1- to ``N`` -byte runs (letters lower-cased, other ASCII as blank), folded by a hash into
``DIMS`` presence bits. The kernel of two texts is the size of the common set over the root of the product of both
sizes. Nystrom landmarks (``landmarks`` rows of each language) stand for the kernel's feature space; one-versus-rest
ridge regression there is kernel ridge regression. A batch is scored by one matrix product of its presence bits
with those of the landmarks and one with the class weights.

Landmarks and training rows are a bounded sample chosen by a hash of the text: some ``per_lang`` texts of each language and at least one,
from rows that are not held out and have a language. Texts of that sample never leave the executors: only their bits do.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is every text if there is nothing to
learn from. A null doc_id counts as the empty text for the held-out rule. Rows are judged one by one, so repeated
rows don't matter. Of equal scores the language first in the alphabet is taken. A very long text is read whole; an empty
table gives an empty one, and nothing to learn from. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import arrays as A
from .common import bounded_sample, in_batches

N, BITS = 3, 14
DIMS = 1 << BITS
#: Letters in lower case and all bytes beyond ASCII as they are; everything else is a blank.
FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in A.LOWER.tolist()], np.uint8)
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
UNKNOWN = "und"


def held_out(doc_id: Column, modulus: int = 4, rest: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest


def presence(c: A.Chunk) -> np.ndarray:
    """rows x DIMS presence bits."""
    d = FOLD[c.data].astype(np.uint32)
    size = np.diff(c.off)
    out = np.zeros((c.rows + 1, DIMS), bool)  # the last row takes runs that would cross the end of a text
    flat = out.ravel()
    code = d.copy()
    base = np.repeat(np.arange(c.rows, dtype=np.int64) * DIMS, size)
    for n in range(1, N + 1):
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | d[n - 1 :]
            base = base[: len(code)]
            edge = c.off[1:][size > 0] - (n - 1)
            base[edge[(edge >= 0) & (edge < len(base))]] = c.rows * DIMS
        if len(code):
            slot = (code * np.uint32(_ODD[n - 1])) >> np.uint32(32 - BITS)
            flat[base + slot] = True
    return out[: c.rows]


def lettered(c: A.Chunk) -> np.ndarray:
    """Which rows have a letter."""
    low = c.data | 32
    at = np.flatnonzero((low >= 97) & (low <= 122))
    some = np.diff(np.searchsorted(at, c.off)) > 0
    for i in np.flatnonzero(~some):
        if c.off[i + 1] > c.off[i] and (c.data[c.off[i] : c.off[i + 1]] >= 128).any():
            some[i] = any(map(str.isalpha, c.text(i)))
    return some


#: Landmarks of all languages together (64 KB each are sent to every worker).
MAX_LANDMARKS = 1000


class Model:
    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.langs, self.landmarks, self.weights = langs, landmarks, weights

    @staticmethod
    def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
        """Kernel values of presence bits against landmarks already divided by the root of their size."""
        f = x.astype(np.float32)
        return (f @ landmarks.T) / np.sqrt(np.maximum(x.sum(1), 1))[:, None].astype(np.float32)

    @classmethod
    def fit(cls, bits: np.ndarray, labels: list[str], landmarks: int = 30, ridge: float = 1e-2) -> Model:
        """bits: rows x DIMS of the training sample, in a fixed order."""
        langs = sorted(set(labels))
        y = np.array([langs.index(v) for v in labels])
        landmarks = max(1, min(landmarks, MAX_LANDMARKS // len(langs)))
        pick = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(langs))])
        lm = bits[pick].astype(np.float32)
        lm /= np.sqrt(np.maximum(lm.sum(1), 1))[:, None]
        values, vectors = np.linalg.eigh(cls.kernel(bits[pick], lm).astype(float))
        good = values > 1e-6 * values[-1]
        root = vectors[:, good] / np.sqrt(values[good])
        z = np.c_[cls.kernel(bits, lm) @ root, np.ones(len(bits))]
        # each language weighs the same, so a rare one isn't drowned
        share = 1 / np.bincount(y, minlength=len(langs))[y]
        zw = z * (share / share.mean())[:, None]
        w = np.linalg.solve(z.T @ zw + ridge * np.eye(z.shape[1]), zw.T @ (2.0 * np.eye(len(langs))[y] - 1))
        return cls(langs, lm, np.r_[root @ w[:-1], w[-1:]].astype(np.float32))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        f = self.kernel(x, self.landmarks) @ self.weights[:-1] + self.weights[-1]
        best = f.argmax(1)
        return best, np.clip((1 + f[np.arange(len(f)), best]) / 2, 0, 1)


def train(docs: DataFrame, per_lang: int = 300) -> Model | None:
    """From text and lang of rows that are not held out."""
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id")))
    sample = bounded_sample(known.withColumn("doc_id", F.col("doc_id").cast("long")), "lang", "text", per_lang).select("doc_id", "lang", "text")

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(2), max_rows=256):
                x = np.packbits(presence(c), axis=1)
                yield pa.RecordBatch.from_arrays([b.column(i).slice(c.first, c.rows) for i in (0, 1)] + [pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "lang", "bits"])

    rows = in_batches(sample, bits, "doc_id long, lang string, bits binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.doc_id is None, r.doc_id or 0, bytes(r.bits)))
    x = np.unpackbits(np.frombuffer(b"".join(bytes(r.bits) for r in rows), np.uint8).reshape(len(rows), -1), axis=1)[:, :DIMS]
    return Model.fit(x.astype(bool), [r.lang for r in rows])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            for c in A.chunks(b.column(2), max_rows=256):
                ok = lettered(c) if m else np.zeros(c.rows, bool)
                best, score = m.predict(presence(c)) if m else (np.zeros(c.rows, int), np.zeros(c.rows))
                names = np.array([*(m.langs if m else []), UNKNOWN], object)[np.where(ok, best, -1)]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(c.first, c.rows) for i in (0, 1)), pa.array(names.tolist(), pa.string()), pa.array(np.where(ok, score, 0).astype(float))], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return in_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
