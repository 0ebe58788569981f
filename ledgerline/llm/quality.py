"""Quality rules: counts over whole texts, then a linear-chain CRF that labels lines.

Every text is scanned once as bytes. Counts (words, symbols, repeated lines, words in repeated 8-word windows)
give the base verdict. A conditional random field over the lines of a text, decoded by Viterbi, marks each line
content or boilerplate; a text is kept if the share of its words in content lines reaches ``min_share``.

The field is trained here by gradient ascent on its exact conditional likelihood, from a bounded sample of rows
of `labels` (some ``per_class`` documents of each quality value, all lines of each). Lines of good documents
count as content, lines of bad ones as boilerplate; the field learns which line features and neighbours tell them apart.

Edge cases: a null or empty text has no words and fails the base rule; without labelled rows of both classes the
field abstains and the base verdict stands; rows with equal or null doc_id are judged one by one; columns other
than doc_id and text are not read, so names may clash; a very long text is one chunk and is judged whole; an empty table gives
an empty one; a share equal to the least one is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrays as A
from .common import bounded_sample, in_batches, map_whole

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FEATURES = ("bias", "symbols", "many_symbols", "upper", "shouting", "repeats_line", "pipes", "short", "sentence_end", "digits", "long_words", "symbol_start", "repeated_words")
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
DIGEST = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def per(positions: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many sorted positions fall into each of the intervals that the edges divide."""
    return np.diff(np.searchsorted(positions, edges))


class Scan:
    """All counts of a chunk's rows and lines."""

    def __init__(self, c: A.Chunk):
        d = c.data
        ws, we, wrow = c.words()
        ls, le, lrow = c.lines()
        h = A.prefix_hash(d)
        lead = A.codepoints(d)
        self.n_words = np.diff(wrow)
        self.word_chars = np.add.reduceat(np.append(lead[we] - lead[ws], 0), np.minimum(wrow[:-1], len(ws))) * (self.n_words > 0)
        sym = np.flatnonzero(SYMBOLS[d])
        self.n_symbols = per(sym, c.off)
        line_row = np.repeat(np.arange(c.rows), np.diff(lrow))
        # words of a line; lines in order, so edges are the starts plus the end
        edge = np.append(ls, len(d))
        lword = np.searchsorted(ws, edge)
        words = np.diff(lword)
        key = A.mix(A.span_hash(h, ls, le) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        full = np.flatnonzero(words > 0)
        dup = np.zeros(len(ls), bool)
        dup[full] = A.repeated(key[full])[1]
        self.n_dup = np.bincount(line_row[dup], minlength=c.rows)
        # 8-word windows
        covered = np.zeros(len(ws) + 1, np.int32)
        m = len(ws) - WINDOW + 1
        if m > 0:
            wh = A.span_hash(h, ws, we)
            word_row = np.repeat(np.arange(c.rows), self.n_words)
            acc = wh[:m].copy()
            for k in range(1, WINDOW):
                acc = acc * np.uint64(0x9E3779B97F4A7C15) + wh[k : k + m]
            ok = np.flatnonzero(word_row[:m] == word_row[WINDOW - 1 :])
            again = ok[A.repeated(A.mix(acc[ok] + word_row[ok].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))[0]]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + WINDOW, -1)
            covered = np.cumsum(covered)
        hit = np.flatnonzero(covered[:-1] > 0)
        self.n_repeat = per(hit, wrow)
        self.base_failed = (self.n_words < MIN_WORDS) | (100 * self.n_repeat > REPEAT_PERCENT * self.n_words)
        # features of lines
        self.line_row, self.lrow, self.line_words = line_row, lrow, words
        upper, letters = np.flatnonzero((d >= 65) & (d <= 90)), np.flatnonzero(((d | 32) >= 97) & ((d | 32) <= 122))
        n_let, n_up = per(letters, edge), per(upper, edge)
        n_sym, n_bang, n_pipe, n_dig = per(sym, edge), per(np.flatnonzero(d == 33), edge), per(np.flatnonzero(d == 124), edge), per(np.flatnonzero((d >= 48) & (d <= 57)), edge)
        chars = lead[np.minimum(le, len(d))] - lead[ls]
        w1 = np.maximum(words, 1)
        last = np.zeros(len(ls), np.uint8)
        head = np.zeros(len(ls), np.uint8)
        last[full] = d[we[lword[1:][full] - 1] - 1]
        head[full] = d[ws[lword[:-1][full]]]
        x = np.zeros((len(ls), len(FEATURES)), np.float32)
        x[:, 0] = 1
        x[:, 1] = n_sym > 0.2 * w1
        x[:, 2] = n_sym > w1
        x[:, 3] = n_up > 0.5 * np.maximum(n_let, 1)
        x[:, 4] = n_bang > 0.3 * w1
        x[:, 5] = dup
        x[:, 6] = n_pipe >= 2
        x[:, 7] = words < 3
        x[:, 8] = np.isin(last, list(b".!?"))
        x[:, 9] = n_dig > 0.2 * np.maximum(chars, 1)
        x[:, 10] = chars > 13 * w1
        x[:, 11] = SYMBOLS[head]
        x[:, 12] = per(hit, lword) > 0.5 * w1
        self.x = x


class LineField:
    """A linear-chain CRF with labels 0 (content) and 1 (boilerplate)."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def viterbi(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best labels of the lines; sequences begin at first[:-1]. All sequences step together, longest first."""
        emit = x @ self.weights
        lens = np.diff(first)
        order = np.argsort(-lens, kind="stable")
        lens, begin = lens[order], first[:-1][order]
        n = int((lens > 0).sum())
        labels = np.zeros(len(x), np.int8)
        if not n:
            return labels
        back = np.zeros((len(x), 2), np.int8)
        score = emit[begin[:n]].copy()
        ends = np.searchsorted(-lens[:n], -np.arange(1, lens[0] + 1), "right")  # sequences with at least t+1 lines
        for t in range(1, int(lens[0])):
            k = ends[t]
            at = begin[:k] + t
            cand = score[:k, :, None] + self.trans[None]
            pick = cand[:, 1] > cand[:, 0]
            back[at] = pick
            score[:k] = np.where(pick, cand[:, 1], cand[:, 0]) + emit[at]
        cur = (score[:, 1] > score[:, 0]).astype(np.int8)
        for t in range(int(lens[0]) - 1, -1, -1):
            k = ends[t]
            at = begin[:k] + t
            labels[at] = cur[:k]
            cur[:k] = back[at, cur[:k]]
        return labels

    @classmethod
    def fit(cls, seqs: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.5, l2: float = 1e-3) -> LineField:
        """Gradient ascent (Adam) on the conditional log-likelihood; expectations by forward-backward over padded sequences."""
        n, t_max, f = len(seqs), max(len(y) for _, y in seqs), seqs[0][0].shape[1]
        x, y, on = np.zeros((n, t_max, f)), np.zeros((n, t_max), int), np.zeros((n, t_max), bool)
        for i, (a, b) in enumerate(seqs):
            x[i, : len(b)], y[i, : len(b)], on[i, : len(b)] = a, b, True
        total, gold = on.sum(), np.eye(2)[y] * on[..., None]
        pair_gold = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
        feat_gold = np.einsum("ntf,nti->fi", x, gold)
        w, tr = np.zeros((f, 2)), np.zeros((2, 2))
        m = [np.zeros_like(w), np.zeros_like(tr)]
        v = [np.zeros_like(w), np.zeros_like(tr)]
        for step in range(1, rounds + 1):
            emit = x @ w
            fw, bw = np.zeros((n, t_max, 2)), np.zeros((n, t_max, 2))
            fw[:, 0] = emit[:, 0]
            for t in range(1, t_max):
                nxt = np.logaddexp(fw[:, t - 1, 0, None] + tr[0], fw[:, t - 1, 1, None] + tr[1]) + emit[:, t]
                fw[:, t] = np.where(on[:, t, None], nxt, fw[:, t - 1])
            for t in range(t_max - 2, -1, -1):
                e = emit[:, t + 1] + bw[:, t + 1]
                prev = np.logaddexp(e[:, 0, None] + tr[:, 0], e[:, 1, None] + tr[:, 1])
                bw[:, t] = np.where(on[:, t + 1, None], prev, 0)
            z = np.logaddexp(fw[:, -1, 0], fw[:, -1, 1])
            node = np.exp(fw + bw - z[:, None, None]) * on[..., None]
            both = np.exp(fw[:, :-1, :, None] + tr + (emit + bw)[:, 1:, None, :] - z[:, None, None, None]) * on[:, 1:, None, None]
            grads = [(feat_gold - np.einsum("ntf,nti->fi", x, node)) / total - l2 * w, (pair_gold - both.sum((0, 1))) / total - l2 * tr]
            for p, g, a, b in zip((w, tr), grads, m, v, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p += rate * 0.2 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return cls(w.astype(np.float32), tr.astype(np.float32))


def judge(scan: Scan, field: LineField | None, min_share: float) -> tuple[np.ndarray, np.ndarray]:
    """Share of words in content lines, and the verdict."""
    n = np.maximum(scan.n_words, 1)
    share = np.ones(len(n))
    if field is not None:
        label = field.viterbi(scan.x, scan.lrow)
        share = np.bincount(scan.line_row, np.where(label == 0, scan.line_words, 0), len(n)) / n
    return share, ~scan.base_failed & (share >= min_share)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 400, piece: int = 60) -> LineField | None:
    """The field from a bounded sample of labelled rows, of which all lines count; None if one class has no row.

    Long texts are cut into pieces of `piece` lines, each a sequence, so that the padded table of the fit stays small. Of rows
    with one doc_id the one with the least text hash is taken."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
    chosen = bounded_sample(known.distinct(), "quality", "doc_id", per_class).collect()
    good = {q: {r.doc_id for r in chosen if r.quality == q} for q in (0, 1)}
    if not good[0] or not good[1]:
        return None
    wanted = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in sorted(good[0] | good[1])], "doc_id long"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for c in A.chunks(b.column(1)):
                s = Scan(c)
                rows = [(ids[c.first + i], s.x[s.lrow[i] : s.lrow[i + 1]].astype(np.int8)) for i in range(c.rows) if s.n_words[i]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())], names=["doc_id", "x"])

    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sample = sample.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = in_batches(sample, lines, "doc_id long, x binary").collect()
    seqs = []
    for r in sorted(got, key=lambda r: (r[0], bytes(r[1]))):
        x = np.frombuffer(r[1], np.int8).reshape(-1, len(FEATURES)).astype(float)
        seqs += [(part, np.full(len(part), int(r[0] in good[0]))) for part in np.split(x, range(piece, len(x), piece))]
    if len({y for _, s in seqs for y in s[:1]}) < 2:
        return None
    return LineField.fit(seqs)


def annotate(docs: DataFrame, field: LineField | None, min_share: float = 0.5) -> DataFrame:
    """One row of counts and verdicts for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in A.chunks(b.column(1)):
                s = Scan(c)
                share, kept = judge(s, field, min_share)
                cols = [b.column(0).slice(c.first, c.rows), *(pa.array(v.astype(np.int64)) for v in (s.n_words, s.word_chars, s.n_symbols, s.n_dup, s.n_repeat)), pa.array(s.base_failed), pa.array(kept), pa.array(share)]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in DIGEST.split(", ")])

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, DIGEST)


def keep(docs: DataFrame, field: LineField | None, min_share: float = 0.5) -> DataFrame:
    """The rows of docs that pass, with all their columns; nothing is shuffled."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask = [judge(Scan(c), field, min_share)[1] for c in A.chunks(b.column(at))]
            yield b.filter(pa.array(np.concatenate(mask) if mask else np.zeros(0, bool)))

    return map_whole(docs, run, docs.schema)
