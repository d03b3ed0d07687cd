"""Document quality by a linear-chain conditional random field over lines.

Every line (separated by a newline) is good or bad.  Its features are shares
and counts of its bytes and words, with those of the line before and after;
the chain adds start and transition weights.  Forward-backward gives every
line's probability of being good, and a document's score is their mean
weighted by line length.

Bounded sample: at most ``SAMPLE_DOCS`` labelled documents, those with the
smallest hash of their doc_id, and of each at most ``SAMPLE_LINES`` lines, are
fitted (every line takes its document's label); all texts are scored whole.

Defined results: a null or empty text, or one of white space only, scores 0;
rows that repeat are scored each; with no usable label every score is 0.5
(0 for empty texts); extra columns of any name are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE_DOCS = 3000
SAMPLE_LINES = 100
ROUNDS = 300
L2 = 1e-3
THRESHOLD = 0.3

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "wide": range(128, 256),
    "symbol": b"#*$%&<>", "bar": b"|", "bang": b"!?", "stop": b".,;:", "other": b"@/\\_=+~^`{}[]()-\"'",
}
CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _i, _members in enumerate(_CLASSES.values()):
    CLASS_OF[list(_members)] = _i
N_CLASSES = len(_CLASSES) + 1
NARROW = N_CLASSES + 6


def line_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line that has a word, and its length in bytes."""
    b, starts, ends = C.word_spans(data)
    if not len(starts):
        return np.zeros((0, 3 * NARROW + 1)), np.zeros(0)
    newline = np.flatnonzero(b == 10)
    line_of_word = np.searchsorted(newline, starts)
    lines, first = np.unique(line_of_word, return_index=True)
    n = len(lines)
    of_byte = np.zeros(len(b), np.int64)
    of_byte[newline] = 1
    of_byte = np.cumsum(of_byte) - of_byte
    slot = np.full(len(newline) + 1, -1)
    slot[lines] = np.arange(n)
    inside = ~C.SEPARATOR[b]
    s = slot[of_byte[inside]]
    counts = np.bincount(s * N_CLASSES + CLASS_OF[b[inside]], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    size = counts.sum(axis=1)
    words = np.diff(np.append(first, len(starts)))
    codes = C.Stretches(C.BYTE_CODES[b]).hash(starts, ends)
    same = np.zeros(len(codes))
    same[1:] = codes[1:] == codes[:-1]
    order = np.argsort(codes, kind="stable")
    seen = np.zeros(len(codes))
    seen[order[1:]] = codes[order[1:]] == codes[order[:-1]]
    last = b[ends - 1]
    marked = np.isin(last, np.frombuffer(b"#*$%&!|", np.uint8)).astype(float)
    own = np.column_stack([
        counts / size[:, None],
        np.add.reduceat(same, first) / words, np.add.reduceat(seen, first) / words,
        np.add.reduceat(marked, first) / words,
        np.log1p(words) / 6, size / words / 12, np.minimum(1, words / 3),
    ])
    zero = np.zeros((1, NARROW))
    return np.hstack([own, np.vstack([zero, own[:-1]]), np.vstack([own[1:], zero]), np.ones((n, 1))]), size.astype(float)


class Chain:
    """Two-state chain: emission weights of "good", start and transition scores."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def marginals(self, emit: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good per line, and summed pair probabilities.

        ``emit``: score of good against bad per line; ``begin``: first line of
        every document.  All documents advance together, a line at a time.
        """
        n = np.diff(np.append(begin, len(emit)))
        order = np.argsort(-n, kind="stable")
        begin, n = begin[order], n[order]
        alpha, beta = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
        both = np.column_stack([np.zeros(len(emit)), emit])
        alpha[begin] = both[begin]
        longest = int(n[0]) if len(n) else 0
        live = np.searchsorted(-n, -np.arange(longest), side="left")
        for t in range(1, longest):
            at = begin[:live[t]] + t
            alpha[at] = both[at] + np.logaddexp(alpha[at - 1, :1] + self.trans[0], alpha[at - 1, 1:] + self.trans[1])
        for t in range(longest - 2, -1, -1):
            at = begin[:live[t + 1]] + t
            nxt = both[at + 1] + beta[at + 1]
            beta[at] = np.logaddexp(self.trans[:, 0] + nxt[:, :1], self.trans[:, 1] + nxt[:, 1:])
        score = alpha + beta
        good = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        follow = np.ones(len(emit), bool)
        follow[begin] = False
        at = np.flatnonzero(follow)
        z = np.logaddexp(score[at, 0], score[at, 1])
        pair = np.exp(alpha[at - 1][:, :, None] + self.trans + (both[at] + beta[at])[:, None, :] - z[:, None, None])
        return good, pair.sum(axis=0)


def fit(features: np.ndarray, labels: np.ndarray, begin: np.ndarray, rounds: int = ROUNDS, l2: float = L2) -> Chain:
    """Maximum likelihood by Adam steps on the forward-backward gradient.

    Documents weigh alike and so do the two labels' totals.
    """
    chain = Chain(np.zeros(features.shape[1]), np.zeros((2, 2)))
    n = len(labels)
    follow = np.ones(n, bool)
    follow[begin] = False
    at = np.flatnonzero(follow)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    m1, m2 = [0, 0], [0, 0]
    for step in range(1, rounds + 1):
        good, pair = chain.marginals(features @ chain.weights, begin)
        grads = [features.T @ (labels - good) / n - l2 * chain.weights, (seen - pair) / n - l2 * chain.trans]
        for i, g in enumerate(grads):
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.99 * m2[i] + 0.01 * g * g
            move = 0.1 * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.99**step)) + 1e-8)
            if i == 0:
                chain.weights = chain.weights + move
            else:
                chain.trans = chain.trans + move
    return chain


def learn(docs: DataFrame, labels: DataFrame, n_docs: int = SAMPLE_DOCS, n_lines: int = SAMPLE_LINES) -> Chain | None:
    """Fit on the labelled documents with the smallest hashes; labels: (doc_id, quality)."""
    spark = docs.sparkSession
    C.prepare(spark)
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n_docs))

    def rows(batch):
        y, lists, sizes = [], [], []
        for q, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f = line_features(data)[0][:n_lines]
            if len(f):
                y.append(q)
                lists.append(f.astype("<f4").tobytes())
                sizes.append(len(f))
        return {"quality": np.array(y, np.int32), "n": np.array(sizes, np.int32), "features": pa.array(lists, pa.binary())}

    picked = docs.where("text is not null").select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", F.col("quality").cast("int").alias("quality")).agg(
            F.min("text").alias("text")).drop("doc_id")  # at most n_docs rows; of a repeated doc_id the smallest text
    got = C.map_arrow(picked, rows, "quality int, n int, features binary").collect()
    if len({r.quality for r in got}) < 2:
        return None
    got.sort(key=lambda r: bytes(r.features))
    n = np.array([r.n for r in got])
    x = np.concatenate([np.frombuffer(r.features, "<f4").reshape(r.n, -1) for r in got]).astype(float)
    y = np.repeat([int(r.quality) for r in got], n)
    return fit(x, y, np.cumsum(n) - n)


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(row, score): ``row`` holds all columns of ``docs``."""
    source = docs.select(F.struct("*").alias("row"))

    def rows(batch):
        texts = batch.column(0).field("text").cast(pa.binary()).to_pylist()
        parts = [line_features(x) if x else (None, ()) for x in texts]
        n = np.array([len(size) for _, size in parts])
        out = np.zeros(len(parts))
        some = np.flatnonzero(n)
        if len(some) and chain is None:
            out[some] = 0.5
        elif len(some):
            begin = np.cumsum(n[some]) - n[some]
            emit = np.concatenate([parts[i][0] @ chain.weights for i in some])
            size = np.concatenate([parts[i][1] for i in some])
            good, _ = chain.marginals(emit, begin)
            out[some] = np.add.reduceat(good * size, begin) / np.add.reduceat(size, begin)
        return {"row": batch.column(0), "score": np.clip(out, 0, 1)}

    return C.map_arrow(source, rows, C.with_row(source, "score double"))


def held_out(column: str = "doc_id"):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5)) == 0


def fitted(spark, sf_dir: str) -> Chain | None:
    """The chain of the query and the pipeline: labels outside the held-out fifth."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return learn(docs, C.read(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality"))


def op4_line_crf_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fitted(spark, sf_dir))
    return out.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
