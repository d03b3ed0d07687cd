"""Substring dedup by repeated-phrase automata.

1. *Confirm*: windows of ``length`` words that occur in two documents or more
   are found among the candidate runs of ``recurring``; each belongs to the
   smallest doc_id that has it, and neighbouring ones merge into passages.
2. *Compile*: per shard one Aho-Corasick automaton over the passages, each word
   coded as a character or two.  Of every window of a passage the phrase of
   ``length // 2`` words that is rarest in the shard is entered: neighbouring
   windows mostly share it, so the automaton has few nodes a word instead of
   ``length``, and near copies are not hit for what all of them have.
3. *Stream*: the distinct candidate stretches of all documents run through the
   automaton; every hit is extended to the longest match with its passage, and
   matches of ``length`` words or more are the occurrences.

Shards are hashes of the window key, so their number follows the data and no
document is streamed past a shard that cannot hold one of its windows.  A key
with more than ``max_group`` distinct stretches is taken apart into windows
(``recurring.contents``), so that no task holds an unbounded group.

Defined results: null or empty texts and texts under ``length`` words lose
nothing; rows with a null doc_id are neither earlier nor later than others and
stay as they are; rows that repeat a doc_id are judged each on its own text
and are not earlier than one another; equal texts under other ids lose all
windows but in the smallest id; extra columns of any name are carried along.
"""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import recurring as R

LENGTH = 50
GRAM = 10
SHARD_RUNS = 8_000
MAX_GROUP = 16_000  # a shard of 60,000 stretches was measured at 870 MB of a task's memory

MATCH = "key long, content long, spans array<struct<a:int,b:int,origin:long>>"


class Coder:
    """Words of one shard as strings of ``width`` characters a word."""

    HIGH, LOW, DIGITS = 0x20000, 0x10000, 0x10000  # disjoint ranges: no match can start inside a word

    def __init__(self, segments: Iterable[list[bytes]]):
        ids: dict[bytes, int] = {}
        self.ids = [np.fromiter((ids.setdefault(w, len(ids)) for w in s), np.int64, len(s)) for s in segments]
        self.width = 1 if len(ids) <= self.DIGITS * 8 else 2

    def text(self, ids: np.ndarray) -> str:
        if self.width == 1:
            points = (ids + self.LOW).astype("<u4")
        else:
            points = np.stack([self.HIGH + ids // self.DIGITS, self.LOW + ids % self.DIGITS], 1).astype("<u4").ravel()
        return points.tobytes().decode("utf-32-le")


def recurring_passages(ids: list[np.ndarray], first: np.ndarray, last: np.ndarray, length: int):
    """(segment, start, end) of the passages, each in the first document that has its windows."""
    m = np.array([len(x) - length + 1 for x in ids])
    flat = np.concatenate(ids)
    begin = np.cumsum([0, *[len(x) for x in ids[:-1]]])
    seg = np.repeat(np.arange(len(ids)), m)
    off = np.arange(len(seg)) - np.repeat(np.cumsum(m) - m, m)
    at = begin[seg] + off
    h = C.Stretches(C.mix(flat.astype(np.uint64) + np.uint64(1))).hash(at, at + length)
    order = np.lexsort((at, first[seg], h))
    hs = h[order]
    new = np.concatenate(([True], hs[1:] != hs[:-1]))
    group = np.cumsum(new) - 1
    lo = first[seg[order]][new]
    hi = np.maximum.reduceat(last[seg[order]], np.flatnonzero(new))
    chosen = np.zeros(len(seg), bool)
    chosen[order[new & (lo < hi)[group]]] = True
    idx = np.flatnonzero(chosen)
    if not len(idx):
        return []
    breaks = np.flatnonzero((np.diff(idx) != 1) | (np.diff(seg[idx]) != 0)) + 1
    return [(int(seg[p[0]]), int(off[p[0]]), int(off[p[-1]]) + length) for p in np.split(idx, breaks)]


def rare_phrases(ids: list[np.ndarray], passages: list[tuple[int, int, int]], length: int, size: int):
    """(passage, offset) of the phrases to enter: of every window of ``length``
    words the one of ``size`` words that stands in the shard least often."""
    n = np.array([len(x) for x in ids])
    begin = np.cumsum(n) - n
    flat = np.concatenate(ids)
    sums = C.Stretches(C.mix(flat.astype(np.uint64) + np.uint64(1)))
    at = np.arange(len(flat) - size + 1)
    h = sums.hash(at, at + size)  # also of phrases across two stretches, which no passage has
    _, which, times = np.unique(h, return_inverse=True, return_counts=True)
    rare = (np.minimum(times, 1 << 23).astype(np.uint64)[which] << C.U64(40)) | (h >> C.U64(24))
    seg, a, b = np.array(passages).T
    each = b - a - size + 1
    of = np.repeat(np.arange(len(each)), each)
    off = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    value = rare[(begin[seg] + a)[of] + off]
    w = length - size + 1
    least = np.append(C.sliding_min(value, w), np.zeros(w - 1, C.U64))
    least[off >= (each - w + 1)[of]] = 0  # windows that would reach into the next passage
    wanted = ~C.sliding_min(~np.append(np.zeros(w - 1, C.U64), least), w) == value
    return of[wanted].tolist(), off[wanted].tolist()


def extend(text: str, passage: str, delta: int, hit: int, size: int) -> tuple[int, int]:
    """The longest stretch around ``text[hit:hit + size]`` equal to the passage laid at ``delta``."""
    lo, hi = max(0, delta), min(len(text), delta + len(passage))
    if text[lo:hi] == passage[lo - delta:hi - delta]:
        return lo, hi
    a, b = hit, hit + size
    while a > lo and text[a - 1] == passage[a - 1 - delta]:
        a -= 1
    while b < hi and text[b] == passage[b - delta]:
        b += 1
    return a, b


def widest(spans: set[tuple[int, int, int]]) -> list[dict]:
    """The spans (a, b, origin) without those inside another of the same or an earlier origin."""
    kept: list[tuple[int, int, int]] = []
    for origin, a, _, b in sorted((o, a, -b, b) for a, b, o in spans):
        if not any(x <= a and b <= y for x, y, _ in kept):
            kept.append((a, b, origin))
    return [{"a": a, "b": b, "origin": o} for a, b, o in kept]


def locate(table: pa.Table, length: int) -> pa.Table:
    """All occurrences of the shard's recurring passages in its stretches: one row a stretch that has any."""
    pairs = list(zip(table["key"].to_pylist(), table["content"].to_pylist()))
    once = list(dict(zip(reversed(pairs), range(len(pairs) - 1, -1, -1))).values())
    table = table.take(pa.array(once[::-1], pa.int64()))  # rows that repeat a document bring its stretches again
    first, last = table["first_doc"].to_numpy(), table["last_doc"].to_numpy()
    coder = Coder(s.split() for s in table["words"].to_pylist())
    w, size = coder.width, length // 2
    found, starts = recurring_passages(coder.ids, first, last, length), {}
    passages = [(coder.text(coder.ids[seg][a:b]), int(first[seg])) for seg, a, b in found]
    key, content, out = table["key"].to_pylist(), table["content"].to_pylist(), []
    if found:
        for p, k in zip(*rare_phrases(coder.ids, found, length, size)):
            starts.setdefault(passages[p][0][k * w:(k + size) * w], []).append((p, k * w))
        automaton = ahocorasick.Automaton()
        for phrase, places in starts.items():
            automaton.add_word(phrase, places)
        automaton.make_automaton()
        for i, ids in enumerate(coder.ids):
            text, reached, spans = coder.text(ids), {}, set()
            for end, places in automaton.iter(text):
                hit = end + 1 - size * w
                for p, k in places:
                    # other phrases of a match need no second look
                    if passages[p][1] >= last[i] or reached.get((p, hit - k), 0) > end:
                        continue
                    a, b = extend(text, passages[p][0], hit - k, hit, size * w)
                    a, b = -(-a // w) * w, b // w * w
                    reached[p, hit - k] = b
                    if b - a >= length * w:
                        spans.add((a // w, b // w, passages[p][1]))
            if spans:
                out.append((key[i], content[i], widest(spans)))
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("origin", pa.int64())]))
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 3, [pa.int64(), pa.int64(), span])],
                    names=["key", "content", "spans"])


def cut_words(batch):
    """The words of every listed run, joined by a space."""
    docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    offsets, runs = R.list_parts(batch.column(2))
    words_of = []
    for i, data in enumerate(texts):
        words = data.split()
        words_of += [b" ".join(words[s:e]) for s, e in zip(runs["start"][offsets[i]:offsets[i + 1]],
                                                           runs["end"][offsets[i]:offsets[i + 1]])]
    return {"key": runs["key"], "content": runs["content"],
            "first_doc": np.repeat(docs, np.diff(offsets)).astype(np.int64), "last_doc": runs["last_doc"],
            "words": pa.array(words_of, pa.binary())}


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_runs: int = SHARD_RUNS,
                   max_group: int = MAX_GROUP) -> DataFrame:
    """doc, tag, spans: words ``a`` to ``b`` of every span also stand in the
    earlier document ``origin``, as part of a stretch of at least ``length``
    words.  At most one row a run of windows, whatever the number of documents
    that have its words."""
    C.prepare(docs.sparkSession)
    unit = R.Unit("word", length, gram)
    base = R.base(docs)
    found = R.candidates(base, unit, True, max_group)
    distinct, windows = R.contents(found, base, unit, max_group, last_doc=True)
    shards = max(1, -(-(found.count() + (0 if windows is None else windows.count())) // shard_runs))
    lists = R.stretches_by_document(distinct, unit, "last_doc")
    cut = C.map_arrow(base.join(lists, ["doc", "tag"]).select("doc", "text", "runs"), cut_words,
                      "key long, content long, first_doc long, last_doc long, words binary")

    def shard(table: pa.Table) -> pa.Table:
        return locate(table, length)

    matches = (cut.withColumn("shard", F.pmod("key", F.lit(shards)))
               .groupBy("shard").applyInArrow(shard, MATCH))
    if windows is not None:
        matches = C.stored(matches)
        span = [F.col(c) for c in ("a", "b", "origin")]
        matches = matches.unionByName(R.of_contents(matches, windows, span, [F.col("s.origin").alias("origin")]))
    start = R.start_of("place")

    def moved(span):
        return F.struct((start + span.a).alias("a"), (start + span.b).alias("b"), span.origin.alias("origin"))

    earlier = F.transform(F.filter("spans", lambda span: span.origin < F.col("doc")), moved)
    return (found.join(matches, ["key", "content"])
            .select("doc", R.tag_of("place").alias("tag"), earlier.alias("spans")).where(F.size("spans") > 0))


def remove_repeated_phrases(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_runs: int = SHARD_RUNS,
                            max_group: int = MAX_GROUP, carry: bool = True) -> DataFrame:
    """Every document without the words it repeats from earlier documents.

    Columns: doc_id; n_words, n_removed; ``words``, the kept words joined by
    one space, as bytes (null if ``carry``); with ``carry`` also ``row``, a
    struct of all input columns, and ``kept_text``: the text with the removed
    words and the white space after them cut out, unchanged where nothing was
    removed.
    """
    spans = repeated_spans(docs, length, gram, shard_runs, max_group)
    ends = F.transform("spans", lambda span: F.struct(span.a.alias("a"), span.b.alias("b")))
    per_doc = (spans.select("doc", "tag", ends.alias("spans"))
               .groupBy("doc", "tag").agg(F.flatten(F.collect_set("spans")).alias("spans")))
    kept = docs.where("doc_id is not null")
    base = kept.select(F.struct("*").alias("row"), *R.columns()) if carry else R.base(docs)
    none = F.lit(None).cast("array<struct<a:bigint,b:bigint>>")
    rest = docs.where("doc_id is null")
    rest = rest.select(*([F.struct("*").alias("row")] if carry else []), F.lit(None).cast("long").alias("doc"),
                       F.col("text").cast("binary").alias("text"), none.alias("spans"))
    joined = base.join(per_doc, ["doc", "tag"], "left").select(*rest.columns).unionByName(rest)
    k = int(carry)

    def remove(batch):
        ids, texts = batch.column(k), batch.column(k + 1).to_pylist()
        offsets, spans_of = R.list_parts(batch.column(k + 2))
        n_words, n_removed, words_out, text_out = [], [], [], []
        for i, data in enumerate(texts):
            lo, hi = offsets[i], offsets[i + 1]
            words = data.split() if data else []
            gone = np.zeros(len(words) + 1, np.int32)
            np.add.at(gone, spans_of["a"][lo:hi], 1)
            np.add.at(gone, spans_of["b"][lo:hi], -1)
            gone = np.cumsum(gone[:-1]) > 0
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            if not carry:
                words_out.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if lo < hi
                                 else b" ".join(words))
            elif lo < hi:
                b, s, _ = C.word_spans(data)
                drop = np.zeros(len(b), bool)
                nxt = np.append(s[1:], len(b))
                for x, y in zip(s[gone], nxt[gone]):
                    drop[x:y] = True
                text_out.append(b[~drop].tobytes())
            else:
                text_out.append(data)
        out = {"doc_id": ids, "n_words": np.array(n_words, np.int64), "n_removed": np.array(n_removed, np.int64)}
        if carry:
            return out | {"row": batch.column(0), "kept_text": pa.array(text_out, pa.binary())}
        return out | {"words": pa.array(words_out, pa.binary())}

    schema = "doc_id long, n_words long, n_removed long, "
    if not carry:
        return C.map_arrow(joined, remove, schema + "words binary")
    out = C.map_arrow(joined, remove, C.with_row(joined, schema + "kept_text binary"))
    return out.withColumn("kept_text", F.col("kept_text").cast("string"))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words, for every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeated_phrases(docs, carry=False)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("words", 256).alias("kept_sha256"))
