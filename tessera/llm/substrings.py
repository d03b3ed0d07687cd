"""Suffix-array dedup of byte strings by external induced sorting.

Candidate stretches (``recurring``, windows of ``length`` bytes) meet in shards
by their window key; per shard the suffixes of the distinct stretches are put
in order by induced sorting with disk-backed queues (``induced``), which carry
the common prefixes.  Neighbours that share ``length`` bytes or more start
equal windows; the first of each such group in document order is its source.

The number of shards follows the data, equal stretches collapse before they
are shuffled with their text, and a key with very many distinct stretches is
taken apart into windows, so no shard holds an unbounded group.

Defined results: null and empty texts, and texts under ``length`` bytes, lose
nothing; matches never cross documents; rows with a null doc_id stay as they
are and are no source; rows with equal doc_id and text count once, and rows
that share only the doc_id are ordered by the checksum of their text; extra
columns of any name are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import induced
from . import recurring as R

LENGTH = 100
GRAM = 20
SHARD_RUNS = 20_000
MAX_GROUP = 60_000
QUEUE_BYTES = 48 << 20

MATCH = ("key long, content long, "
         "spans array<struct<a:int,b:int,src:struct<src_doc:bigint,src_tag:bigint,src_start:bigint>>>")


def sources(table: pa.Table, length: int, memory: int = QUEUE_BYTES) -> pa.Table:
    """For every stretch one row with its spans [a, b) of window starts and where those bytes stand first."""
    pairs = list(zip(table["key"].to_pylist(), table["content"].to_pylist()))
    once = sorted(dict(zip(pairs, range(len(pairs)))).values())
    table = table.take(pa.array(once, pa.int64()))  # rows that repeat a document bring its stretches again
    doc, tag, start = (table[c].to_numpy() for c in ("first_doc", "first_tag", "first_start"))
    order = np.lexsort((start, tag, doc))
    doc, tag, start = doc[order], tag[order], start[order]
    key, content = table["key"].to_numpy()[order], table["content"].to_numpy()[order]
    texts = table["bytes"].take(pa.array(order)).to_pylist()
    size = np.array([len(x) for x in texts])
    begin = np.cumsum(size + 1) - size - 1
    flat = np.frombuffer(b"".join(texts), np.uint8)
    kind = np.uint8 if flat.max(initial=0) < 255 else np.uint16  # UTF-8 has no byte 255
    t = np.zeros(len(flat) + len(texts), kind)
    inside = np.ones(len(t), bool)
    inside[begin + size] = False
    t[inside] = flat.astype(kind) + kind(1)
    del texts
    windows = size - length + 1
    at = np.repeat(begin, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    wanted = np.zeros(len(t), bool)
    wanted[at] = True  # no window starts in the last bytes of a stretch
    pos, lcp = induced.suffix_order(t, memory, wanted=wanted)
    seg_of = np.repeat(np.arange(len(size)), size + 1)
    # stretches are in document order and their windows do not overlap, so
    # the smallest place in the shard is the first in the corpus
    new = lcp < length
    if len(new):
        new[0] = True
    heads = np.flatnonzero(new)
    source = np.arange(len(t))
    if len(heads):
        source[pos] = np.repeat(np.minimum.reduceat(pos, heads), np.diff(np.append(heads, len(pos))))
    src, seg = source[at], seg_of[at]
    cut = np.flatnonzero((np.diff(seg) != 0) | (np.diff(src) != 1) | (np.diff(seg_of[src]) != 0)) + 1
    lo = np.concatenate(([0], cut)) if len(at) else cut
    hi = np.append(cut, len(at)) if len(at) else cut
    s = seg[lo]
    o = seg_of[src[lo]]
    src_place = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (doc[o], tag[o], start[o] + src[lo] - begin[o])],
                                           ["src_doc", "src_tag", "src_start"])
    spans = pa.StructArray.from_arrays([pa.array((at[lo] - begin[s]).astype(np.int32)),
                                        pa.array((at[lo] - begin[s] + hi - lo).astype(np.int32)), src_place], ["a", "b", "src"])
    # the spans stand in the order of the stretches, each of which has at least one
    offsets = np.searchsorted(s, np.arange(len(size) + 1))
    return pa.table([pa.array(key), pa.array(content), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
                    names=["key", "content", "spans"])


def cut_bytes(batch):
    docs, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
    offsets, runs = R.list_parts(batch.column(3))
    n = np.diff(offsets)
    pieces = []
    for i, data in enumerate(texts):
        lo, hi = offsets[i], offsets[i + 1]
        pieces += [data[s:e] for s, e in zip(runs["start"][lo:hi].tolist(), runs["end"][lo:hi].tolist())]
    return {"key": runs["key"], "content": runs["content"], "first_doc": np.repeat(docs, n).astype(np.int64),
            "first_tag": np.repeat(batch.column(1).to_numpy(), n), "first_start": runs["start"],
            "bytes": pa.array(pieces, pa.binary())}


def duplicate_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_runs: int = SHARD_RUNS,
                    max_group: int = MAX_GROUP) -> DataFrame:
    """doc, tag, spans: bytes ``a`` to ``b`` of every span stand earlier, at ``src_start`` of ``src_doc``.

    At most one row a run of windows."""
    C.prepare(docs.sparkSession)
    unit = R.Unit("byte", length, gram)
    base = R.base(docs)
    found = R.candidates(base, unit, False, max_group)
    distinct, windows = R.contents(found, base, unit, max_group)
    shards = max(1, -(-(found.count() + (0 if windows is None else windows.count())) // shard_runs))
    lists = R.stretches_by_document(distinct, unit)
    cut = C.map_arrow(base.join(lists, ["doc", "tag"]).select("doc", "tag", "text", "runs"), cut_bytes,
                      "key long, content long, first_doc long, first_tag long, first_start long, bytes binary")

    def shard(table: pa.Table) -> pa.Table:
        return sources(table, length)

    matches = cut.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard").applyInArrow(shard, MATCH)
    if windows is not None:
        matches = C.stored(matches)
        src = F.col("s.src")
        origin = [src.src_doc.alias("src_doc"), src.src_tag.alias("src_tag"), (src.src_start - F.col("off")).alias("from")]
        place = F.struct("src_doc", "src_tag", (F.col("from") + F.col("a")).alias("src_start"))
        matches = matches.unionByName(R.of_contents(matches, windows, [F.col("a"), F.col("b"), place.alias("src")], origin))
    start, tag = R.start_of("place"), R.tag_of("place")

    def earlier(span):
        return span.src < F.struct(F.col("doc").alias("src_doc"), tag.alias("src_tag"), (start + span.a).alias("src_start"))

    def moved(span):
        return F.struct((start + span.a).alias("a"), (start + span.b + F.lit(length - 1)).alias("b"),
                        span.src.src_doc.alias("src_doc"), span.src.src_start.alias("src_start"))

    return (found.join(matches, ["key", "content"])
            .select("doc", tag.alias("tag"), F.transform(F.filter("spans", earlier), moved).alias("spans"))
            .where(F.size("spans") > 0))


def remove_duplicate_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                                shard_runs: int = SHARD_RUNS, max_group: int = MAX_GROUP,
                                carry: bool = False) -> DataFrame:
    """Every document without the bytes it repeats from earlier places.

    Columns: doc_id, n_bytes, n_removed, n_spans, ``kept`` (the remaining
    bytes), and with ``carry`` also ``row``, a struct of all input columns.
    """
    spans = duplicate_spans(docs, length, gram, shard_runs, max_group)
    ends = F.transform("spans", lambda span: F.struct(span.a.alias("a"), span.b.alias("b")))
    per_doc = (spans.select("doc", "tag", ends.alias("spans"))
               .groupBy("doc", "tag").agg(F.flatten(F.collect_set("spans")).alias("spans")))
    rows = docs.where("doc_id is not null")
    base = rows.select(F.struct("*").alias("row"), *R.columns()) if carry else R.base(docs)
    rest = docs.where("doc_id is null").select(
        *([F.struct("*").alias("row")] if carry else []), F.lit(None).cast("long").alias("doc"),
        F.col("text").cast("binary").alias("text"), F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("spans"))
    joined = base.join(per_doc, ["doc", "tag"], "left").select(*rest.columns).unionByName(rest)
    k = int(carry)

    def remove(batch):
        texts = batch.column(k + 1).to_pylist()
        offsets, spans_of = R.list_parts(batch.column(k + 2))
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i, data in enumerate(texts):
            data = data or b""
            lo, hi = offsets[i], offsets[i + 1]
            n_bytes.append(len(data))
            if lo == hi:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(data)
                continue
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, spans_of["a"][lo:hi], 1)
            np.add.at(edge, spans_of["b"][lo:hi], -1)
            gone = np.cumsum(edge[:-1]) > 0
            n_removed.append(int(gone.sum()))
            n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
        return {"doc_id": batch.column(k), "n_bytes": np.array(n_bytes, np.int64),
                "n_removed": np.array(n_removed, np.int64), "n_spans": np.array(n_spans, np.int64),
                "kept": pa.array(kept, pa.binary())} | ({"row": batch.column(0)} if carry else {})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return C.map_arrow(joined, remove, C.with_row(joined, schema) if carry else schema)


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, byte counts and the digest of the kept bytes, for every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_duplicate_substrings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                    F.sha2("kept", 256).alias("kept_sha256"))
