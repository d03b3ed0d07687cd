"""Target-distribution importance resampling by overlapped regex scanning.

A text's separators are collapsed to single spaces, and per n-gram size one
pattern with boundary lookarounds, searched with overlapping matches, emits
the spans of all runs of that many words.  A feature's bucket is the CRC of
its span.  Bucket counts of the whole corpus and of the target give every
bucket a gain (the logarithm of the smoothed ratio of frequencies); a
document's weight is the sum of gains over its features, and the largest sums
of weight and seeded Gumbel noise are drawn, which samples without replacement
in proportion to the weights.

Texts are scanned once: what is stored of a row is its distinct buckets with
their counts, at most ``buckets`` entries.  Tasks add up their rows' counts
before the shuffle, so the driver gets one number a bucket.  Scores are ranked
by range partitions, in each of which a row's place is its position in the
sorted order; the driver gets one count a partition.

Defined results: null or empty texts have no features and weight 0; texts of
under ``least_words`` words are scored but not drawn; a null doc_id enters the
noise as an empty string and comes last among equal scores; rows that repeat
are scored and drawn each, equal ones in any order; an empty corpus gives an
empty result, an empty target lowers every bucket by what the corpus holds;
only doc_id and text are read, so other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .recurring import list_parts

BUCKETS = 10_000
NGRAMS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Every byte that no word holds becomes a space; A-Z are lower-cased before.
SPACED = bytes(c if c > 127 or chr(c).isdigit() or "a" <= chr(c) <= "z" else 32 for c in range(256))


def collapsed(data: bytes) -> bytes:
    """A-Z lower-cased, every run of separators one space, none at the ends."""
    return b" ".join(C.lower_ascii(data).translate(SPACED).split())


def span_patterns(ngrams: int) -> list:
    """For every size a pattern of that many whole words, one space between."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(1, ngrams + 1)]


def feature_buckets(text: bytes, patterns: list, buckets: int) -> np.ndarray:
    """Bucket of every feature of a collapsed text, repeats included."""
    crcs = (zlib.crc32(m.group()) for p in patterns for m in p.finditer(text, overlapped=True))
    return np.fromiter(crcs, np.int64) % buckets


def bucket_counts(texts: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, found) a row: the distinct buckets with their counts; stored.

    ``texts`` has an id and a text.
    """
    C.prepare(texts.sparkSession)

    def scan(batch):
        patterns = span_patterns(ngrams)
        n_words, n_features, which, counts, lengths = [], [], [], [], []
        for data in batch.column(1).to_pylist():
            text = collapsed(data or b"")
            b = feature_buckets(text, patterns, buckets)
            distinct, n = np.unique(b, return_counts=True)
            n_words.append(text.count(b" ") + 1 if text else 0)
            n_features.append(len(b))
            which.append(distinct)
            counts.append(n)
            lengths.append(len(distinct))
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int32()) for x in (which, counts)],
                                          ["bucket", "n"])
        found = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), flat)
        return {"id": batch.column(0), "n_words": np.array(n_words, np.int64),
                "n_features": np.array(n_features, np.int64), "found": found}

    rows = texts.select(F.col(texts.columns[0]).cast("long").alias("id"), F.col(texts.columns[1]).cast("binary").alias("text"))
    return C.stored(C.map_arrow(rows, scan, "id long, n_words long, n_features long, found array<struct<bucket:int,n:int>>"))


def totals(counted: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features in every bucket over all rows; tasks add up theirs first."""
    def add(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            _, found = list_parts(batch.column(0))
            sums += np.bincount(found["bucket"], found["n"], buckets).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    parts = counted.select("found").mapInArrow(add, "bucket long, n long")
    out = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Per bucket: floor of 1000 times the logarithm of target over corpus frequency, one added to every count."""
    k, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000.0 * math.log((float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))))
            for s, t in zip(corpus, target)]


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(counted: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and a number of its own for every row; stored."""
    table = np.array(gain, np.int64)

    def score(batch):
        ids = batch.column(0).to_pylist()
        offsets, found = list_parts(batch.column(3))
        sums = np.concatenate(([0], np.cumsum(table[found["bucket"]] * found["n"])))
        weight = sums[offsets[1:]] - sums[offsets[:-1]]
        return {"doc_id": batch.column(0), "n_words": batch.column(1), "n_features": batch.column(2), "weight": weight,
                "score": weight + np.array([noise(seed, i) for i in ids], np.int64)}

    out = C.map_arrow(counted, score, "doc_id long, n_words long, n_features long, weight long, score long")
    return C.stored(out.withColumn("row", F.monotonically_increasing_id()))


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, ... on the ``percent`` of them with the highest scores, null on the others."""
    spark, order = rows.sparkSession, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    # a partition's number stands in the high bits, a row's place in it in the low ones
    sorted_rows = C.stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, n = [], 0
    for r in sizes:
        before.append((r.part, n))
        n += r.n
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    offsets = spark.createDataFrame(before, "part long, before long")  # one row a partition
    rank = F.when(place < F.lit(n * percent // 100), place + 1)
    return (sorted_rows.withColumn("part", part).join(F.broadcast(offsets), "part")
            .select(*rows.columns, rank.alias("rank")))


def resample(docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS,
             least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for every row of ``docs``; rank null where not drawn.

    ``docs`` and ``target`` have a text each; ``docs`` has a doc_id.
    """
    counted = bucket_counts(docs.select("doc_id", "text"), ngrams, buckets)
    wanted = bucket_counts(target.select(F.lit(0).alias("id"), "text"), ngrams, buckets)
    out = scored(counted, gains(totals(counted, buckets), totals(wanted, buckets)), seed)
    drawn = ranked(out.where(F.col("n_words") >= least_words), percent)
    rest = out.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("row")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document, drawn to look like the benchmark."""
    out = resample(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
