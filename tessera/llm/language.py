"""Language identification by compression.

Each language has a raw-content zstandard dictionary of sample text.  A text
goes, in blocks, through one compressor per language; the language whose
dictionary gives the smallest size wins, and the decision is rejected
(``accepted`` false) when the runner-up is within ``margin``.

Bounded sample: per language at most ``SAMPLE_DOCS`` documents, those with the
smallest hash of their doc_id, up to ``SAMPLE_BYTES`` each, fill a dictionary;
every text is classified whole.

Defined results: a null text or one without a letter is ``und`` with score 0;
an equal size goes to the language first by code point; with no labelled text
all is ``und``; rows that repeat are classified each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE_DOCS = 64
SAMPLE_BYTES = 2048
BLOCK_BYTES = 4096
LEVEL = 6
MARGIN = 0.01


NO_LETTERS = bytes(c for c in range(33, 127) if not chr(c).isalpha() and chr(c) not in ".,'-")


def plain(data: bytes) -> bytes:
    """A-Z lower-cased, ASCII symbols and digits dropped: they tell no language."""
    return data.lower().translate(None, NO_LETTERS)


def learn(labelled: DataFrame, docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A dictionary's content per language, from a bounded sample."""
    C.prepare(labelled.sparkSession)
    known = labelled.where("lang is not null and text is not null and length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id").alias("h"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    bound = F.lit(None).cast("double")
    for lang, n in counts.items():
        bound = F.when(F.col("lang") == lang, F.lit(min(1.0, 4.0 * docs / n))).otherwise(bound)
    unit = (F.col("h") / F.lit(2.0**64)) + 0.5
    # about 4 x docs rows a language get here; the smallest hashes of them are kept
    rows = known.where(unit <= bound).groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(
        F.struct("h", F.substring(F.col("text"), 1, size).alias("t")))), 1, docs).alias("rows")).collect()
    return {r.lang: b"\n".join(plain(x.t.encode()[:size]) for x in reversed(r.rows)) for r in sorted(rows, key=lambda r: r.lang)}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL,
             block: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` but text, then lang_pred, score and accepted; input
    columns of these names stay, in their places."""
    kept = [c for c in docs.columns if c != "text"]
    langs = sorted(dictionaries)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(F.struct(*C.columns(kept)).alias("row"),
                         F.when(letters, F.col("text").cast("binary")).alias("text"))

    def predict(batches):
        coders = []
        for lang in langs:
            d = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            coders.append(zstd.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False))
        for batch in batches:
            pred, score, accepted = [], [], []
            for data in batch.column(1).to_pylist():
                if data is None or not langs:
                    pred.append("und")
                    score.append(0.0)
                    accepted.append(False)
                    continue
                data = plain(data)
                pieces = [data[i:i + block] for i in range(0, len(data), block)] or [b""]
                sizes = [sum(len(c.compress(p)) for p in pieces) for c in coders]
                best = int(np.argmin(sizes))
                second = min([s for i, s in enumerate(sizes) if i != best], default=2 * sizes[best])
                s = 1.0 - sizes[best] / second
                pred.append(langs[best])
                score.append(min(1.0, max(0.0, s)))
                accepted.append(s >= margin)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(accepted, pa.bool_())], ["row", "lang_pred", "score", "accepted"])

    return (source.mapInArrow(predict, C.with_row(source, "lang_pred string, score double, accepted boolean"))
            .select(*[F.col("row").getField(c).alias(c) for c in kept], "lang_pred", "score", "accepted"))


def op3_compression_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = C.read(spark, sf_dir, "documents")
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    dictionaries = learn(docs.where(third != 1).select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), dictionaries)
    return out.select("doc_id", (third == 1).alias("held_out"), "lang_pred", "score", "accepted")
