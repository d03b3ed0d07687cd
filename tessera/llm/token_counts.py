"""Token counts through a digest cache.

Every text's normalised content is digested (SHA-256); the cache is a Parquet
table of digest and count in one folder per tokenizer version, whose name is
the digest of the vocabulary file, the library and its version.  Texts whose
digest is in the cache are not encoded; of the others every distinct one is
encoded once, and its count is appended.  Counts are then joined back.

The content may be normalised only so far as no count can change.  A
vocabulary that drops white space (``drops_space``) counts every word by
itself, so runs of white space become one space and those at the ends go; its
own lower-casing stays with the library, as strings like ``<|endoftext|>`` are
special in lower case only.  Other vocabularies get the text as it is.  For
the first kind a task encodes every distinct piece of its texts once and adds
up: words, cut where one of ``.,;:!?`` follows an ASCII letter or digit, as
the vocabulary's pattern cuts there anyway, and those of ASCII letters and
digits only in lower case.

Texts meet by digest after a partial aggregate, so copies travel once a task.
If the cache holds anything, only texts still missing travel.  Counts are
joined as files, where adaptive execution splits a digest that a third of the
rows share.  An append that fails leaves nothing (its files are committed at
its end); two appends of one digest hold the same count, of which one is read.

Defined results: a null text counts as an empty one: 0 bytes, 0 tokens; very
long texts are encoded whole; rows that repeat are counted each; a null doc_id
is kept; an empty table gives an empty result; only doc_id and text are read,
so other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import common as C

LIMIT = 2048
REMEMBERED = 300_000

# fixed value: the pattern by which the vocabulary that drops white space finds its words
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = ".,;:!?"
BEFORE_MARK = re.compile(rf"(?<=[A-Za-z0-9])(?=[{MARKS}])")

COUNTS = "digest binary, n_tokens long"


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file as the driver reads it; tasks get its bytes (some MB)."""

    kind: str
    data: bytes
    drops_space: bool

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, "rb") as f:
            data = f.read()
        if path.endswith(".model"):
            return Vocabulary("sentencepiece", data, False)
        import json

        own = json.loads(data)
        # words are found by a pattern that no white space matches, after its runs became one space each
        steps = (own.get("normalizer") or {}).get("normalizers", [])
        splits = (own.get("pre_tokenizer") or {}).get("pretokenizers", [])
        one_space = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " "
                        for s in steps)
        words = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
                    and s.get("pattern") == {"Regex": WORDS} for s in splits)
        lower = any(s.get("type") == "Lowercase" for s in steps)
        apart = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or set(t["content"]) & set(MARKS + " ")
                        for t in own.get("added_tokens", []))
        return Vocabulary("tokenizers", data, one_space and words and lower and apart)

    @property
    def version(self) -> str:
        import importlib.metadata

        said = f"{self.kind} {importlib.metadata.version(self.kind)} no special tokens added "
        return hashlib.sha256(said.encode() + self.data).hexdigest()

    def encoder(self):
        """A function from texts to their numbers of tokens."""
        if self.kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(self.data.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def content(text: Column, vocabulary: Vocabulary) -> Column:
    """The text as far as its count depends on it."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.btrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")) if vocabulary.drops_space else text


def cached(spark: SparkSession, folder: str) -> DataFrame | None:
    """What the cache holds for one tokenizer version, or None without a file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(COUNTS).parquet(folder)


def pieces(text: str) -> list[str]:
    """Parts of a normalised text that are counted apart, for a vocabulary that drops white space."""
    return BEFORE_MARK.sub(" ", text).split(" ") if text else []


def same_count(piece: str) -> str:
    """A piece with the same tokens as this one."""
    return piece.lower() if piece.isascii() and piece.isalnum() else piece


def encoded(contents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(digest, n_tokens) of (digest, content) rows."""
    def run(batches):
        encode, known = vocabulary.encoder(), {}

        def by_piece(texts):
            pieces_of = [pieces(t) for t in texts]
            new = {x for some in pieces_of for x in some if x not in known}
            if len(known) + len(new) > REMEMBERED:  # memory only: they are encoded anew
                known.clear()
                new = {x for some in pieces_of for x in some}
            forms = list({f for x in new if (f := same_count(x)) not in known})
            known.update(zip(forms, encode(forms)))
            known.update([(x, known[same_count(x)]) for x in new])
            return [sum(map(known.__getitem__, some)) for some in pieces_of]

        count = by_piece if vocabulary.drops_space else encode
        for whole in batches:
            for at in range(0, whole.num_rows, C.BATCH_ROWS):
                batch = whole.slice(at, C.BATCH_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.array(count(batch.column(1).to_pylist()), np.int64))], ["digest", "n_tokens"])

    return contents.mapInArrow(run, COUNTS)


def token_counts(docs: DataFrame, vocabulary: Vocabulary, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row of ``docs``; ``cache`` is the folder of the cache."""
    spark = docs.sparkSession
    C.prepare(spark)
    folder = f"{cache.rstrip('/')}/tokenizer={vocabulary.version}"
    own = content(F.col("text"), vocabulary)
    digest = F.unhex(F.sha2(own.cast("binary"), 256)).alias("digest")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    keyed = C.stored(docs.select("doc_id", n_bytes, digest))
    texts, known = docs.select(digest, own.alias("content")), cached(spark, folder)
    if known is not None:
        missing = C.stored(keyed.select("digest").distinct().join(known, "digest", "left_anti"))
        texts = texts.join(C.small_side(missing), "digest", "left_semi")
    # a task's copies collapse before they travel
    encoded(texts.groupBy("digest").agg(F.first("content").alias("content")), vocabulary).write.mode("append").parquet(folder)
    wanted = keyed.select("digest").distinct()
    counts = C.stored(cached(spark, folder).join(wanted, "digest", "left_semi")
                      .groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def op12_token_counts(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document, through a cache that starts empty."""
    import public_tokenizers

    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts(docs, Vocabulary.load(public_tokenizers.path(tokenizer)), scratch_path(spark, "token-counts"))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
