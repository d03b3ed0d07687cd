"""Helpers shared by the operators of this subpackage.

Texts are handled as UTF-8 bytes.  A word is a maximal run of bytes outside
``0x20`` and ``0x09``-``0x0D`` (all ASCII, so bytes and code points agree), and
``bytes.split()`` yields exactly these words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..lifetimes import note_folder
from ..session import ensure_checkpoint_dir, ship_package

U64 = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def prepare(spark: SparkSession) -> None:
    """Task code reaches the executors; a checkpoint folder is known; Arrow batches
    are bounded in bytes and Parquet's in rows, unless the session has bounds of its own.

    By rows alone (10,000) an Arrow batch of texts takes tens of MB, and twice that
    while its buffers grow, in the executor's native memory, which keeps much
    of it, and again in each Python worker.  Spark's Parquet reader decodes 4,096
    texts at a time onto the heap; 512 of 2 KB are 1 MB.
    """
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    for name, bound in ((ARROW_BYTES, "1m"), (READER_ROWS, "512")):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, bound)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = 500
BROADCAST_IDS = 1_000_000


def small_side(ids: DataFrame) -> DataFrame:
    """``ids`` (one long a row) to be broadcast if it has at most ``BROADCAST_IDS``
    rows, which are counted; beyond that the planner shuffles the join."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return F.broadcast(ids) if few else ids


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage like ``checkpoint()`` at a third of its size (columns are
    encoded and compressed).  The files go with the enclosing
    ``lifetimes.scope``, or when the application ends.
    """
    spark = df.sparkSession
    prepare(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/stored-{uuid.uuid4().hex}"
    note_folder(spark, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str | T.StructType) -> DataFrame:
    """``fn`` turns one Arrow batch, of ``BATCH_ROWS`` rows at most so that what it
    derives stays small, into a dict of columns (or several dicts)."""
    names = T.DataType.fromDDL(schema).names if isinstance(schema, str) else schema.names

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                out = fn(batch)
                for cols in ([out] if isinstance(out, dict) else out):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c)
                                                      for c in (cols[n] for n in names)], names)
    return df.mapInArrow(run, schema)


def columns(names: Iterable[str]) -> list[Column]:
    """Columns of these very names, dots and spaces included."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def with_row(source: DataFrame, more: str) -> T.StructType:
    """Schema of ``row``, the struct of all input columns whatever their names, and of ``more``."""
    return T.StructType([source.schema["row"], *T.DataType.fromDDL(more).fields])


# --- hashing of byte and word sequences ----------------------------------

class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand.

    With them the hash of any stretch is a difference of two prefix sums.
    Pickled empty, so that no table travels with a task.
    """

    def __init__(self, base: int):
        self.base, self.pow, self.inv = base, np.empty(0, U64), np.empty(0, U64)

    def __reduce__(self):
        return Powers, (self.base,)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pow) < n + 1:
            size = max(4096, 2 * (n + 1))
            for name, b in (("pow", self.base), ("inv", pow(self.base, -1, 2**64))):
                a = np.full(size, b, U64)
                a[0] = 1
                setattr(self, name, np.cumprod(a))
        return self.pow, self.inv


BASES = Powers(0x9E3779B97F4A7C15), Powers(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U64))


class Stretches:
    """Hash of any stretch of a sequence of 64-bit codes, from prefix sums."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        n = len(codes)
        p, self.inv = BASES[which].upto(n)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(codes * p[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])

    def grams(self, k: int) -> np.ndarray:
        m = len(self.sums) - k
        h = (self.sums[k:] - self.sums[:m]) * self.inv[:m]
        return (h ^ (h >> U64(32))) * U64(0x9FB21C651E98DF25)  # the high bits, which order grams, are well mixed


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the text, first byte and end of every word."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~SEPARATOR[b]
    edge = np.diff(inside)
    return b, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_codes(data: bytes) -> np.ndarray:
    """A 64-bit code for every word of the text, in order."""
    b, s, e = word_spans(data)
    return Stretches(BYTE_CODES[b]).hash(s, e) if len(s) else np.empty(0, U64)


def lower_ascii(data: bytes) -> bytes:
    """A-Z lower-cased, all else unchanged (``bytes.lower`` is ASCII only)."""
    return data.lower()


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- windows keyed by their smallest gram --------------------------------

def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = w - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def window_runs(grams: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and key of every run.

    A window of ``w`` grams has its smallest gram hash as key: equal windows
    have equal keys.  Neighbouring windows of one key make a run, cut after
    ``w`` windows (only periodic text has longer ones).
    """
    m = sliding_min(grams, w)
    at = np.flatnonzero(m[1:] != m[:-1]) + 1
    start = np.concatenate(([0], at))
    n = np.diff(np.concatenate((start, [len(m)])))
    if n.max() > w:
        pieces = -(-n // w)
        which = np.repeat(np.arange(len(n)), pieces)
        off = (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * w
        start, n = start[which] + off, np.minimum(n[which] - off, w)
    return start, n, m[start]


def repeating_runs(grams: np.ndarray, w: int, start: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """True for runs that may hold two equal windows.

    These are at most ``w - 1`` apart, so all ``w`` grams of the first recur
    within ``w``, and one of them is a ``w``-th gram of the text: a cheap test
    that few texts pass.  Only in those the key is counted within each run.
    """
    out = np.zeros(len(start), bool)
    if len(grams) > w:
        views = np.lib.stride_tricks.sliding_window_view(np.append(grams, np.arange(w, dtype=U64)), w)[:len(grams):w]
        if (views[:, 1:] == views[:, :1]).any():
            for i, (s, m, k) in enumerate(zip(start.tolist(), n.tolist(), key)):
                out[i] = np.count_nonzero(grams[s:s + m + w - 1] == k) > 1
    return out


TEXT_TAG_BITS = 0xFFFFFF


def text_tag(text: Column) -> Column:
    """24 bits of the text, which tell rows of one doc_id apart (0 for null)."""
    return F.coalesce(F.crc32(text).bitwiseAND(F.lit(TEXT_TAG_BITS)), F.lit(0)).cast("long")


def tag_of(data: bytes) -> int:
    return zlib.crc32(data) & TEXT_TAG_BITS


# --- connected components -------------------------------------------------

def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links``; component: smallest node.

    Alternating large-star and small-star rounds, each an aggregate and a
    join, until no edge changes.  A node with very many links costs one
    partial aggregate and a join whose skew Spark can split; nothing is
    collected.  Every round is checkpointed.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u <> v").distinct().checkpoint())
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        edges = small.where("u <> v").distinct().checkpoint()
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
