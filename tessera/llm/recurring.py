"""Find stretches of text that may recur, without shuffling the texts.

Every window of ``length`` units (words or bytes) is keyed by the smallest
hash of the ``gram``-unit grams in it, so equal windows meet under one key
wherever they stand.  Runs of windows with one key are the rows: about
``2 / (length - gram + 2)`` per unit.  Keys that occur once are dropped after
a count with map-side combine; only the rest, and later their text, travel
again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C


class Unit:
    """Words or bytes as the units of windows."""

    def __init__(self, name: str, length: int, gram: int):
        self.name, self.length, self.gram = name, length, gram
        self.windows = length - gram + 1
        if self.windows > 127:
            raise ValueError("a run holds at most 127 windows")
        self.least_bytes = length if name == "byte" else 2 * length - 1

    def codes(self, data: bytes) -> np.ndarray:
        return C.BYTE_CODES[np.frombuffer(data, np.uint8)] if self.name == "byte" else C.word_codes(data)


def base(docs: DataFrame) -> DataFrame:
    """doc (the doc_id), text as bytes and its tag, of rows with a doc_id.

    The new name keeps this projection the same in every join of a plan, so
    that Spark shuffles the texts once and reuses that exchange.
    """
    return docs.where("doc_id is not null").select(*columns())


def columns() -> list[Column]:
    text = F.col("text").cast("binary")
    return [F.col("doc_id").cast("long").alias("doc"), text.alias("text"), C.text_tag(text).alias("tag")]


def _runs(base_docs: DataFrame, unit: Unit, columns_of, schema: str) -> DataFrame:
    """Per long enough text the columns that ``columns_of`` gives for its runs."""
    def rows(batch):
        found = []
        for d, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = unit.codes(data)
            if len(codes) >= unit.length:
                grams = C.Stretches(codes).grams(unit.gram)
                found.append(columns_of(d, data, codes, grams, *C.window_runs(grams, unit.windows)))
        if found:
            yield {c: np.concatenate([x[c] for x in found]) for c in found[0]}

    long_enough = base_docs.where(F.octet_length("text") >= unit.least_bytes).select("doc", "text")
    return C.map_arrow(long_enough, rows, schema)


def run_rows(base_docs: DataFrame, unit: Unit) -> DataFrame:
    """One row per run: key, hash of its content, document, place.

    A place is one long of tag, start and number of windows (24, 31 and the
    last 7 bits); places of one document order as (tag, start).
    """
    def columns_of(d, data, codes, grams, start, n, k):
        content = C.Stretches(codes, 1).hash(start, start + n + unit.length - 1)
        place = (C.tag_of(data) << 39) | (start.astype(np.int64) << 8) | n.astype(np.int64)
        return {"key": C.signed(k), "content": C.signed(content), "doc": np.full(len(k), d, np.int64), "place": place}

    return _runs(base_docs, unit, columns_of, "key long, content long, doc long, place long")


def recurring_keys(base_docs: DataFrame, unit: Unit, across_documents: bool) -> DataFrame:
    """key, rows: the keys that occur again; contents and places are not computed for it."""
    def with_doc(d, data, codes, grams, start, n, k):
        return {"key": C.signed(k), "doc": np.full(len(k), d, np.int64)}

    def with_times(d, data, codes, grams, start, n, k):
        return {"key": C.signed(k), "times": 1 + C.repeating_runs(grams, unit.windows, start, n, k).astype(np.int8)}

    if across_documents:
        return (_runs(base_docs, unit, with_doc, "key long, doc long").groupBy("key")
                .agg(F.count("*").alias("rows"), F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                .where("lo < hi").select("key", "rows"))
    return (_runs(base_docs, unit, with_times, "key long, times byte").groupBy("key")
            .agg(F.sum("times").alias("rows")).where("rows > 1"))


def tag_of(place) -> Column:
    return F.shiftright(place, 39)


def start_of(place) -> Column:
    return F.shiftright(place, 8).bitwiseAND(F.lit((1 << 31) - 1))


def windows_of(place) -> Column:
    return F.col(place).bitwiseAND(F.lit(127)).cast("long")


def candidates(base_docs: DataFrame, unit: Unit, across_documents: bool, max_group: int) -> DataFrame:
    """Stored runs whose key occurs again (in another document, if so asked);
    ``many``: the key has more than ``max_group`` of them."""
    runs = run_rows(base_docs, unit).join(recurring_keys(base_docs, unit, across_documents), "key")
    return C.stored(runs.withColumn("many", F.col("rows") > max_group).drop("rows"))


def contents(found: DataFrame, base_docs: DataFrame, unit: Unit, max_group: int,
             last_doc: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """One row per distinct content of the runs: key, content, doc and place
    where it stands first, and with ``last_doc`` the largest doc that has it.

    Copies of a run are one content, so a key that very many documents share
    makes no large group by itself.  A key with more than ``max_group``
    contents would put all their text into one shard.  These contents (not
    their runs) are taken apart into single windows, keyed by the hash of the
    whole window, so that only equal windows meet.  The second result has these
    windows, or is None; ``of_contents`` joins what was found for them.
    """
    def first(rows, last):
        latest = [F.max(last).alias("last_doc")] if last_doc else []
        return (rows.groupBy("key", "content").agg(F.min(F.struct("doc", "place")).alias("f"), *latest)
                .select("key", "content", "f.*", *more))

    more = ["last_doc"] if last_doc else []
    distinct = first(found, "doc")
    many = found.where("many")
    if many.isEmpty():
        return distinct, None
    hot = C.stored(many.groupBy("key").agg(F.countDistinct("content").alias("n")).where(F.col("n") > max_group).select("key"))
    if hot.isEmpty():
        return distinct, None

    def taken_apart(batch):
        docs, tags, texts = (batch.column(i).to_pylist() for i in range(3))
        offsets, runs = list_parts(batch.column(3))
        for i, data in enumerate(texts):
            codes = unit.codes(data)
            own = {c: x[offsets[i]:offsets[i + 1]] for c, x in runs.items()}
            n = (own["end"] - own["start"] - unit.length + 1).astype(np.int64)
            off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            s = np.repeat(own["start"], n).astype(np.int64) + off
            yield {"key": C.signed(C.Stretches(codes).hash(s, s + unit.length)),
                   "content": C.signed(C.Stretches(codes, 1).hash(s, s + unit.length)),
                   "doc": np.full(len(s), docs[i], np.int64), "place": (tags[i] << 39) | (s << 8) | 1,
                   "of_key": np.repeat(own["key"], n), "of_content": np.repeat(own["content"], n),
                   "off": off} | {c: np.repeat(own[c], n) for c in more}

    lists = stretches_by_document(distinct.join(hot, "key", "left_semi"), unit, *more)
    windows = C.stored(C.map_arrow(base_docs.join(lists, ["doc", "tag"]).select("doc", "tag", "text", "runs"), taken_apart,
                                   ", ".join(f"{c} long" for c in ["key", "content", "doc", "place", "of_key", "of_content",
                                                                   "off", *more])))
    return distinct.join(hot, "key", "left_anti").unionByName(first(windows, "last_doc")), windows


def of_contents(matches: DataFrame, windows: DataFrame, span: list[Column], origin: list[Column]) -> DataFrame:
    """key, content, spans of the contents taken apart, from what was found for their windows.

    Windows of a content with the same ``origin`` are less than their length
    apart, so together they cover one stretch, from the least ``a`` to the
    largest ``b``; ``span`` builds its struct from a, b and the origin.
    """
    each = matches.select("key", "content", F.explode("spans").alias("s"))
    return (windows.join(each, ["key", "content"])
            .groupBy("of_key", "of_content", *origin)
            .agg(F.min(F.col("off") + F.col("s.a")).cast("int").alias("a"), F.max(F.col("off") + F.col("s.b")).cast("int").alias("b"))
            .groupBy(F.col("of_key").alias("key"), F.col("of_content").alias("content"))
            .agg(F.collect_list(F.struct(*span)).alias("spans")))


def stretches_by_document(runs: DataFrame, unit: Unit, *more: str) -> DataFrame:
    """Per document the list of its runs (bounded by its text), with their first
    and last unit."""
    end = start_of("place") + windows_of("place") + F.lit(unit.length - 1)
    return (runs.withColumn("tag", tag_of("place")).groupBy("doc", "tag")
            .agg(F.collect_list(F.struct("key", "content", start_of("place").alias("start"), end.alias("end"), *more))
                 .alias("runs")))


def list_parts(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and flat fields of a column of lists of structs of numbers."""
    flat = column.flatten()
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    return offsets, {f.name: np.asarray(flat.field(i)) for i, f in enumerate(flat.type)}
