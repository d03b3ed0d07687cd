"""Quality rules with cross-document line frequency.

Base rules look at one text.  The cross-document rule hashes every normalised
line (A-Z lower-cased, digit runs as one 0, white space runs as one space),
counts the distinct documents of each host that hold it, removes lines in more
than ``max(least, share * documents of the host)`` of them, and rejects
documents that keep less than ``keep`` of their words.

Only hashes and counts are shuffled.  A document sends a line once, and the
counts combine before the shuffle, so a line that every document holds is one
row a task.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; a null host is a host of its own; rows that repeat a doc_id count
once for it in the line counts and are judged each; very long texts are taken
whole; an empty table gives an empty result; extra columns of any name are
carried along in ``row`` if asked for, else not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
LEAST = 20
SHARE = 0.05
KEEP = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_DIGITS = re.compile(rb"[0-9]+")


def normal_line(words: list[bytes]) -> bytes:
    return _DIGITS.sub(b"0", b" ".join(words).lower())


def base_counts(data: bytes, window: int = WINDOW) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, duplicate lines, words in repeated windows."""
    b, starts, ends = C.word_spans(data)
    n = len(starts)
    inside = ~C.SEPARATOR[b]
    chars = int((inside & ((b & 0xC0) != 0x80)).sum())
    lines = [x for x in data.split(b"\n") if x.split()] if b"\n" in data else []
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= window:
        grams = C.mix(C.Stretches(C.Stretches(C.BYTE_CODES[b]).hash(starts, ends)).grams(window))
        order = np.argsort(grams, kind="stable")
        same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
        if len(same):
            again = np.zeros(len(grams), bool)
            again[order[same]] = again[order[same + 1]] = True
            edge = np.zeros(n + 1, np.int32)
            edge[:len(grams)] += again
            edge[window:] -= again
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return n, chars, int(SYMBOL[b].sum()), dup, repeated


def line_hash(line: bytes) -> int:
    """Hash of a normalised line."""
    return int(C.signed(C.Stretches(C.BYTE_CODES[np.frombuffer(line, np.uint8)]).hash(np.array([0]), np.array([len(line)])))[0])


def measured(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Base counts of every row, and its distinct lines: hash and words; with ``carry`` also the row itself."""
    def rows(batch):
        counts, lines, words = [], [], []
        for data in batch.column(3).to_pylist():
            data = data or b""
            counts.append(base_counts(data))
            of_doc: dict[bytes, int] = {}
            for line in data.split(b"\n"):
                w = line.split()
                if w:
                    key = normal_line(w)
                    of_doc[key] = of_doc.get(key, 0) + len(w)
            lines.append([line_hash(k) for k in of_doc])
            words.append(list(of_doc.values()))
        c = np.array(counts, np.int64).reshape(-1, 5)
        return {"rid": batch.column(0), "doc_id": batch.column(1), "host": batch.column(2),
                "n_words": c[:, 0], "word_chars": c[:, 1], "n_symbols": c[:, 2], "n_dup_lines": c[:, 3],
                "n_repeat_words": c[:, 4], "lines": pa.array(lines, pa.list_(pa.int64())),
                "line_words": pa.array(words, pa.list_(pa.int64()))} | ({"row": batch.column(4)} if carry else {})

    whole = [F.struct("*").alias("row")] if carry else []
    source = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("source").alias("host"), F.col("text").cast("binary").alias("text"), *whole)
    schema = ("rid long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, lines array<long>, line_words array<long>")
    # stored: row numbers must not change between the uses below
    return C.stored(C.map_arrow(source, rows, C.with_row(source, schema) if carry else schema))


def without_lines(rows: DataFrame) -> DataFrame:
    """``rows`` with ``kept_text`` and ``removed_lines``, the numbers (from 0) of the lines whose hash is in ``gone``."""
    kept = [c for c in rows.columns if c not in ("row", "gone")]
    source = rows.select("row", F.col("row.text").cast("binary").alias("text"), "gone", F.struct(*kept).alias("rest"))

    def cut(batch):
        texts, numbers = [], []
        for data, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if not gone:
                texts.append(data)
                numbers.append([])
                continue
            lines, gone = data.split(b"\n"), set(gone)
            out = [i for i, line in enumerate(lines) if (w := line.split()) and line_hash(normal_line(w)) in gone]
            numbers.append(out)
            out = set(out)
            texts.append(b"\n".join([line for i, line in enumerate(lines) if i not in out]))
        return {"row": batch.column(0), "rest": batch.column(3), "kept_text": pa.array(texts, pa.binary()),
                "removed_lines": pa.array(numbers, pa.list_(pa.int32()))}

    schema = C.with_row(source, "kept_text binary, removed_lines array<int>").add(source.schema["rest"])
    return (C.map_arrow(source, cut, schema)
            .select("row", "rest.*", F.col("kept_text").cast("string").alias("kept_text"), "removed_lines"))


def quality_rules(docs: DataFrame, least: int = LEAST, share: float = SHARE, keep: float = KEEP,
                  carry: bool = False) -> DataFrame:
    """doc_id, base counts, base_failed, kept, removed_words.

    With ``carry`` also ``row``, a struct of all input columns, ``kept_text``,
    the text without the lines above the limits (unchanged where there are
    none; null stays null), and ``removed_lines``, their numbers from 0.
    """
    C.prepare(docs.sparkSession)
    rows = measured(docs, carry)
    lines = rows.select("rid", "doc_id", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "rid", "doc_id", "host", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    hosts = (rows.groupBy(F.col("host").alias("of")).agg(F.countDistinct(F.coalesce("doc_id", -F.col("rid") - 1))
                                                         .alias("host_docs")))
    # rows of one doc_id count once; ids repeat seldom, so most pairs are counted before the shuffle
    frequent = (one_row_per_document(lines, rows).groupBy("host", "line").agg(F.count("*").alias("docs"))
                .where(F.col("docs") > least)
                .join(hosts, F.col("host").eqNullSafe(F.col("of"))).where(F.col("docs") > share * F.col("host_docs"))
                .select("host", "line"))
    removed = (lines.alias("l").join(frequent.alias("f"), (F.col("l.line") == F.col("f.line"))
                                     & F.col("l.host").eqNullSafe(F.col("f.host")))
               .groupBy("l.rid").agg(F.sum("l.words").alias("removed_words"),  # a row's lines: bounded by its text
                                     *([F.collect_set("l.line").alias("gone")] if carry else [])))
    removed_words = F.coalesce("removed_words", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("n_words") - removed_words) < keep * F.col("n_words")
    out = (rows.drop("lines", "line_words").join(removed, "rid", "left")
           .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                   removed_words.alias("removed_words"), *(["row", "gone"] if carry else [])))
    return without_lines(out) if carry else out


def one_row_per_document(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(host, line) once for every document that holds the line."""
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return lines.select("host", "line")
    return (lines.join(repeated, "doc_id", "left_anti").select("host", "line")
            .unionByName(lines.join(repeated, "doc_id", "left_semi").select("host", "line", "doc_id").distinct()
                         .select("host", "line")))


def op6_line_frequency_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and the verdict for every document."""
    return quality_rules(C.read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
