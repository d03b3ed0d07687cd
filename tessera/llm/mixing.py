"""Mix sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length.  A source takes every
document ``floor(target / size)`` times; what is left of its budget is filled
by a choice of documents, given as a number per length: first the same share of
every length, then the longest that still fit, and a bounded-knapsack dynamic
program over the remaining counts for the last ``exact_budget`` words.  Within
a length the documents with the smallest seeded hash are taken, so reruns
agree.

Only counts reach the program, one source to a task.  Lengths with many
documents are split by hash into buckets before documents are ranked, so equal
lengths never meet in one task.

Defined results: a null text has size 0 and is taken 0 times; a null source is
a source of its own, last; a null seed value or doc_id hashes like any other;
rows that repeat are documents of their own, in any order among each other;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 20
EXACT_BUDGET = 20_000
BUCKET = 4096


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> list[float]:
    """Words wanted of every source: the total shared by weight, none above
    ``most`` times its size; what is above goes to the others by weight."""
    budget = share * sum(n for _, n in sizes)
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    left = budget
    while free:
        total = sum(w[i] for i in sorted(free))
        above = [i for i in sorted(free) if left * w[i] / total > most * sizes[i][1]]
        if not above:
            for i in free:
                out[i] = left * w[i] / total
            break
        for i in above:
            out[i] = float(most * sizes[i][1])
            free.discard(i)
        left = budget - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of every length to take for the largest sum up to ``budget``.

    Reachable sums are the bits of one integer; counts enter as powers of two.
    """
    limit = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, k = min(counts[length], budget // length), 1
        while left > 0:
            n = min(k, left)
            new = (reach | (reach << (n * length))) & limit
            if new != reach:
                steps.append((length, n, reach))
                reach = new
            left -= n
            k *= 2
    total, out = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            total -= n * length
            out[length] = out.get(length, 0) + n
    return out


def choose(counts: dict[int, int], budget: int, exact_budget: int = EXACT_BUDGET) -> dict[int, int]:
    """Documents to take of every length, at most ``budget`` words in all."""
    counts = {k: n for k, n in counts.items() if k > 0 and n > 0}
    size = sum(k * n for k, n in counts.items())
    if budget >= size:
        return counts
    taken = {k: n * budget // size for k, n in counts.items()} if size else {}
    left = budget - sum(k * n for k, n in taken.items())
    for k in sorted(counts, reverse=True):
        if left <= exact_budget:
            break
        more = min(counts[k] - taken[k], (left - exact_budget) // k + 1, left // k)
        taken[k] += more
        left -= more * k
    for k, n in knapsack({k: counts[k] - taken[k] for k in counts if k <= left}, min(left, exact_budget)).items():
        taken[k] += n
    return taken


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
        exact_budget: int = EXACT_BUDGET, bucket: int = BUCKET) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``."""
    spark = docs.sparkSession
    C.prepare(spark)
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = C.stored(docs.select("doc_id", "source", words.alias("size"),
                                F.xxhash64(F.lit(seed), "doc_id").alias("h")))
    # one row a source: the mixing plan, not a table
    sizes = [(r.source, int(r.n)) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    sizes.sort(key=lambda x: (x[0] is None, (x[0] or "").encode()))
    wanted = targets(sizes, weights, share, most)
    plan = spark.createDataFrame([(s, n, float(t)) for (s, n), t in zip(sizes, wanted)],
                                 "source string, source_size long, target double")

    def fit(key, pdf):
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = int(target // size) if size else 0
        extra = choose(dict(zip(pdf["size"].tolist(), pdf["n"].tolist())), int(target) - whole * size, exact_budget)
        if whole >= most:
            extra = {}
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "n": pdf["n"], "whole": whole,
                             "extra": [extra.get(k, 0) for k in pdf["size"].tolist()]})

    counts = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    same_source = F.col("c.source").eqNullSafe(F.col("p.source"))
    chosen = (counts.alias("c").join(plan.alias("p"), same_source).select("c.*", "source_size", "target")
              .groupBy("source").applyInPandas(fit, "source string, size long, n long, whole long, extra long"))
    on = (F.col("r.size") == F.col("k.size")) & F.col("r.source").eqNullSafe(F.col("k.source"))
    placed = (rows.alias("r").join(chosen.alias("k"), on).select("r.*", "n", "whole", "extra")
              .withColumn("buckets", F.floor((F.col("n") - 1) / F.lit(bucket)) + 1)
              .withColumn("b", F.pmod("h", "buckets")))
    # documents in earlier buckets of the same source and length, then the rank in the bucket
    length = ("source", "size")
    before = (placed.groupBy(*length, "b").agg(F.count("*").alias("m"))
              .withColumn("before", F.sum("m").over(Window.partitionBy(*length).orderBy("b")
                                                    .rowsBetween(Window.unboundedPreceding, -1)))
              .select(*length, "b", F.coalesce("before", F.lit(0)).alias("before")))
    on = ((F.col("x.size") == F.col("y.size")) & (F.col("x.b") == F.col("y.b"))
          & F.col("x.source").eqNullSafe(F.col("y.source")))
    rank = F.row_number().over(Window.partitionBy(*length, "b").orderBy("h", "doc_id"))
    copies = F.col("whole") + (F.col("before") + rank <= F.col("extra")).cast("long")
    ranked = (placed.alias("x").join(before.alias("y"), on).select("x.*", "before")
              .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)))
    return (ranked.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
            .select("doc_id", "d.source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def op10_source_mix(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")
