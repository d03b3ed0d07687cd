"""Groups that grow with the data must not multiply rows, and what is found stays the same:
repeated passages, duplicate bytes, benchmark windows that many share, ids that texts share."""

import collections
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, decontaminate, line_rules, phrases, recurring, substrings


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(n))


# --- op2 -------------------------------------------------------------------------

def brute_removed(rows, length):
    first = {}
    for d, t in sorted(rows):
        w = t.split()
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i:i + length]), d)
    out = collections.Counter()
    for d, t in rows:
        w, gone = t.split(), set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        out[d, len(w), len(gone)] += 1
    return out


@pytest.mark.parametrize("copies", [10, 40])
def test_spans_have_one_row_a_run_whatever_the_number_of_copies(spark, copies):
    """Near copies differ at many places, so that a run meets many passages."""
    rnd = random.Random(copies)
    base = prose(rnd, 120).split()
    rows = []
    for d in range(copies):
        w = list(base)
        for _ in range(2):
            w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10 ** 6)}"
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = phrases.repeated_spans(docs, 20, 5)
    unit = recurring.Unit("word", 20, 5)
    runs = recurring.candidates(recurring.base(docs), unit, True, phrases.MAX_GROUP)
    assert spans.count() <= runs.count()
    out = phrases.remove_repeated_phrases(docs, 20, 5)
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in out.collect()) == brute_removed(rows, 20)


def test_widest_spans_cover_all_for_every_reader():
    rnd = random.Random(1)
    for _ in range(200):
        spans = {(a := rnd.randrange(12), a + rnd.randrange(1, 8), rnd.randrange(6)) for _ in range(rnd.randrange(1, 15))}
        kept = phrases.widest(spans)
        for reader in range(8):
            cover = [{i for s in found if s[2] < reader for i in range(s[0], s[1])}
                     for found in (spans, [(k["a"], k["b"], k["origin"]) for k in kept])]
            assert cover[0] == cover[1]


@pytest.mark.parametrize("length", [20, 21])
def test_near_copies_are_not_compared_with_one_another(monkeypatch, length):
    """120 near copies, each in two documents: a text is compared with passages that it holds, not with all."""
    rnd = random.Random(length)
    base, texts = prose(rnd, 70).split(), []
    for i in range(120):
        w = list(base)
        w[rnd.randrange(len(w))] = f"edit{i}"
        texts.append(w)
    table = pa.table({"key": [1] * 120, "content": list(range(120)), "first_doc": list(range(0, 240, 2)),
                      "last_doc": list(range(1, 241, 2)), "words": [" ".join(w).encode() for w in texts]})
    calls, extend = [], phrases.extend
    monkeypatch.setattr(phrases, "extend", lambda *a: calls.append(1) or extend(*a))
    out = phrases.locate(table, length).to_pylist()
    first = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i:i + length]), 2 * d)
    assert len(out) == 120
    for row in out:
        w = texts[row["content"]]
        for reader in (2 * row["content"], 2 * row["content"] + 1):
            want = {j for i in range(len(w) - length + 1) if first[tuple(w[i:i + length])] < reader
                    for j in range(i, i + length)}
            assert {j for s in row["spans"] if s["origin"] < reader for j in range(s["a"], s["b"])} == want
    assert len(calls) <= 12 * sum(len(row["spans"]) for row in out)


# --- op9 -------------------------------------------------------------------------

def test_repeated_rows_add_no_spans_beyond_their_own(spark):
    rnd = random.Random(3)
    inner = prose(rnd, 30)
    text = f"{inner} {prose(rnd, 10)} {inner}"
    counts = []
    for n in (40, 160):
        docs = spark.createDataFrame([(5, text)] * n + [(6, inner), (4, "x")], "doc_id long, text string").repartition(3)
        counts.append(substrings.duplicate_spans(docs).agg(F.sum(F.size("spans"))).first()[0])
        out = substrings.remove_duplicate_substrings(docs).collect()
        assert {(r.doc_id, r.n_spans) for r in out} == {(5, 1), (6, 1), (4, 0)} and len(out) == n + 2
        assert {r.n_removed for r in out if r.doc_id == 6} == {len(inner)}
    assert counts[1] <= 4.5 * counts[0]  # in proportion to the rows


@pytest.mark.parametrize("max_group", [60, 30, 3])
def test_a_key_that_many_share_brings_one_row_a_run(spark, max_group):
    """40 texts share a passage whose edges differ; 20 more are copies of one of them."""
    rnd = random.Random(5)
    passage = prose(rnd, 40)
    texts = [f"{prose(rnd, 12)} {passage} {prose(rnd, 12)}" for _ in range(40)]
    rows = list(enumerate(texts + [texts[7]] * 20))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    base = recurring.base(docs)
    runs = recurring.candidates(base, recurring.Unit("byte", 100, 20), False, 10 ** 9).count()
    assert substrings.duplicate_spans(docs, max_group=max_group).count() <= runs
    seen, want = set(), {}
    for d, t in rows:
        gone = set()
        for i in range(len(t) - 99):
            if t[i:i + 100] in seen:
                gone.update(range(i, i + 100))
            seen.add(t[i:i + 100])
        want[d] = len(gone)
    out = substrings.remove_duplicate_substrings(docs, max_group=max_group)
    assert {r.doc_id: r.n_removed for r in out.collect()} == want

    runs = recurring.candidates(base, recurring.Unit("word", 20, 5), True, 10 ** 9).count()
    assert phrases.repeated_spans(docs, 20, 5, max_group=max_group).count() <= runs
    out = phrases.remove_repeated_phrases(docs, 20, 5, max_group=max_group)
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in out.collect()) == brute_removed(rows, 20)


# --- op7 -------------------------------------------------------------------------

def found(spark, rows, items, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.kind, r.matched, r.windows)
            for r in decontaminate.contaminated(docs, bench, fold_case=True, **more).collect()}


def test_a_sentence_that_all_share_brings_no_pairs(spark, monkeypatch):
    """200 items open with one sentence that 200 documents quote; none of them holds an item."""
    rnd = random.Random(7)
    common_words = "please read the following question with great care and then give one answer"
    items = [f"{common_words} {prose(rnd, 25)}" for _ in range(200)]
    rows = [(d, f"{prose(rnd, 30)} {common_words} {prose(rnd, 30)}") for d in range(200)] + [(500, f"so {items[3]} end")]
    written = []

    def spy(df, original=common.stored):
        out = original(df)
        written.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(common, "stored", spy)
    assert set(found(spark, rows, items)) == {(500, 3)}
    of_pairs = [n for columns, n in written if "item_id" in columns]
    assert of_pairs and max(of_pairs) < 5 * 200


def test_nouns_with_capitals_are_no_evidence(spark):
    items = ["Dann ging der Mann in den Wald und holte das Holz mit dem Wagen",
             "heute sagte er dass der Mann im Wald das Haus und den Hof mit dem Wagen sah",
             "The Old Man and the Sea by the Shore with a Boat of Wood and a Sail"]
    rows = [(1, "Dann ging der Koch in den Garten und holte das Salz mit dem Korb"),
            (2, "heute sagte er dass der Koch im Garten das Feld und den Weg mit dem Korb sah"),
            (3, "The Young Girl and the Lake by the Meadow with a Cart of Stone and a Rope"),
            (4, f"vorher. {items[0]} nachher"), (5, f"gestern {items[1]}")]
    assert {k: v[0] for k, v in found(spark, rows, items).items()} == {(4, 0): "exact", (5, 1): "exact"}


def test_other_scripts_and_units(spark):
    items = ["вчера днем Анна купила 5 кг яблок и потом Анна отдала 2 кг соседу за углом",
             "gestern fuhr Karl 60 km in 2 Stunden und danach ging Karl noch 3 km zu seinem Haus",
             "χθες η Άννα πήρε 5 μήλα και μετά η Άννα έδωσε 2 μήλα στον γείτονα"]
    changed = [items[0].replace("Анна", "Ольга").replace("5", "7"), items[1].replace("Karl", "Otto").replace("60", "80"),
               items[2].replace("Άννα", "Ελένη").replace("5", "9")]
    mixed = items[0].replace("Анна", "Ольга", 1).replace("Анна", "Мария").replace("5", "7")
    rows = [(i, f"x y {t} z") for i, t in enumerate(changed)] + [(10 + i, t) for i, t in enumerate(items)] + [(20, mixed)]
    want = {(i, i): "reparameterised" for i in range(3)} | {(10 + i, i): "exact" for i in range(3)}
    assert {k: v[0] for k, v in found(spark, rows, items).items()} == want


def test_many_sentence_openers_give_two_windows_a_place_at_most():
    text = " ".join("Word" + "abcdefghij"[i % 10] + "." for i in range(2000)).encode()
    h = decontaminate.windows(text, [8], decontaminate.LEAST_KEY, decontaminate.LEAST_ITEM, True)[0]
    assert len(h) <= 3 * 2000  # as they are, none a name, all names


def test_windows_and_shares_match_brute_force(spark):
    """Lower-case texts without numbers: a pair is reported when half of the item's windows stand in the document."""
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("abcdefg") for _ in range(3)) for _ in range(60)]
    items = [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([5, 8, 12, 20, 33]))) for _ in range(30)]
    items += [items[0] + " " + items[1], items[2], ""]
    rows = []
    for d in range(120):
        w = items[rnd.randrange(30)].split()
        lo = rnd.randrange(len(w))
        part = w[lo:] if rnd.random() < 0.5 else w[:lo + 1]
        fill = [rnd.choice(vocab) for _ in range(rnd.randrange(40))]
        rows.append((d, " ".join(fill + part + [rnd.choice(vocab)] + items[rnd.randrange(30)].split()[:rnd.randrange(20)])))
    rows += [(3, items[4]), (200, ""), (201, items[5] * 1)]
    texts = collections.defaultdict(set)
    for d, t in rows:
        w = t.split()
        for n in range(1, 9):
            texts[d].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    want = {}
    for i, item in enumerate(items):
        w = item.split()
        n = min(8, len(w))
        windows = [tuple(w[k:k + n]) for k in range(len(w) - n + 1)] if n else []
        for d in texts:
            hit = sum(x in texts[d] for x in windows)
            if windows and hit / len(windows) >= 0.5:
                want[d, i] = ("exact", hit, len(windows))
    for local in (2_000_000, 1):
        assert found(spark, rows, items, max_local=local) == want


# --- op6 -------------------------------------------------------------------------

def test_frequent_lines_are_cut_from_the_texts_of_their_host(spark):
    rnd = random.Random(9)
    pool = [f"Line {c}{c}{c} of the common pool, offer 37 and {i}" for i, c in enumerate("abcdefgh")]
    rows = []
    for d in range(150):
        own = [prose(rnd, rnd.randint(1, 12)) for _ in range(rnd.randint(0, 4))]
        lines = own + [rnd.choice(pool).replace("37", str(rnd.randrange(99))) for _ in range(rnd.randint(0, 5))] + [" ", ""]
        rnd.shuffle(lines)
        rows.append((d, "\n".join(lines), rnd.choice(["a", "b", "b", "b", None]), d))
    rows += [(3, rows[3][1], rows[3][2], 3), (4, rows[5][1], rows[4][2], 9), (None, rows[6][1], "a", 1), (None, None, "a", 1), (900, "", "b", 2)]
    least, share, keep = 3, 0.08, 0.5

    def norm(line):
        import re
        return re.sub("[0-9]+", "0", " ".join(line.split()).lower())

    holders, hosts = collections.defaultdict(set), collections.defaultdict(set)
    for n, (d, t, host, _) in enumerate(rows):
        who = ("id", d) if d is not None else ("row", n)
        hosts[host].add(who)
        for line in (t or "").split("\n"):
            if line.split():
                holders[host, norm(line)].add(who)
    bad = {k for k, who in holders.items() if len(who) > max(least, share * len(hosts[k[0]]))}
    want = collections.Counter()
    for d, t, host, extra in rows:
        lines = t.split("\n") if t is not None else []
        gone = [i for i, x in enumerate(lines) if x.split() and (host, norm(x)) in bad]
        left = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        n, cut = len((t or "").split()), sum(len(lines[i].split()) for i in gone)
        want[d, left, tuple(gone), cut, extra, n - cut < keep * n] += 1
    docs = spark.createDataFrame([(d, t, h, e) for d, t, h, e in rows], "doc_id long, text string, source string, gone long").repartition(5)
    out = line_rules.quality_rules(docs, least, share, keep, carry=True)
    assert out.schema["row"].dataType.names == docs.columns
    got, n_rejected = collections.Counter(), 0
    for r in out.collect():
        depleted = r.n_words - r.removed_words < keep * r.n_words
        got[r.doc_id, r.kept_text, tuple(r.removed_lines), r.removed_words, r.row.gone, depleted] += 1
        assert r.kept == (not r.base_failed and not depleted)
        n_rejected += not r.base_failed and depleted
    assert got == want and len(bad) > 5 and n_rejected > 0
    plain = line_rules.quality_rules(docs, least, share, keep)
    assert collections.Counter((r.doc_id, r.removed_words, r.kept) for r in plain.collect()) == collections.Counter(
        (r.doc_id, r.removed_words, r.kept) for r in out.collect())
    assert line_rules.quality_rules(docs.limit(0), carry=True).count() == 0


# --- pipeline ---------------------------------------------------------------------

def test_texts_under_one_id_are_documents_of_their_own(spark):
    import corpus_pipeline as P

    text = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(1, "alpha beta gamma", "a"), (1, "wholly other text here", "b"), (2, "third text", "c")], schema)
    assert sorted(r.text for r in P.near_duplicates(spark, docs, "").collect()) == ["alpha beta gamma", "third text", "wholly other text here"]
    rows = [(9, text, "a"), (7, "alpha", "b"), (7, text + " x", "c"), (8, text, "d"), (8, text, "d"), (None, text, "e"), (None, text, "e"),
            (5, None, "f"), (5, None, "f"), (6, "", "g"), (5, "beta", "h")]
    kept = P.near_duplicates(spark, spark.createDataFrame(rows, schema).repartition(3), "")
    assert kept.columns == ["doc_id", "text", "lang"]
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter(
        [(7, "alpha"), (8, text), (None, text), (None, text), (5, None), (6, ""), (5, "beta")])
    # without texts that share an id: the smallest id of the group, equal rows once
    plain = P.near_duplicates(spark, spark.createDataFrame([r for r in rows if r[0] != 7 and r[2] != "h"], schema), "")
    assert collections.Counter((r.doc_id, r.text) for r in plain.collect()) == collections.Counter(
        [(8, text), (None, text), (None, text), (5, None), (6, "")])


def test_stages_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, "an item of some words that nobody has")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0, name
        assert name == "mixing" or out.columns == empty.columns
    assert P.run(spark, str(tmp_path)).count() == 0


# --- Arrow batches -----------------------------------------------------------------

def test_arrow_batches_of_texts_are_bounded_in_bytes(spark):
    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes]})

    common.prepare(spark)
    docs = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
    for rows in (docs, docs.select(F.struct("*").alias("row"))):
        sizes = [r.bytes for r in rows.mapInArrow(size, "bytes long").collect()]
        assert sum(sizes) >= 8_000_000 and max(sizes) < 2_000_000
    spark.conf.set(common.ARROW_BYTES, "3m")  # a bound of the session's own stays
    try:
        common.prepare(spark)
        assert spark.conf.get(common.ARROW_BYTES) == "3m"
    finally:
        spark.conf.unset(common.ARROW_BYTES)


def test_parquet_reader_decodes_few_texts_at_a_time(spark, tmp_path):
    common.prepare(spark)
    path = str(tmp_path / "documents.parquet")
    spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text")).write.parquet(path)
    read = spark.read.parquet(path).select(F.length("text").alias("n"))
    assert sum(r.n for r in read.collect()) == 8_000_000
    node = read._jdf.queryExecution().executedPlan()
    while not node.metrics().contains("numInputBatches"):
        node = node.children().apply(0)
    assert node.metrics().apply("numInputBatches").value() >= 4000 // 512
    spark.conf.set(common.READER_ROWS, "3000")  # a bound of the session's own stays
    try:
        common.prepare(spark)
        assert spark.conf.get(common.READER_ROWS) == "3000"
    finally:
        spark.conf.unset(common.READER_ROWS)
