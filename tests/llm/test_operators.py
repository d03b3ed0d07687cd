"""The training-data operators against brute force, with nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import chat, common, decontaminate, induced, jaccard, language, line_quality, line_rules, mixing
from tessera.llm import phrases, recurring, substrings, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, row string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)] + ["É", "a\u00a0b", "Ünit"]
    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    shared, long_text = prose(70), prose(6000)
    texts = [prose(rnd.randint(1, 160)) for _ in range(25)]
    texts += [prose(30) + "\n" + shared + "\t" + prose(20) for _ in range(6)] + [shared, shared + " x", long_text, long_text]
    for _ in range(12):  # near copies
        words = texts[3].split() + texts[5].split()
        words[rnd.randrange(len(words))] = "edit"
        texts.append(" ".join(words))
    texts += ["De " * 300, "De " * 200 + prose(60), "ab" * 400, "", " \n\t ", None, None, "one", "one two", "ONE two"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[3], (7, texts[9]), (None, shared), (None, None)]  # repeated row, repeated id, null ids
    return [(d, t, "xx", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 1, "r") for i, (d, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(4)


def unique_ids():
    """Rows whose doc_id occurs once or whose rows are all alike."""
    texts = collections.defaultdict(set)
    for d, t, *_ in corpus():
        texts[d].add(t)
    return {d for d, ts in texts.items() if d is not None and len(ts) == 1}


def words(text):
    return WORD.findall((text or "").encode())


def test_repeated_phrases_match_brute_force(docs):
    first = {}
    for d, t, *_ in sorted((r for r in corpus() if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i:i + 50]), d)
    want = collections.Counter()
    for d, t, *_ in corpus():
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = [True] * 50
        want[(d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g))] += 1
    for group in (60_000, 3):  # with and without taking hot keys apart
        got = phrases.remove_repeated_phrases(docs, carry=False, shard_runs=20, max_group=group).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.words)) for r in got) == want


def test_repeated_phrases_carry_columns_and_layout(docs):
    got = phrases.remove_repeated_phrases(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        assert r.row.row == "r" and r.row.key == 1
        if r.n_removed == 0:
            assert r.kept_text == r.row.text
        else:
            assert len(words(r.kept_text)) == r.n_words - r.n_removed


def test_wide_word_codes_do_not_match_inside_words():
    segments = [[b"a", b"b"], [b"b", b"c"]]
    coder = phrases.Coder(segments)
    coder.width = 2
    assert len(coder.text(coder.ids[0])) == 4 and coder.text(np.array([1])) in coder.text(coder.ids[0])


def test_duplicate_substrings_match_brute_force(docs):
    rows = sorted({(d, common.tag_of((t or "").encode()) if t is not None else 0, (t or "").encode())
                   for d, t, *_ in corpus() if d is not None})
    seen, want = set(), {}
    for d, _, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = b"\x01" * 100
            seen.add(data[i:i + 100])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        want[d, data] = (len(data), sum(gone), spans, kept)
    for group in (60_000, 3):
        got = substrings.remove_duplicate_substrings(docs, shard_runs=30, max_group=group, carry=True).collect()
        assert len(got) == len(corpus())
        for r in got:
            data = (r.row.text or "").encode()
            expected = want[r.doc_id, data] if r.doc_id is not None else (len(data), 0, 0, data)
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected


@pytest.mark.parametrize("few_names", [3, 10**9])
def test_induced_order_and_prefixes(monkeypatch, few_names):
    monkeypatch.setattr(induced, "SHORT", 4)
    monkeypatch.setattr(induced, "FEW_NAMES", few_names)
    rnd = random.Random(few_names)
    for _ in range(150):
        size = rnd.choice([1, 2, 4, 50])
        parts = [[rnd.randint(1, size) for _ in range(rnd.randint(1, 25))] for _ in range(rnd.randint(1, 8))]
        parts += parts[:2]
        t = np.array([x for p in parts for x in [*p, 0]], rnd.choice([np.uint8, np.uint16]))
        pos, lcp = induced.suffix_order(t, memory=rnd.choice([64, 1 << 20]))
        ends = np.flatnonzero(t == 0)
        suffixes = [tuple(t[i:ends[np.searchsorted(ends, i)]].tolist()) for i in pos]
        assert suffixes == sorted(tuple(p[i:]) for p in parts for i in range(len(p)))
        for a, b, n in zip(suffixes, suffixes[1:], lcp[1:]):
            assert a[:n] == b[:n] and a[n:n + 1] != b[n:n + 1] or n == min(len(a), len(b))


@pytest.mark.parametrize("few_names", [3, 10**9])
def test_wanted_suffixes_have_the_same_order_and_prefixes(monkeypatch, few_names):
    monkeypatch.setattr(induced, "SHORT", 4)
    monkeypatch.setattr(induced, "FEW_NAMES", few_names)
    rnd = random.Random(few_names + 1)
    for _ in range(150):
        size = rnd.choice([1, 2, 4, 50])
        parts = [[rnd.randint(1, size) for _ in range(rnd.randint(1, 25))] for _ in range(rnd.randint(1, 8))]
        parts += [*parts[:2], [1] * 9, [1] * 9 + [2]]
        t = np.array([x for p in parts for x in [*p, 0]], rnd.choice([np.uint8, np.uint16]))
        wanted = (t != 0) & (np.random.default_rng(len(t)).random(len(t)) < rnd.choice([0, 0.1, 0.6]))
        pos, lcp = induced.suffix_order(t, rnd.choice([64, 1 << 20]), wanted=wanted)
        ends = np.flatnonzero(t == 0)
        suffixes = [tuple(t[i:ends[np.searchsorted(ends, i)]].tolist()) for i in pos]
        assert suffixes == sorted(suffixes) and len(set(pos.tolist())) == len(pos)
        assert set(np.flatnonzero(wanted).tolist()) <= set(pos.tolist())
        for a, b, n in zip(suffixes, suffixes[1:], lcp[1:]):
            assert a[:n] == b[:n] and a[n:n + 1] != b[n:n + 1] or n == min(len(a), len(b))


def test_only_suffixes_that_start_windows_are_put_in_order(monkeypatch):
    """A stretch of 120 bytes has 21 windows of 100; the other suffixes need no prefixes."""
    counted, induce = [], induced.induce

    def counting(*args):
        out = induce(*args)
        counted.append((args[6] is not None, sum(x.shape[1] for x in out.values())))
        return out

    monkeypatch.setattr(induced, "induce", counting)
    rnd = random.Random(9)
    texts = [bytes(rnd.choice(b"abcdefgh ") for _ in range(120)) for _ in range(200)]
    n = len(texts)
    substrings.sources(pa.table({"key": [7] * n, "content": range(n), "first_doc": range(n), "first_tag": [0] * n,
                                 "first_start": [0] * n, "bytes": pa.array(texts, pa.binary())}), 100)
    assert n * 21 <= sum(x for carried, x in counted if carried) <= n * 30
    assert sum(x for carried, x in counted if not carried) < n * 100


def shingles(text, k):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("k,percent,block", [(4, 85, 1000), (5, 80, 2), (1, 50, 3)])
def test_jaccard_components_match_brute_force(docs, k, percent, block):
    rows = [(d, shingles(t, k)) for d, t, *_ in corpus() if d is not None]
    root = {d: d for d, _ in rows}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (d, a) in enumerate(rows):
        for e, b in rows[:i]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(d), find(e)
                root[max(x, y)] = min(x, y)
    got = jaccard.with_components(docs, jaccard.jaccard_components(docs, k, percent, block), k).collect()
    assert len(got) == len(corpus())
    assert all(r.component_id == (None if r.doc_id is None else find(r.doc_id)) for r in got)
    sizes = collections.Counter((d, len(shingles(t, k))) for d, t, *_ in corpus())
    assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == sizes


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert phrases.remove_repeated_phrases(empty).count() == 0
    assert substrings.remove_duplicate_substrings(empty).count() == 0
    assert jaccard.jaccard_components(empty).count() == 0
    assert line_rules.quality_rules(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert language.identify(empty, language.learn(empty)).count() == 0
    assert line_quality.score(empty, None).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0


def test_language(spark, docs):
    train = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog were in the house with them " * 3, "en"), ("der hund und die katze sind in dem haus " * 3, "de")] * 20)]
    d = language.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    tests = [(1, "The dog and the cat were with them", "x"), (2, "die katze und der hund sind in dem haus", None),
             (3, None, "x"), (4, "", "x"), (5, "123 !!", "x")]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(tests, "doc_id long, text string, score string"), d)
           .toDF("doc_id", "old", "lang_pred", "score", "accepted").collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert got[1].accepted and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}


def test_chain_marginals_match_enumeration():
    rnd = np.random.default_rng(1)
    emit, begin = rnd.normal(size=7), np.array([0, 3, 4])
    chain = line_quality.Chain(np.zeros(1), rnd.normal(size=(2, 2)))
    good, pair = chain.marginals(emit, begin)
    total = np.zeros((2, 2))
    for a, b in ((0, 3), (3, 4), (4, 7)):
        n, z, want = b - a, 0.0, np.zeros(b - a)
        pairs = np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(sum(emit[a + i] for i in range(n) if y[i]) + sum(chain.trans[p, q] for p, q in zip(y, y[1:])))
            z += w
            want += w * np.array(y)
            for p, q in zip(y, y[1:]):
                pairs[p, q] += w
        assert np.allclose(good[a:b], want / z)
        total += pairs / z
    assert np.allclose(pair, total)


def test_line_quality_learns_and_scores(spark, docs):
    good, bad = "The day was long and the road was dry.\nAll went home.", "BUY!! NOW!! $$$ ###\n%%% &&& ***"
    rows = [(i, good if i % 2 else bad) for i in range(80)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    chain = line_quality.learn(labelled, labels)
    got = [(r.row.doc_id, r.score) for r in line_quality.score(labelled, chain).collect()]
    assert all((s > 0.8) == bool(i % 2) for i, s in got)
    scored = line_quality.score(docs, chain).collect()
    assert len(scored) == len(corpus()) and all(0 <= r.score <= 1 for r in scored)
    assert all(r.score == 0 for r in scored if not words(r.row.text))
    assert line_quality.learn(labelled, labels.where("quality = 1")) is None


def test_url_rules_match_direct_test(spark):
    hosts = ["a.com", "com", "example.com", "www.example.com", "x.www.example.com", "xexample.com", "b.net", "net", "é.net", "", "example.com."]
    paths = ["", "/", "/en/", "/en", "/en/x?q=/fr/", "/es/1", "/fr/#a", "/en/\U0010ffffz"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "HTTP://WWW.Example.COM/en/", "x://y://z/en/"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls + urls[:5])], "page_id long, url string, key string")
    rules = [*url_rules.RULES, ("example.com", "/", "block"), ("b.net", "/f", "allow"), ("b.net", "/fr/", "block")]
    got = {r.page_id: r for r in url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(urls) + 5
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = (max(fits)[1:]) if fits else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)


def test_line_rules(spark, docs):
    for r in line_rules.quality_rules(docs).collect():
        assert (r.n_words >= 10) or r.base_failed and not r.kept
    for text in [t for _, t, *_ in corpus() if t] + ["a b c d e a b c d e\na b\n\na b\n#*", "é é é é é é é"]:
        w = words(text)
        seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        again = [False] * len(w)
        for i in range(len(w) - 4):
            if seen[tuple(w[i:i + 5])] > 1:
                again[i:i + 5] = [True] * 5
        lines = [x for x in text.split("\n") if words(x)]
        assert line_rules.base_counts(text.encode()) == (
            len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(again))
    rows = [(i, f"Sign up now for news and offers {i}\nmore of the same words here\n" +
             (" ".join(f"{chr(97 + i)}{chr(97 + j)}" for j in range(20)) if i else "")) for i in range(6)]
    rows += [rows[0]] * 3
    frame = spark.createDataFrame([(d, "h", t) for d, t in rows], "doc_id long, source string, text string")
    got = line_rules.quality_rules(frame, least=4).collect()
    assert all(r.removed_words == 14 for r in got)
    assert all(r.kept == (r.doc_id != 0) for r in got if r.doc_id) and not any(r.kept for r in got if r.doc_id == 0)


def test_template_decontamination(spark):
    item = "a train with Anna aboard goes 60 km in 2 hours and then Anna walks 60 m before she is home"
    plain = "what is the colour of the sky at noon"
    changed = item.replace("Anna", "Bert").replace("60", "75")
    broken = item.replace("Anna", "Bert", 1).replace("Anna", "Carl").replace("60", "75", 1).replace("60", "80")
    rows = [(1, f"Intro words here.\n{item} and more words after."), (2, f"x y z {changed} q"), (3, broken), (4, "nothing of it here at all today"),
            (5, None), (6, ""), (None, item), (7, plain.upper()), (8, item), (8, "other text")]
    docs = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(0, item), (1, plain), (2, None), (3, "too short"), (None, plain), (4, item)],
                                  "item_id long, text string")
    for local in (2_000_000, 1):  # with the local window filter and without
        got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(docs, bench, max_local=local).collect()}
        assert got == {(d, i): k for i in (0, 4) for d, k in ((1, "exact"), (2, "reparameterised"), (8, "exact"))}


def contaminated_pairs(spark, rows, items, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(docs, bench, **more).collect()}


def test_items_full_of_slots_are_found(spark):
    items = ["What is 7 plus 5?", "Solve 3x + 5 = 20", "12 kg 7 m 9 s 4 l 3 ft 8 oz", "Paris in 1900",
             "from 3 to 4 at 5 by 6 on 7 of 8 and 9 or 10"]
    rows = [(i, f"some words. {t} more words") for i, t in enumerate(items)]
    rows += [(10, "so. What is 8 plus 3?"), (11, "1 kg 2 m 3 s 6 l 5 ft 9 oz"), (12, "Paris in 1950"),
             (13, "from 13 to 14 at 15 by 16 on 17 of 18 and 19 or 20"), (14, "Solve it with 5 = 20")]
    want = {(i, i): "exact" for i in range(len(items))} | {(10, 0): "reparameterised", (13, 4): "reparameterised"}
    for local in (2_000_000, 1):
        assert contaminated_pairs(spark, rows, items, max_local=local) == want


def test_each_occurrence_of_an_item_is_judged_by_itself(spark):
    item = "a train with Anna aboard goes 60 km in 2 hours and then Anna walks 60 m before she is home"
    bert, carl = (item.replace("Anna", n).replace("60", v) for n, v in (("Bert", "75"), ("Carl", "80")))
    gap = [t.replace("and then", "and some time then") for t in (bert, carl)]
    mixed = item.replace("Anna", "Bert", 1).replace("Anna", "Carl").replace("60", "75", 1).replace("60", "80")
    rows = [(1, f"{bert}\n{carl}"), (2, f"{bert} x y z {' '.join(carl.split()[:9])} end"), (3, f"{gap[0]}\n{gap[1]}"),
            (4, mixed), (5, f"{carl}\n{item}"), (6, f"{mixed}\n{mixed}"), (7, bert), (8, bert), (8, carl)]
    want = {(d, 0): "exact" if d == 5 else "reparameterised" for d in (1, 2, 3, 5, 7, 8)}
    assert contaminated_pairs(spark, rows, [item]) == want


def test_names_and_case_do_not_depend_on_what_comes_before(spark):
    items = ["Tom has 5 apples. Anna takes 2 of them.", "What is the colour of the sky at noon", "Where do blue whales sleep"]
    rows = [(1, "Bob has 7 apples. Eve takes 3 of them."), (2, f"so she asked, {items[2]}"), (3, f"he said {items[0]}"),
            (4, "as Bob has 7 apples. Then takes 3 of them"), (5, items[1].upper()), (6, f"x y {items[0].upper()} z"),
            (7, "Bob has 7 apples. Bob takes 3 of them.")]
    want = {(1, 0): "reparameterised", (2, 2): "exact", (3, 0): "exact", (4, 0): "reparameterised", (7, 0): "reparameterised"}
    assert contaminated_pairs(spark, rows, items) == want
    assert contaminated_pairs(spark, rows, items, fold_case=True) == want | {(5, 1): "exact", (6, 0): "exact"}


def test_query_and_pipeline_find_items_in_any_case(spark, tmp_path):
    import corpus_pipeline as P

    item = "what is the colour of the sky at noon"
    docs = spark.createDataFrame([(1, item.upper()), (2, "nothing of it")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.doc_id for r in decontaminate.op7_template_decontamination(spark, str(tmp_path)).collect()] == [1]
    assert [r.doc_id for r in P.benchmark_passages(spark, docs, str(tmp_path)).collect()] == [2]


def test_mixing_targets_and_budget(spark, docs):
    assert mixing.targets([("a", 100), ("b", 100), (None, 0)]) == [200.0, 100.0, 0.0]
    rnd = random.Random(2)
    for _ in range(60):
        counts = {rnd.randint(1, 40): rnd.randint(1, 5) for _ in range(rnd.randint(1, 6))}
        budget = rnd.randint(0, 200)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        taken = mixing.knapsack(counts, budget)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= budget)
        assert all(n <= counts[k] for k, n in taken.items())
    got = mixing.mix(docs, bucket=2).collect()
    assert len(got) == len(corpus())
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, len(words(t))) for d, t, *_ in corpus())
    by = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source] = [by[r.source][0] + r.taken, r.target, max(by[r.source][2], r.size)]
    assert all(0 <= wanted - taken < longest for taken, wanted, longest in by.values())
    again = mixing.mix(docs, bucket=2).collect()
    assert collections.Counter((r.doc_id, r.taken) for r in got) == collections.Counter((r.doc_id, r.taken) for r in again)


def test_chat_paths_and_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\s>", "", None, "a\nb\n", "[\\INST]<s"]
    rows = [("t", 1, None, "user", odd[0], 1.0), ("t", 2, 1, "assistant", odd[1], 5.0), ("t", 3, 1, "assistant", odd[2], 2.0),
            ("t", 4, 3, "us\ner\\b", odd[4], 9.0), ("t", 5, 2, None, odd[3], None), (None, 1, 99, "assistant", odd[5], 0.0),
            ("c", 1, 2, "user", "x", 1.0), ("c", 2, 1, "user", "y", 1.0)]
    rows += [("long", i, i - 1 if i else None, "assistant" if i % 2 else "user", f"m{i}", 1.0) for i in range(70)]
    frame = spark.createDataFrame([(*r, "k") for r in rows],
                                  "tree string, node long, parent long, role string, text string, score double, path string")
    out = chat.format_conversations(frame, branches=None).withColumn("back", chat.read_back(chat.F.col("formatted"))).collect()
    paths = {(r.tree if not r.null_tree else None, r.path): r for r in out}
    assert set(paths) == {("t", 1), ("t", 2), (None, 1), ("long", 1)}
    def said(*nodes):
        return [((r[3] or ""), (r[4] or "")) for n in nodes for r in rows if r[0] == "t" and r[1] == n]
    assert [tuple(x) for x in paths["t", 1].back] == said(1, 3, 4)  # score 12 before 6
    assert [tuple(x) for x in paths["t", 2].back] == said(1, 2, 5)
    assert [tuple(x) for x in paths[None, 1].back] == [("assistant", odd[5])]
    long = paths["long", 1]
    assert [x.text for x in long.back] == [f"m{i}" for i in range(70)]
    assert "".join(long.formatted[s.start:s.end] for s in long.loss) == "".join(f"m{i}" for i in range(70) if i % 2)
    assert len(chat.format_conversations(frame).collect()) == 3


def test_components(spark):
    links = spark.createDataFrame([(5, 3), (3, 9), (9, 1), (20, 21), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in common.connected_components(links).collect()}
    assert got == {1: 1, 3: 1, 5: 1, 9: 1, 20: 20, 21: 20}


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline as P

    bench = spark.createDataFrame([(0, "w1 w2")], "item_id long, text string")
    assert bench.count() == 1
    kept = P.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    cut = P.repeated_passages(spark, docs, "")
    assert cut.dtypes == docs.dtypes and cut.where("n_chars <> length(text)").isEmpty()
    assert [n for n, _ in P.STAGES][0] == "quality" and len(P.STAGES) == 5
    assert recurring.Unit("word", 50, 10).windows == 41


def test_held_out_documents_are_told_apart(spark):
    from tests.conftest import SF_SMALL

    sf_dir = SF_SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    said = language.op3_compression_language_id(spark, sf_dir).where("held_out").join(docs, "doc_id").where("lang is not null")
    right = [r.lang == r.lang_pred for r in said.collect()]
    assert sum(right) >= 0.95 * len(right) > 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = line_quality.op4_line_crf_quality(spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad) > 0
    assert min(good) >= line_quality.THRESHOLD


def test_doubled_order_matches_sorted_suffixes():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        parts = [rnd.integers(1, rnd.integers(2, 5), rnd.integers(0, 30)) for _ in range(rnd.integers(1, 6))]
        t = np.concatenate([np.append(x, 0) for x in [*parts, parts[0], np.tile([1, 2], 9)]])
        ends = np.flatnonzero(t == 0)
        want = sorted(np.flatnonzero(t).tolist(), key=lambda p: (t[p:ends[np.searchsorted(ends, p)]].tolist(), p))
        assert induced.doubled_order(t).tolist() == want


def test_repeating_runs_are_all_found():
    rnd = np.random.default_rng(4)
    w = 21
    for _ in range(200):
        text = np.concatenate([rnd.integers(1, 99, rnd.integers(40, 90)), np.tile(rnd.integers(1, 99, rnd.integers(1, w)), 9),
                               rnd.integers(1, 99, 30)])
        grams = common.Stretches(common.mix(text.astype(np.uint64))).grams(5)
        start, n, key = common.window_runs(grams, w)
        again = common.repeating_runs(grams, w, start, n, key)
        for s, m, a in zip(start.tolist(), n.tolist(), again.tolist()):
            windows = [tuple(grams[i:i + w].tolist()) for i in range(s, s + m)]
            assert a or len(set(windows)) == m


def test_columns_of_any_name_are_carried(spark):
    import corpus_pipeline as P

    extra = ["my col", "a.b", "tick`", "score", "size", "words", "component", "node", "doc", "tag", "spans", "kept_text",
             "n_words", "source_size", "copies", "h", "n", "b", "item_id", "window"]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(
        f"`{c.replace('`', '``')}` string" for c in extra)
    text = " ".join("x" + "".join(chr(97 + int(d)) for d in str(i)) for i in range(80))
    texts = [text, text + " x", None, "", "other " * 3]
    docs = spark.createDataFrame([(i, t, "s", len(t or ""), *extra) for i, t in enumerate(texts)], schema)
    cut = P.repeated_passages(spark, docs, "")
    assert cut.dtypes == docs.dtypes and all(list(r)[4:] == extra for r in cut.collect())
    assert {r.doc_id: r.text for r in cut.collect()} == {0: text, 1: "x", 2: None, 3: "", 4: texts[4]}
    kept = P.near_duplicates(spark, docs, "")
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == {0, 2, 3, 4}
    scored = line_quality.score(docs, None).select("row.*", "score")
    assert scored.count() == 5 and scored.columns[:-1] == docs.columns
    bytes_kept = substrings.remove_duplicate_substrings(docs, carry=True)
    assert bytes_kept.schema["row"].dataType.names == docs.columns and bytes_kept.count() == 5
    said = language.identify(docs, {"x": b"w1 w2 w3", "y": b"other other"})
    assert said.columns == [c for c in docs.columns if c != "text"] + ["lang_pred", "score", "accepted"]
    assert said.count() == 5 and mixing.mix(docs).count() == 5 and line_rules.quality_rules(docs).count() == 5
    bench = spark.createDataFrame([(0, text, "z")], "item_id long, text string, window string")
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()} == {0, 1}
