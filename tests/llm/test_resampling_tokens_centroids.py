"""Importance resampling, token counts and centroid clustering against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import centroids, queries, resampling, token_counts
from tessera.session import scratch_path
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, id string, n_tokens int, score string, digest string"


def corpus():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "naïve", "x_y", "3.5", "ДОМ", "a b", " ", "[[", "it's"]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 90))) for _ in range(60)]
    texts += [texts[3]] * 20 + [texts[3].replace(" ", "\n\t "), " " + texts[3] + "\n"]
    texts += ["", " \n", None, "!!", "one", " ".join(rnd.choice(vocab) for _ in range(20_000)),
              "<|endoftext|> a <|ENDOFTEXT|><|startoftext|>b", "é H̱ ẖ İ ı ﬁ", "x" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4]), (None, texts[5]), (None, None)]
    return [(d, t, "i", 1, "s", "d") for d, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(4)


# --- importance resampling -------------------------------------------------

TARGET = ["w1 w2 w3 w4 w1 w1", "w1 Été w5 w6", None, ""]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text, ngrams):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]


def resampled(rows, target, ngrams, buckets, least, percent, seed):
    s, t = collections.Counter(), collections.Counter()
    for _, x in rows:
        s.update(c % buckets for c in features_of(x, ngrams))
    for x in target:
        t.update(c % buckets for c in features_of(x, ngrams))
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for d, x in rows:
        f = [c % buckets for c in features_of(x, ngrams)]
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(words_of(x)), len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = i + 1
    return sorted((tuple(r) for r in out), key=str)


@pytest.mark.parametrize("ngrams,buckets,percent", [(1, 10_000, 10), (3, 50, 60), (2, 1, 100), (1, 7, 0)])
def test_resample_matches_brute_force(spark, docs, ngrams, buckets, percent):
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, rank int")
    out = resampling.resample(docs, target, ngrams, buckets, 5, percent, 9)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == resampled([r[:2] for r in corpus()], TARGET, ngrams, buckets, 5, percent, 9)


def test_resample_of_empty_tables(spark, docs):
    empty, nothing = docs.limit(0), spark.createDataFrame([], "text string")
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    assert resampling.resample(empty, target).collect() == []
    got = sorted(map(tuple, resampling.resample(docs, nothing, 1, 100, 5, 20, 1).collect()), key=str)
    assert got == resampled([r[:2] for r in corpus()], [], 1, 100, 5, 20, 1)


@given(st.lists(st.sampled_from(["a", "bc", "d9", "é", "A"]), max_size=12), st.lists(st.sampled_from([" ", "\n", "--", "_", "\0"]),
                                                                                  min_size=13, max_size=13), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_overlapped_spans_are_all_runs(tokens, gaps, ngrams):
    text = "".join(g + w for g, w in zip(gaps, tokens)) + gaps[-1]
    got = resampling.feature_buckets(resampling.collapsed(text.encode()), resampling.span_patterns(ngrams), 1 << 32)
    assert got.tolist() == features_of(text, ngrams)


def test_registered_resampling_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    want = [(r[0], *r[2:]) for r in resampled(rows, target, 1, 10_000, 20, 10, 2024)]
    out = queries.QUERIES["op11_importance_resampling"](spark, SF_SMALL)
    assert [t for _, t in out.dtypes] == ["bigint"] * 5
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[4] is not None for r in got) > 0


# --- token counts ----------------------------------------------------------

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def library_counts(name, texts):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        return [len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t)) for t in texts]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def counted(rows, name):
    return collections.Counter((d, len((t or "").encode()), n) for (d, t, *_), n in zip(rows, library_counts(name, [r[1] or "" for r in rows])))


@pytest.mark.parametrize("name", FILES)
def test_token_counts_match_library(spark, docs, name):
    vocabulary = token_counts.Vocabulary.load(public_tokenizers.path(name))
    assert vocabulary.drops_space == name.startswith("word")
    out = token_counts.token_counts(docs, vocabulary, scratch_path(spark, "t"))
    assert collections.Counter(map(tuple, out.collect())) == counted(corpus(), name)


def test_cache_is_read_and_only_misses_are_appended(spark, docs):
    vocabulary, cache = token_counts.Vocabulary.load(public_tokenizers.path(FILES[0])), scratch_path(spark, "t")
    folder = f"{cache}/tokenizer={vocabulary.version}"
    some = docs.where("doc_id < 40")
    token_counts.token_counts(some, vocabulary, cache)
    first = {bytes(r.digest): r.n_tokens for r in spark.read.parquet(folder).collect()}
    # a count that the library would not give shows that it came from the cache
    content = " ".join((corpus()[3][1]).split())
    planted = hashlib.sha256(corpus()[70][1].encode()).digest()
    assert planted == hashlib.sha256(corpus()[3][1].encode()).digest() and len(content) > 0
    extra = spark.createDataFrame([(bytearray(hashlib.sha256(b"one").digest()), 77)], token_counts.COUNTS)
    extra.write.mode("append").parquet(folder)
    out = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_counts.token_counts(docs, vocabulary, cache).collect()}
    one = next(d for d, t, *_ in corpus() if t == "one")
    assert out[(one, 3)] == 77
    rows = spark.read.parquet(folder).collect()
    assert len({bytes(r.digest) for r in rows}) == len(rows)  # nothing is appended twice
    assert all(n == 1 for n in collections.Counter(bytes(r.digest) for r in rows).values()) and len(rows) > len(first)
    # all is known now: another run appends nothing
    token_counts.token_counts(docs, vocabulary, cache)
    assert spark.read.parquet(folder).count() == len(rows)
    # another version has a cache of its own
    other = token_counts.Vocabulary.load(public_tokenizers.path(FILES[1]))
    again = token_counts.token_counts(docs, other, cache)
    assert collections.Counter(map(tuple, again.collect())) == counted(corpus(), FILES[1])


def test_token_counts_of_an_empty_table(spark, docs):
    vocabulary = token_counts.Vocabulary.load(public_tokenizers.path(FILES[0]))
    cache = scratch_path(spark, "t")
    assert token_counts.token_counts(docs.limit(0), vocabulary, cache).collect() == []
    assert token_counts.token_counts(docs, vocabulary, cache).count() == len(corpus())


SNIPPETS = st.sampled_from(["a", "Ab9", ".", ",", "?", "...", ".'s", "don't", "'s", "'S", "É", "é", "́", " ", "\n", "\t\r", " ", " ", "\x1c", "\x85", "12", "!?",
                            "<|endoftext|>", "<|endof", "text|>", "<|ENDOFTEXT|>", "İ", "Ω", "漢字", "🙂", "‍", "\0", "H̱"])


@given(st.lists(SNIPPETS, max_size=14))
@settings(max_examples=400, deadline=None)
def test_words_counted_apart_add_up(parts):
    text = "".join(parts)
    encode = token_counts.Vocabulary.load(public_tokenizers.path(FILES[0])).encoder() if not _ENCODER else _ENCODER[0]
    _ENCODER[:] = [encode]
    whole = " ".join(w.decode() for w in text.encode().split())
    cut = token_counts.pieces(whole)
    assert sum(encode(cut)) == sum(encode([token_counts.same_count(x) for x in cut])) == encode([text])[0] == encode([whole])[0]


_ENCODER: list = []


def test_registered_token_counts_match_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.QUERIES["op12_token_counts"](spark, SF_SMALL)
    got = collections.Counter(tuple(r)[:3] for r in out.collect())
    assert got == counted(rows, FILES[0])
    assert all(r.over_limit == (r.n_tokens > 2048) for r in out.collect())


# --- centroid clustering ----------------------------------------------------

def clustered(rows, k, rounds, dim, seed, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is None, r[0] or 0, r[1])
    c = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(kept, of) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    end = [nearest(v) for _, v in kept]
    inertia = collections.Counter()
    for d, j in end:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(kept, end)), key=str)


def vectors(n, dim, spread, seed=4):
    rnd = random.Random(seed)
    middles = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(12)]
    rows = [(i, [x + rnd.gauss(0, spread) for x in middles[i % 12]]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(n // 3)]  # a hot vector
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (n * 9, None), (n * 9 + 1, []), (n * 9 + 2, [1.0] * (dim - 1)),
             (n * 9 + 3, [float("nan")] + [0.0] * (dim - 1)), (n * 9 + 4, [float("-inf")] + [0.0] * (dim - 1)),
             (n * 9 + 5, [None] + [0.0] * (dim - 1)), (n * 9 + 6, [0.5] * (dim + 1)), (n * 9 + 7, [0.0] * dim)]
    return rows


@pytest.mark.parametrize("n,dim,spread,k,rounds", [(300, 4, 0.05, 25, 5), (300, 6, 0.6, 40, 8), (200, 3, 0.2, 1, 3), (40, 3, 0.01, 60, 4),
                                                   (150, 2, 3000.0, 12, 6), (30, 2, 0.1, 5, 0)])
def test_clusters_match_brute_force(spark, n, dim, spread, k, rounds):
    rows = vectors(n, dim, spread)
    frame = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(5)
    got = centroids.cluster(frame, k, rounds, dim, 2)
    assert sorted(map(tuple, got.collect()), key=str) == clustered(rows, k, rounds, dim, 2)


def test_clusters_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.cluster(spark.createDataFrame([], schema)).collect() == []
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema)).collect() == []


def test_huge_components_do_not_crash(spark):
    frame = spark.createDataFrame([(i, [(-1) ** i * 1e300, float(i)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert centroids.cluster(frame, 3, 2, 2, 1).count() == 9


def test_bounds_spare_distances_and_hold():
    """Every stored bound holds against a full search, and far fewer distances are evaluated."""
    rnd = np.random.default_rng(3)
    middles = rnd.integers(-4000, 4000, (20, 8))
    x = (middles[rnd.integers(0, 20, 3000)] + rnd.integers(-150, 150, (3000, 8))).astype(np.int64)
    history = x[rnd.choice(3000, 20, replace=False)][None]
    state, evaluated = centroids.first_state(x, history[0]), 0
    for _ in range(8):
        c = history[-1].copy()
        for j in np.unique(state[0]):
            c[j] = x[state[0] == j].sum(0) // (state[0] == j).sum()
        history = np.concatenate((history, c[None]))
        state, n = centroids.next_state(x, state, history)
        evaluated += n
        d = centroids.squared(x, c)
        assert (state[0] == d.argmin(1)).all()
        cluster, upper, upper_round, lower, lower_round = state
        then = history[upper_round, cluster]
        assert np.allclose(upper, np.sqrt(((x - then) ** 2).sum(1)))
        for g, members in enumerate(centroids.groups_of(20)):
            far = np.sqrt(((x[:, None] - history[lower_round[:, g]][:, members]) ** 2).sum(2))
            far[members[None] == cluster[:, None]] = np.inf
            assert (lower[:, g] <= far.min(1) + 1e-6).all()
    assert evaluated < 0.5 * 8 * 3000 * 20


def test_one_displacement_is_never_more_than_the_drifts_summed():
    history = np.array([[[0, 0]], [[30, 40]], [[0, 0]], [[3, 4]]])
    x = np.array([[1, 1]])
    state = centroids.first_state(x, history[0])
    kept, _ = centroids.next_state(x, state, history)
    assert kept[0].tolist() == [0] and kept[1][0] <= np.sqrt(2) + 5 + 1e-9  # not 50 + 50 + 5


def test_registered_clustering_matches_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    out = queries.QUERIES["op13_centroid_clustering"](spark, SF_SMALL)
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    assert sorted(map(tuple, out.collect()), key=str) == clustered(rows, 40, 5, 64, 2)
