"""Registered queries against plain programs over the whole smallest tables."""

import collections
import hashlib

import pytest
import zstandard as zstd

from tessera.llm import language, queries
from tests.conftest import SF_SMALL


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_digests(spark):
    turns = collections.defaultdict(list)
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.QUERIES["op1_chat_formatting"](spark, SF_SMALL).collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        said = "".join(t for _, role, t in rows if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(said))
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for _, role, t in rows))
        assert r.loss_sha256 == sha(said) and r.formatted_chars > sum(len(t) for _, _, t in rows)


@pytest.mark.parametrize("block", [64, 4096])
def test_the_smallest_size_wins_and_ties_go_to_the_first_name(spark, block):
    words = {"aa": b"the cat and the dog and the house of the man " * 8, "bb": b"der hund und die katze und das haus des mannes " * 8}
    words["ab"] = words["bb"]  # the same dictionary: always a tie
    texts = ["The dog and the man", "die Katze und der Mann des Hauses", "zzz qqq", "a", "12 ?", "", None, "the house " * 500]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in language.identify(docs, words, block=block).collect()}
    coders = {}
    for name, content in words.items():
        d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=language.LEVEL)
        coders[name] = zstd.ZstdCompressor(level=language.LEVEL, dict_data=d, write_checksum=False, write_content_size=False)
    for i, t in enumerate(texts):
        if t is None or not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
            continue
        data = language.plain(t.encode())
        pieces = [data[k:k + block] for k in range(0, len(data), block)]
        sizes = {n: sum(len(c.compress(p)) for p in pieces) for n, c in coders.items()}
        best = min(sorted(sizes), key=lambda n: sizes[n])
        second = min(s for n, s in sizes.items() if n != best)
        assert got[i].lang_pred == best and got[i].score == pytest.approx(max(0.0, 1 - sizes[best] / second))
        assert best != "bb"
    assert got[1].lang_pred == "ab" and not got[1].accepted and got[0].lang_pred == "aa"
