import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from gridseries.llm import byte_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
PLAIN = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(RANKS, P.PATTERN, byte_bpe.stand_ins(P.PATTERN))


def ids(encoder, *texts):
    return [np.frombuffer(x, np.uint32).tolist() for x in encoder.encode(list(texts))]


def test_root_is_the_leftmost_least():
    tree = byte_bpe.RankTree([5, 3, None, 3, 9])
    assert tree.least() == 1
    tree.put(1, None)
    assert tree.least() == 3
    tree.put(3, 7)
    assert tree.least() == 0
    for k in range(5):
        tree.put(k, None)
    assert tree.least() is None


def test_every_kind_of_character_as_the_library_takes_it(encoder):
    points = [c for c in [*range(0x3100), *range(0x3100, 0x110000, 211)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{x}b {x} 1{x}2{x}{x}. {x}'ll {x}{x} " for x in map(chr, points)]
    assert ids(encoder, *texts) == [PLAIN.encode_ordinary(t) for t in texts]
    # letters and numbers that one Unicode version has and another has not
    late = map(chr, byte_bpe.stand_ins(P.PATTERN))
    texts = [f"a{x}b {x} 1{x}2{x}{x}. {x}'ll {x}{x} " for x in sorted(late)]
    assert ids(encoder, *texts) == [PLAIN.encode_ordinary(t) for t in texts]


def test_random_texts_and_round_trip(encoder):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abcdeotnéxаб1数!' \n") for _ in range(rnd.choice([0, 1, 2, 5, 9, 17, 33, 65, 300]))) for _ in range(3000)]
    texts += ["".join(rnd.choice("abcdeé") for _ in range(n)) for n in (64, 65, 66, 127, 128, 129, 1000)]
    found = ids(encoder, *texts)
    assert found == [PLAIN.encode_ordinary(t) for t in texts]
    assert [encoder.decode(x) for x in found] == [t.encode() for t in texts]


@pytest.mark.parametrize("text", ["a" * 40_000, "ab" * 20_000, "é" * 20_000, " " * 30_000, "=" * 30_000])
def test_very_long_pieces(encoder, text):
    assert ids(encoder, text) == [PLAIN.encode_ordinary(text)]


def test_forest_is_the_single_tree(encoder):
    rnd = random.Random(3)
    pieces = [bytes(rnd.choice(b"abcdenrst\xc3\xa9") for _ in range(rnd.randint(2, 16))) for _ in range(2000)]
    forest = byte_bpe.merge_all(pieces, encoder.ranks, 16)
    assert [np.frombuffer(x, np.uint32).tolist() for x in forest] == [byte_bpe.merge(p, RANKS, encoder.ranks.longest) for p in pieces]


def test_what_a_task_remembers_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_PIECES", 5)
    small = byte_bpe.Encoder(RANKS, P.PATTERN, {})
    texts = ["nothing remembered here", "nothing new", "x" * 300 + " tail", "remembered nothing x"]
    for text in texts:
        assert ids(small, text) == ids(encoder, text) == [PLAIN.encode_ordinary(text)]
        assert all(len(p) <= 64 for p in small.known)


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    rows = [(1, "one two", "a"), (1, "one two", "b"), (None, "three", None), (4, None, "c"), (5, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string").withColumn("__text", F.lit("x"))
    coded = byte_bpe.encode(docs, PATH, P.PATTERN)
    assert coded.columns == ["doc_id", "ids"]
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.ids, bytes(r.decoded)) for r in byte_bpe.decode(coded, PATH).collect())
    want = sorted((-1 if i is None else i, PLAIN.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert found == want
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), PATH, P.PATTERN), PATH).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert {r.decoded if r.decoded is None else bytes(r.decoded) for r in byte_bpe.decode(nulls, PATH).collect()} == {None, b""}
    with pytest.raises(ValueError):
        byte_bpe.encode(docs, PATH, P.PATTERN, keep=("ids",))
    with pytest.raises(ValueError):
        byte_bpe.decode(docs.withColumn("ids", F.array()), PATH)


def test_bad_vocabularies_are_refused(tmp_path):
    (tmp_path / "few").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.read_ranks(str(tmp_path / "few"))


def test_query_against_the_library(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = byte_bpe.op11_byte_bpe(spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        plain = PLAIN.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(plain), hashlib.sha256(",".join(map(str, plain)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
