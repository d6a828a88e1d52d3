import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridseries.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    ENCODER = token_files.WordEncoder(f.read(), 2, 2)


def plain(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="aZé'.,!?stdm \n\t1<|endoftext|>İΣ́ﬁ$%&*#(_\\", max_size=40)))
def test_words_give_the_ids_of_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(ENCODER.encode([text])[0], "<u2").tolist() == plain(text)


@pytest.mark.parametrize("stop", [".", "!?"])
def test_every_letter_before_and_after_stops(stop):
    letters = [chr(c) for c in [*range(0x3400), *range(0x3400, 0xA000, 23), *range(0xA000, 0x20000), *range(0x20000, 0x30000, 97)] if unicodedata.category(chr(c))[0] != "C"]  # of ideographs some
    texts = [f"{x}{stop} a{x}{stop}{x} {stop}{x} {x.upper()}{stop}" for x in letters]
    want = TOKENIZER.encode_batch(texts, add_special_tokens=False)
    got = ENCODER.encode(texts)
    assert [t for t, w, g in zip(texts, want, got, strict=True) if np.frombuffer(g, "<u2").tolist() != [*w.ids, 2]] == []


def test_random_words_with_stops():
    rnd = random.Random(5)
    alphabet = "aZé1क़ড়שׁ\u0301\u0345İΣ.,!'-stm²½ "
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12))) for _ in range(100_000)]
    want = TOKENIZER.encode_batch(texts, add_special_tokens=False)
    assert all(np.frombuffer(g, "<u2").tolist() == [*w.ids, 2] for w, g in zip(want, ENCODER.encode(texts), strict=True))


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "MOST_WORDS", 6)
    encoder = token_files.WordEncoder(TOKENIZER.to_str(), 4, 2)
    texts = ["a b c d, e f. g h", "a b", "i j k l m n o p q r s", "a B c", "a b c d e f g h i j"]
    for text, got in zip(texts * 2, encoder.encode(texts * 2), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == plain(text)


def test_a_tokenizer_that_keeps_white_space_encodes_whole_texts(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    assert not token_files.WordEncoder(other.to_str(), 2, 2).by_word and ENCODER.by_word
    texts = ["Hello World, this is New York.", "a  b\n c", "", None, "it's 1,234.5"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write(docs, f"{tmp_path}/other", path, buckets=2)
    got = {r["doc_id"]: r["ids"] for r in token_files.read(spark, f"{tmp_path}/other").collect()}
    assert got == {i: other.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


def test_files_hold_the_ids_of_every_document_in_order(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = f"file://{tmp_path}/set"
    token_files.write(docs.repartition(3), path, PATH, buckets=5)
    got = token_files.read(spark, path).toPandas().sort_values("start")
    want = docs.toPandas().sort_values("doc_id")
    ids = [plain(t) for t in want.text]
    assert got.doc_id.tolist() == want.doc_id.tolist()
    assert [list(x) for x in got.ids] == ids
    assert got.start.tolist() == np.concatenate([[0], np.cumsum([len(i) for i in ids])[:-1]]).tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    assert len(spark.read.parquet(f"{path}/dictionary").first()["dictionary"]) > 1000
    some = int(want.doc_id.iloc[17])
    assert token_files.read_document(spark, path, some) == [ids[17]]


def test_nulls_repeats_empty_tables_and_extra_columns(spark, tmp_path):
    rows = [(5, None), (None, "x y"), (5, "b"), (5, "b"), (1, ""), (9, "word " * 60_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, start long, key int")
    token_files.write(docs, f"{tmp_path}/a", PATH, buckets=3)
    got = token_files.read(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 5, 5, 5, 9] and [r["n_tokens"] for r in got][-1] == 60_001
    assert sorted(r["ids"] for r in got if r["doc_id"] == 5) == sorted([plain(""), plain("b"), plain("b")])
    token_files.write(docs.limit(0), f"{tmp_path}/b", PATH, buckets=3)
    assert token_files.read(spark, f"{tmp_path}/b").count() == 0


def test_another_dictionary_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    token_files.write(docs, f"{tmp_path}/a", PATH, buckets=1)
    spark.createDataFrame([("other", bytearray(b""))], "dict_hash string, dictionary binary").write.mode("overwrite").parquet(f"{tmp_path}/a/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read(spark, f"{tmp_path}/a").collect()
