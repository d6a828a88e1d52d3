import hashlib
import random
import re

import numpy as np
import pytest

from gridseries.llm import fill_middle as M


def plain_units(text, unit):
    ends = {"line": "\n", "sentence": "\n.!?", "word": "\n \t\v\f\r"}.get(unit)
    return list(text) if ends is None else re.findall(f"(?s)[^{ends}]*[{ends}]|[^{ends}]+", text)


def plain_row(doc_id, text, unit="line", rate=100, spm_rate=50, seed=7):
    text = text or ""
    units = plain_units(text, unit)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm_rate else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_rank_and_select():
    rnd = np.random.default_rng(1)
    for size in (0, 1, 2, 7, 64, 1000):
        symbols = rnd.integers(0, 8, size).astype(np.uint8)
        matrix = M.WaveletMatrix(symbols)
        places = np.arange(size + 1)
        for c in range(8):
            want = np.concatenate([[0], np.cumsum(symbols == c)])
            assert matrix.rank(c, places).tolist() == want.tolist()
            where = np.flatnonzero(symbols == c)
            if len(where):
                assert matrix.select(c, np.arange(1, len(where) + 1)).tolist() == where.tolist()


TEXTS = [None, "", "\n", "\n\n\n", "one", "one\n", "\none", "a\nb\nc", "a\r\nb\r\n", "é ü\nñ x\n𝔘𝔫\n数", "with <S> mark\nx", "<P", "a<\n<S\n<M\n>P>\n", "no end. two! three? ", " lead\x00\n"]
TEXTS += ["".join(random.Random(k).choice("ab é𝔘.\n! <SPM>") for _ in range(k)) for k in range(2, 60)]
TEXTS += ["line of words.\n" * 3000, "x" * 50_000]


@pytest.mark.parametrize("unit", ["line", "sentence", "word", "character"])
def test_against_plain_code(spark, unit, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 200)
    rows = [(None if k == 3 else k - 5, t) for k, t in enumerate(TEXTS)]
    rows += rows[:8]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS output", "1 AS h1", "2 AS n")
    made = M.transform(docs, unit, rate=80, spm_rate=40)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.withColumn("back", M.restore(made.output, made.form)).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=key) == sorted(((i, *plain_row(i, t, unit, 80, 40)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.back) for r in back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


def test_empty_table_and_unknown_unit(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert M.transform(docs).count() == 0
    with pytest.raises(ValueError, match="no unit"):
        M.transform(docs, "page")


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = M.op13_fill_middle(spark, sf).collect()
    assert len(found) == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in found:
        n, form, p, m, output = plain_row(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, sha(output), sha(docs[r.doc_id] or ""))
