import hashlib

import pytest
from pyspark.sql import functions as F

from keysweep.llm import fill_middle as q
from keysweep.llm.queries import op12_fill_middle
from llm_fixtures import SMALL, empty_docs, odd_docs, pairs, small_docs

MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    """The contract, code point by code point."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def made(docs, **kw):
    out = q.fill_middle(docs, **kw)
    back = q.restored(F.col("output"), F.col("form"), kw.get("marks", MARKS))
    return out.withColumn("back", back).collect()


@pytest.mark.parametrize("make", [small_docs, odd_docs])
def test_matches_the_contract_and_restores(spark, make):
    docs = make(spark)
    got = made(docs)
    assert sorted(((r["doc_id"], *list(r)[1:6]) for r in got), key=repr) == sorted(((i, *brute(i, t)) for i, t in pairs(docs)), key=repr)
    assert sorted((repr(r["doc_id"]), r["back"]) for r in got) == sorted((repr(i), t) for i, t in pairs(docs))
    assert {"psm", "spm", "plain"} <= {r["form"] for r in made(small_docs(spark))}


def test_marks_in_texts_and_at_cuts(spark):
    texts = ["a<P>b", "<M>", "<P", "S>", "<", "<<<<", "P>S>M>" * 40, "<P <S <M " * 30, "ab\n<s>\r\n\x00 " * 20]
    docs = spark.createDataFrame([(i, t) for i in range(60) for t in texts], "doc_id long, text string")
    for r in made(docs):
        assert r["back"] == (r["output"] if r["form"] == "plain" else r["back"])
    assert sorted((r["doc_id"], r["back"]) for r in made(docs)) == sorted((i, t) for i in range(60) for t in texts)
    assert all(r["form"] == "plain" for r in made(docs.where("text IN ('a<P>b', '<M>')")))


def test_other_units_and_marks(spark):
    docs = small_docs(spark)
    marks = ("[pre]", "[suf]", "[mid]")
    got = made(docs, unit=r"\S+\s*|\s+", changed=100, suffix_first=50, marks=marks, seed=7)
    texts = dict(pairs(docs))
    assert all(r["back"] == texts[r["doc_id"]] for r in got)
    for r in got:
        if r["form"] != "plain":
            text, a, b = texts[r["doc_id"]], r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]
            assert all(k in (0, len(text)) or (not text[k].isspace() and text[k - 1].isspace()) for k in (a, b))
    assert {r["form"] for r in got} >= {"psm", "spm"}
    uncovered = made(docs, unit="[a-z]")
    assert {(r["form"], r["n"]) for r in uncovered} == {("plain", 0)}


def test_wrong_parameters_are_refused(spark):
    with pytest.raises(ValueError):
        q.Units("x*")
    for marks in (("<P>", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("a", "ba", "c")):
        with pytest.raises(ValueError):
            q.fill_middle(small_docs(spark), marks=marks)


def test_very_long_text_is_matched_in_blocks(spark, monkeypatch):
    text = "a漢🙂\n " * 60_000
    units = q.Units()
    assert len(text) > q.LONG and list(units.ends(text)) == list(range(1, len(text) + 1))
    words, short = "ab  cd\n" * 1000, q.Units(r"\S+\s*")
    whole = short.ends(words)
    monkeypatch.setattr(q, "LONG", 64)
    assert list(q.Units(r"\S+\s*").ends(words)) == whole
    docs = spark.createDataFrame([(3, text)], "doc_id long, text string")
    assert tuple(made(docs)[0])[1:6] == brute(3, text)


def test_query_and_empty_table(spark):
    out = {r["doc_id"]: r for r in op12_fill_middle(spark, SMALL).collect()}
    for i, t in pairs(small_docs(spark)):
        want = brute(i, t)
        assert (out[i]["n"], out[i]["form"], out[i]["prefix_chars"], out[i]["middle_chars"]) == want[:4]
        assert out[i]["output_sha256"] == hashlib.sha256(want[4].encode()).hexdigest()
        assert out[i]["restored_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert made(empty_docs(spark)) == []
