import hashlib

import pytest
from pyspark.sql import functions as F

from keysweep.llm import spot_signatures as q
from llm_fixtures import PROSE, empty_docs, odd_docs, pairs, small_docs


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("make, per_range", [(small_docs, 4096), (small_docs, 16), (odd_docs, 5)])
def test_edited_texts_and_likeness(spark, monkeypatch, make, per_range):
    monkeypatch.setattr(q, "ROWS_PER_RANGE", per_range)
    docs = make(spark)
    got = sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                  r["near_edited"], r["near_next"]) for r in q.edited_report(docs).collect())
    rows = order(pairs(docs))
    prints = {}

    def prints_of(texts):
        todo = sorted({t for t in texts if t not in prints})
        made = q.fingerprints(spark.createDataFrame(list(enumerate(todo)), "doc_id long, text string")).collect()
        prints.update({todo[r["doc_id"]]: r["fingerprint"] for r in made})

    edited = []
    for i, (_, text) in enumerate(rows):
        n = len(text) // 4
        edited.append(text[:len(text) - n] + rows[(i + 1) % len(rows)][1][:n])
    prints_of([t for _, t in rows] + edited)

    def near(a, b):
        a, b = [set(x.split(".")) - {""} for x in (a, b)]
        return len(a & b) / len(a | b) if a | b else 1.0

    want = sorted((str(d), len(t), hashlib.sha256(e.encode()).hexdigest(), prints[t], prints[e], near(prints[t], prints[e]),
                   near(prints[t], prints[rows[(i + 1) % len(rows)][1]])) for i, ((d, t), e) in enumerate(zip(rows, edited)))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:])


def test_chains_follow_anchors(spark):
    words = "the quick brown fox is on a hill near old mills".split()
    common = set(q.anchor_words())
    content = [(i, w) for i, w in enumerate(words) if w not in common]
    chains = set()
    for i, w in enumerate(words):
        after = [c for p, c in content if p > i][:2]
        if w in common and len(after) == 2:
            chains.add((w, *after))
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    want = {r[0] for r in spark.createDataFrame(sorted(chains), "a string, b string, c string").select(F.xxhash64("a", "b", "c")).collect()}
    assert set(q.fingerprints(df).first()["spots"]) == want


def test_equal_texts_fallbacks_and_null(spark):
    rows = [(1, PROSE), (2, PROSE), (3, "xx yy"), (4, ""), (5, None), (6, "aa bb cc dd")]
    got = {r["doc_id"]: r["fingerprint"] for r in q.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[2] != "" and got[4] == got[5] == "" and got[3] and got[6].count(".") == 1


def test_similar_fingerprints_match_brute_force(spark):
    docs = odd_docs(spark).where("doc_id is not null").unionByName(small_docs(spark).select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source", "n_chars"), allowMissingColumns=True)
    prints = q.fingerprints(docs)
    classes, links = q.similar_fingerprints(prints, 0.5)
    sets = {}
    for r in prints.collect():
        sets.setdefault(r["fingerprint"], []).append(r["doc_id"])
    reps = {min(v): set(k.split(".")) - {""} for k, v in sets.items()}
    assert {(r["doc_id"], r["rep"]) for r in classes.collect()} == {(d, min(v)) for v in sets.values() for d in v}
    ids = sorted(k for k, v in reps.items() if v)
    want = {(a, b) for a in ids for b in ids if a < b and len(reps[a] & reps[b]) >= 0.5 * len(reps[a] | reps[b])}
    got = [(r["a"], r["b"]) for r in links.collect()]
    assert set(got) == want and len(got) == len(want)


def test_empty_table(spark):
    assert q.edited_report(empty_docs(spark)).count() == 0


def test_text_ids_over_several_ranges(spark):
    """Ids that aren't numbers: the next document is the next in the order of the text, over all ranges."""
    n = 3 * q.ROWS_PER_RANGE
    docs = spark.range(n).selectExpr("concat(substring('abcxyz', CAST(1 + id % 6 AS INT), 1), CAST(id AS STRING)) AS doc_id",
                                     "concat('the text of number ', CAST(id AS STRING), ' and more of it') AS text")
    got = {r["doc_id"]: r["edited_sha256"] for r in q.edited_report(docs).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    for (i, text), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        cut = len(text) // 4
        assert got[i] == hashlib.sha256((text[:len(text) - cut] + following[:cut]).encode()).hexdigest()
