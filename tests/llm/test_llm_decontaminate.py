import re

import pytest

from keysweep.llm import decontaminate as q
from llm_fixtures import ODD_TEXTS, PROSE, SMALL, empty_docs, lower_ascii, odd_docs, small_docs

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return PLAIN.findall(lower_ascii(text or ""))


def brute(docs, items, size=10):
    """Per document: (id, words, covered words, items)."""
    windows = {}
    for item, text in items:
        words = plain(text)
        n = min(len(words), size)
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add(str(item) if item is not None else "")
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, names = plain(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(words[i:i + n])]
        out.append((str(doc_id), len(words), len(hit), tuple(sorted(names))))
    return sorted(out)


def report(docs, benchmark, **kw):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], tuple(r["items"]))
                  for r in q.contamination_report(docs, benchmark, **kw).collect())


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, words string, n_words int, doc_id long")


ITEMS = [("a", PROSE, "x", 1, 1), ("b", "One two", "x", 1, 1), ("b", "of the town AND", None, None, None), ("c", "", "x", 1, 1),
         ("d", None, "x", 1, 1), (None, "Ünïcode ß", "x", 1, 1), ("e", " ".join(["same"] * 12), "x", 1, 1),
         ("a", "the river ran past the old mill and on to the sea", "x", 1, 1), ("f", "漢字", "x", 1, 1), ("f", "漢字", "x", 1, 1)]


def test_odd_texts_and_items(spark):
    docs, bench = odd_docs(spark), items(spark, ITEMS)
    got = report(docs, bench)
    assert got == brute(pairs(docs, "doc_id"), [(r[0], r[1]) for r in ITEMS])
    assert any(n == 400 for _, n, hit, _ in got if hit == 400)


@pytest.mark.parametrize("size", [10, 4])
def test_small_tables(spark, size):
    docs, bench = small_docs(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = report(docs, bench, size=size)
    assert got == brute(pairs(docs, "doc_id"), pairs(bench, "item_id"), size)
    assert 0 < sum(r[2] > 0 for r in got) < len(got)


def test_a_benchmark_beyond_the_broadcast_limit_is_cut(spark):
    docs, bench = small_docs(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    windows = q.benchmark_windows(bench, max_bytes=100_000)
    assert windows.parts >= 4
    assert report(docs, bench, max_bytes=100_000) == report(docs, bench)


def test_a_window_of_the_documents_own_key_is_no_document(spark):
    # a hit must be a real one: same key, other words
    docs = odd_docs(spark)
    windows = q.benchmark_windows(items(spark, [("a", "these ten words are held by no document at all here", "", 1, 1)]))
    fooled = q.Windows(windows.table.selectExpr("CAST(0 AS BIGINT) AS key", "length", "words", "items"), windows.lengths, 1)
    assert q.occurrences(docs, fooled).where("length > 0").count() == 0
    assert q.occurrences(docs, fooled).count() == docs.count()


def test_empty_tables(spark):
    docs, bench = odd_docs(spark), items(spark, ITEMS)
    none = items(spark, [])
    assert q.contamination_report(empty_docs(spark), bench).count() == 0
    assert {(r[2], r[3]) for r in report(docs, none)} == {(0, ())}
    for remove in (q.remove_spans, q.remove_documents):
        assert remove(empty_docs(spark), bench).columns == docs.columns
        assert remove(docs, none).count() == docs.count()


def cut(text, bench):
    """``text`` without its hit runs, from a run's first character to its last."""
    spots = [m.span() for m in PLAIN.finditer(lower_ascii(text))]
    words = plain(text)
    hit = [False] * len(words)
    for _, t in bench:
        w = plain(t)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == w[i:i + n]:
                    hit[j:j + n] = [True] * n
    out, at, i = "", 0, 0
    while i < len(hit):
        if hit[i]:
            j = i
            while j + 1 < len(hit) and hit[j + 1]:
                j += 1
            out += text[at:spots[i][0]]
            at, i = spots[j][1], j
        i += 1
    return out + text[at:]


def test_spans_and_documents_go(spark):
    bench = [(r[0], r[1]) for r in ITEMS]
    texts = [*ODD_TEXTS, "Before: " + PROSE + "! Between; " + PROSE.upper() + " after. One, two.", "x " + "same " * 11 + "y"]
    rows = [(i, t, "s", len(t or ""), "w", "g") for i, t in enumerate(texts)] + [(None, PROSE, "s", 1, "w", "g")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, n_chars int, spans string, words string")
    out = q.remove_spans(docs, items(spark, ITEMS), length_col="n_chars")
    assert out.schema == docs.schema
    want = sorted(repr((i, t if not t else cut(t, bench))) for i, t, *_ in rows)
    assert sorted(repr((r["doc_id"], r["text"])) for r in out.collect()) == want
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] and r["doc_id"] is not None)
    left = q.remove_documents(docs, items(spark, ITEMS))
    hit = {i for i, _, n, _ in brute([(k, t) for k, t, *_ in rows], bench) if n}
    assert left.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r[0]) for r in rows if str(r[0]) not in hit)


def test_many_hits_in_one_text(spark):
    text = " ".join(["same"] * 60_000)
    docs = spark.createDataFrame([(1, text + " end")], "doc_id long, text string")
    bench = items(spark, ITEMS)
    assert report(docs, bench) == [("1", 60_001, 60_000, ("e",))]
    assert q.remove_spans(docs, bench).first()["text"] == " end"
