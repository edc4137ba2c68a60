import hashlib
from collections import defaultdict

import pytest

from keysweep.llm import line_spread as q
from llm_fixtures import empty_docs, odd_docs, small_docs

EDGE = " \t\n\x0b\x0c\r"


def spread(rows, least):
    """Lines on at least ``least`` sites, of rows (id, text, site)."""
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(EDGE):
                sites[line.strip(EDGE)].add(site or "")
    return {k for k, v in sites.items() if len(v) >= least}


def furniture(rows, least, share=q.HOST_SHARE):
    """(widespread lines, furniture)."""
    wide = spread(rows, least)
    hosts = []
    for row in rows:
        lines = [x.strip(EDGE) for x in (row[1] or "").split("\n")]
        if sum(len(x) for x in lines if x in wide) <= share * sum(map(len, lines)):
            hosts.append(row)
    return wide, wide & spread(hosts, least)


def brute(rows, least):
    wide, cut = furniture(rows, least)
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        rest = "\n".join(x for x in lines if x.strip(EDGE) not in cut)
        out.append((str(doc_id), len(lines), sum(x.strip(EDGE) in wide for x in lines), sum(x.strip(EDGE) in cut for x in lines),
                    hashlib.sha256(rest.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("make, least", [(small_docs, 8), (small_docs, 3), (odd_docs, 2)])
def test_report_matches_brute_force(spark, make, least):
    docs = make(spark)
    marks = q.line_marks(q.line_table(docs, min_sites=least), least)
    got = sorted((str(r[0]), *list(r)[1:]) for r in q.line_report(docs, marks).collect())
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert got == brute(rows, least)
    assert make is odd_docs or any(r[3] for r in got)


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(s, f"line on {n} sites\nown {s}", f"site{s}") for n in (7, 8, 9, 60) for s in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {(r["exact"], r["sites"]) for r in q.line_spread(q.line_table(docs), 8).collect()}
    assert {(True, 8), (True, 9)} <= found and len(found) == 3
    assert max(s for _, s in found) > 50


def test_furniture_goes_everywhere_and_copied_bodies_stay(spark):
    body = "\n".join(f"sentence number {i} of a text that is long enough" for i in range(6))
    own = "unlike any other text number {} with words of its own"
    rows = [(s, f"accept all cookies\n{body if s < 9 else body + f' variant {s}'}\nunique {s}", f"site{s}", 0, "x") for s in range(20)]
    rows += [(100 + s, f"accept all cookies\n{own.format(s)}", f"site{s}", 0, "x") for s in range(12)]
    rows += [(200 + s, f"  accept all cookies\r\n{s}", f"site{s}", 0, "x") for s in range(3)]     # little but furniture
    rows += [(300 + s, f"accept all cookies\n{body}\nunique 0", None, 0, "x") for s in range(5)]  # exact copies without a site
    rows += [(None, "accept all cookies", "site1", 0, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, words string")
    out = q.remove_furniture(docs, q.line_marks(q.line_table(docs)), length_col="n_chars")
    assert out.schema == docs.schema and out.count() == len(rows)
    want = [(i, t.split("\n", 1)[1] if "\n" in t else "") for i, t, *_ in rows]
    assert sorted((repr(r["doc_id"]), r["text"]) for r in out.collect()) == sorted((repr(i), t) for i, t in want)
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_a_long_text_with_many_widespread_lines(spark):
    lines = [f"menu item number {k}" for k in range(6000)]
    rows = [(s, "\n".join([*lines, f"own words of the text {s} " * 8000]), f"site{s}") for s in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = q.remove_furniture(docs, q.line_marks(q.line_table(docs))).collect()
    assert {r["text"] for r in got} == {f"own words of the text {s} " * 8000 for s in range(9)}


def test_empty_table(spark):
    docs = empty_docs(spark)
    marks = q.line_marks(q.line_table(docs))
    assert q.line_report(docs, marks).count() == 0
    assert q.remove_furniture(docs, marks).columns == docs.columns
