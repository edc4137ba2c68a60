import re
from collections import Counter

import pytest

from keysweep.llm import quality_rules as q
from llm_fixtures import WORD, empty_docs, odd_docs, small_docs


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(wins)
    covered = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("make", [small_docs, odd_docs])
def test_measurements_match_brute_force(spark, make):
    docs = make(spark)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                  r["n_repeat_words"]) for r in q.ledger(docs).collect())
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0), *brute(r["text"])) for r in docs.collect())
    assert got == want


def test_bits_policies_and_ablations(spark):
    entries = q.ledger(odd_docs(spark))
    rows = entries.collect()
    names = list(q.RULES)
    assert all(((r["fail_bits"] >> names.index("few_words")) & 1) == (r["n_words"] < 50) for r in rows)
    kept = q.apply_policy(entries, q.V1).collect()
    assert [r["kept"] for r in kept] == [(r["fail_bits"] & q.V1.mask) == 0 for r in kept]
    assert {r["policy"] for r in kept} == {"v1"}
    table = {r["rule"]: (r["failing"], r["only_this"]) for r in q.ablations(entries, q.V2).collect()}
    for k, name in enumerate(names):
        assert table[name] == (sum((r["fail_bits"] >> k) & 1 for r in rows),
                               sum((r["fail_bits"] & q.V2.mask) == 1 << k for r in rows))


def test_keep_documents_keeps_columns_and_good_rows(spark):
    docs = odd_docs(spark)
    kept = q.keep_documents(docs, q.BASE)
    assert kept.columns == docs.columns

    def good(text):
        n, _, _, _, repeated = brute(text)
        return n >= 50 and 100 * repeated <= 50 * n

    want = [r for r in docs.collect() if good(r["text"])]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, want))


def test_empty_table(spark):
    docs = empty_docs(spark)
    assert q.ledger(docs).count() == 0
    assert q.keep_documents(docs).count() == 0
    assert q.ablations(q.ledger(docs), q.V1).count() == 0
