"""The registered queries against SQL, and the pipeline against a brute-force version."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from keysweep.llm import quality_rules
from keysweep.llm.queries import ORACLE_SQL, QUERIES
from llm_fixtures import SMALL, WORD, empty_docs, odd_docs, small_docs
from test_llm_line_spread import EDGE, furniture
from test_llm_ngram_join import brute as brute_groups
from test_llm_quality_rules import brute as brute_measures
from test_llm_secret_scan import spans

CONTRACTS = {
    "op1_piece_coding": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_spot_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op5_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op6_license_scan": ["doc_id", "path", "licence"],
    "op7_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_sharding": ["doc_id", "shard", "n_bytes"],
    "op9_quality_model": ["doc_id", "held_out", "score", "predicted"],
    "op10_line_spread": ["doc_id", "n_lines", "n_cut_lines"],
    "op11_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op12_fill_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op13_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
}


def test_every_operator_and_the_pipeline_are_registered():
    assert set(QUERIES) == set(CONTRACTS)
    assert set(contract.queries()) >= {*CONTRACTS, "pipeline"}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns[:len(CONTRACTS[name])] == CONTRACTS[name] or set(CONTRACTS[name]) <= set(df.columns)
    id_col = CONTRACTS[name][0]
    ids = {r[id_col] for r in df.select(id_col).collect()}
    assert ids == set(range(500 if id_col == "vec_id" else 200))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    df = QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect()), key=repr) == sorted(res.fetchall(), key=repr)


def brute_pipeline(rows):
    """rows: (doc_id, text, source); the texts left before packing."""
    good = []
    for doc_id, text, site in rows:
        n, chars, symbols, dup, repeated = brute_measures(text)
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        upper = sum(c.isupper() for c in text or "")
        if not (n < 50 or 100 * repeated > 50 * n or 10 * symbols > n or 100 * dup > 50 * len(lines) or 2 * upper > chars or chars > 25 * n):
            good.append((doc_id, text, site))
    _, gone = furniture(good, 8)
    cut = [(doc_id, "\n".join(x for x in text.split("\n") if x.strip(EDGE) not in gone)) for doc_id, text, _ in good]
    keep = {(d, c) for d, _, c, _ in brute_groups(cut, 5, 80)}
    left = {(d, t) for d, t in cut if (str(d), str(d)) in keep}
    out = []
    for doc_id, text in left:
        at, parts = 0, []
        for start, _, end, _ in spans(text):
            if start >= at:
                parts += [text[at:start], "[SECRET]"]
            at = max(at, end)
        out.append((doc_id, "".join(parts) + text[at:]))
    return out


def check_pieces(pieces, texts):
    tk = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    by = defaultdict(list)
    for r in pieces:
        by[r["doc_id"]].append(r)
    assert set(by) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids = np.array(tk.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at:at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)


def test_pipeline_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in small_docs(spark).collect()]
    texts = brute_pipeline(rows)
    assert 50 < len(texts) < len(rows)
    check_pieces(corpus_pipeline.run(spark, SMALL).collect(), texts)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        out.write.format("noop").mode("overwrite").save()
        assert stage(spark, empty_docs(spark), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_spread", "ngram_join", "secret_scan", "packing"]


def test_stage_decisions_take_effect(spark):
    docs = small_docs(spark)
    kept = corpus_pipeline.quality_stage(spark, docs, SMALL)
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.apply_policy(quality_rules.ledger(docs), quality_rules.V2).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in verdict.items() if v}
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_stage(spark, docs, SMALL).collect()}
    changed = [r for r in docs.collect() if clean[r["doc_id"]] != r["text"]]
    assert changed and not any(spans(clean[r["doc_id"]]) for r in changed)
    assert hashlib.sha256(clean[0].encode()).hexdigest()
