import random
from itertools import combinations

import pytest

from keysweep.llm import ngram_join as q
from keysweep.llm.components import components
from llm_fixtures import PROSE, WORD, empty_docs, lower_ascii, odd_docs, small_docs


def shingles(text, size):
    words = WORD.findall(lower_ascii(text or ""))
    if len(words) >= size:
        return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)] if words else [])


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        same = len(a & b)
        if a and b and 100 * same >= percent * (len(a) + len(b) - same):
            links[i] += 1
            links[j] += 1
            root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return sorted((str(d), len(s), str(ids.get(find(i))), n) for i, ((d, _), s, n) in enumerate(zip(rows, sets, links)))


def table(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["n_links"]) for r in df.collect())


@pytest.mark.parametrize("make, size, percent", [(small_docs, 4, 85), (odd_docs, 4, 85), (odd_docs, 5, 80)])
def test_matches_brute_force(spark, make, size, percent):
    docs = make(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert table(q.similar_documents(docs, size, percent)) == brute(rows, size, percent)


def test_large_groups_common_passages_and_small_blocks(spark, monkeypatch):
    """Groups over several blocks, a passage that half of the texts share, chains of near copies."""
    monkeypatch.setattr(q, "TILE_BLOCK", 8)
    monkeypatch.setattr(q, "GROUP_BLOCK", 8)
    monkeypatch.setattr(q, "LEAST_HOT", 4)
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") + rng.choice("ijklmnop") * rng.randint(1, 3) + rng.choice("qrstuvwx")
    base = [word() for _ in range(120)]
    rows = []
    for i in range(60):   # near copies of one text, more changes further on
        words = list(base)
        for _ in range(i % 7):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    for i in range(60, 120):   # texts that share a passage
        rows.append((i, " ".join([word() for _ in range(40)]) + " " + PROSE))
    rows += [(200 + i, rows[3][1]) for i in range(10)]   # copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert table(q.similar_documents(docs, 4, 85)) == brute(rows, 4, 85)


def test_tiles_of_a_group_of_near_copies_are_cut(spark, monkeypatch):
    """Near copies share shingles that only the order with hot ones last files; their tiles are cut too."""
    monkeypatch.setattr(q, "TILE_BLOCK", 16)
    monkeypatch.setattr(q, "LEAST_HOT", 4)
    rng = random.Random(7)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        words[rng.randrange(len(words))] = f"own{i}"
        rows.append((i, " ".join(words)))
    largest, real = [], q._blocks

    def counted(df, count, *keep):
        out = real(df, count, *keep)
        if "token" in keep:
            largest.append(out.groupBy("token", "band", "ci", "cj").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(q, "_blocks", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert table(q.similar_documents(docs, 4, 85)) == brute(rows, 4, 85)
    assert 16 < largest[0] < 80   # two blocks of about 16, dealt by hash; uncut: 160


def brute_kept(rows, size, percent):
    """Per group of linked (id, text) its smallest id (null last), and every different row without words."""
    rows = sorted(set(rows), key=repr)
    # the place of each row as an id of its own: component ids then name groups
    groups = {}
    for place, n, component, _ in brute(list(enumerate(t for _, t in rows)), size, percent):
        groups.setdefault(int(component) if n else -1 - int(place), []).append(rows[int(place)][0])
    return sorted((str(min((d for d in ids if d is not None), default=None)) for ids in groups.values()))


def test_keep_first(spark):
    docs = odd_docs(spark)
    kept = q.keep_first(docs, 4, 85)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == brute_kept(rows, 4, 85)


def test_keep_first_decides_by_row(spark):
    """One id, or none, on near copies of others, on texts of their own and on empty ones."""
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(5, PROSE), (7, PROSE + " again"), (7, other), (7, "  "), (7, None), (7, ""), (7, ""), (None, PROSE), (None, PROSE + " and"),
            (None, other + " more"), (None, ""), (None, "one of its own"), (None, "one of its own"), (9, "one of its own")] + [(7, PROSE)] * 50
    kept = [(r["doc_id"], r["text"]) for r in q.keep_first(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()]
    assert sorted(kept, key=repr) == sorted([(5, PROSE), (7, other), (7, "  "), (7, None), (7, ""), (None, ""), (9, "one of its own")], key=repr)
    nameless = [(None, PROSE), (None, PROSE + " again"), (None, other)]
    kept = q.keep_first(spark.createDataFrame(nameless, "doc_id long, text string"), 4, 80).collect()
    assert len(kept) == 2 and other in {r["text"] for r in kept}


def test_empty_table(spark):
    assert q.similar_documents(empty_docs(spark)).count() == 0
    assert q.keep_first(empty_docs(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
