import math
import random

import pytest
from llm_data import docs_of, no_docs, odd_docs, odd_rows, words

from meteomart.llm import lsh_forest as L


def shingles(text, k=5):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(texts, threshold=0.8):
    """Classes and links of different shingle sets, by comparing all."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = set()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and len(a & b) >= threshold * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
                if a != b:
                    links.add((a, b) if hash(a) < hash(b) else (b, a))
    return [find(i) for i in range(len(texts))], links


def mutated(rng, text, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


def families(seed, n_family=4, members=12, size=120):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 60)) for _ in range(40)]
    for _ in range(n_family):
        base = words(rng, size)
        texts += [base] * 3 + [mutated(rng, base, rng.randint(1, 5)) for _ in range(members)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small", [2, 24])
def test_classes_match_brute_force(spark, monkeypatch, small):
    """small = 2 sends nearly all prefixes the way of large ones."""
    monkeypatch.setattr(L, "SMALL", small)
    texts = families(7)
    want, links = brute(texts)
    got = {r["doc_id"]: r for r in L.classes(docs_of(spark, texts)).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    if small == 24:
        ends = {}
        for a, b in links:
            ends[a] = ends.get(a, 0) + 1
            ends[b] = ends.get(b, 0) + 1
        assert [got[i]["n_links"] for i in range(len(texts))] == [ends.get(shingles(t), 0) for t in texts]
    counts = {}
    for t in texts:
        counts[shingles(t)] = counts.get(shingles(t), 0) + 1
    assert all(got[i]["n_copies"] == counts[shingles(t)] for i, t in enumerate(texts))


@pytest.mark.parametrize("rows", [1024, 5])
def test_no_link_is_lost_in_large_prefixes(spark, monkeypatch, rows):
    """rows = 5 deals the members of a prefix into many blocks."""
    monkeypatch.setattr(L, "SMALL", 2)
    monkeypatch.setattr(L, "BLOCK_ROWS", rows)
    texts = families(8, n_family=2, members=15, size=300)
    want, links = brute(texts)
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in L.classes(docs).collect()}
    sets = [shingles(t) for t in texts]
    ends = [sum(s in pair for pair in links) for s in sets]
    assert max(ends) > 10 and [got[i]["n_links"] for i in range(len(texts))] == ends
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    found = L.join(docs)[1].collect()
    assert len(found) == len(links)
    for r in found:
        a, b = sets[r["a"]], sets[r["b"]]
        assert r["a"] < r["b"] and r["similarity"] == len(a & b) / len(a | b)


def test_rare_pairs_hold_all_similar_pairs(spark):
    texts = families(9, n_family=2)
    docs = docs_of(spark, texts)
    ids = docs.select(docs["doc_id"].alias("id"))
    got = {(r["a"], r["b"]) for r in L._rare_pairs(ids, ids, docs, 5, 0.8).collect()}
    sets = [shingles(t) for t in texts]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                assert (j, i) in got


def test_prefix_is_shortened_to_the_recall():
    missed = lambda prefixes: math.prod(1 - 0.8 ** p for p in prefixes)
    found = L.longest(20, 6, 0.8, 0.999)
    assert 1 - missed(found) >= 0.999 and set(found) == {5, 6}
    longer = [*found]
    longer[longer.index(5, found.count(5) - 1)] += 1
    assert 1 - missed(longer) < 0.999
    assert L.longest(20, 8, 0.8, 0.0) == [8] * 20
    assert L.longest(2, 8, 0.8, 1.0) == [1, 1]


@pytest.mark.parametrize("small", [2, 5])
def test_meetings_match_a_trie_by_hand(spark, monkeypatch, small):
    """Every label ends at the shortest prefix that few share, at any number of partitions."""
    monkeypatch.setattr(L, "SMALL", small)
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a = rng.randrange(60)
        b = 1_000 + a * 10 + rng.randrange(3)
        rows.append((i, 9, a, b, None if a % 2 else b * 100 + rng.randrange(3)))
    rows += [(1000 + i, 9, 7_000, 8_000, 9_000) for i in range(40)]
    got = {(r["id"], r["key"], r["n"]) for r in L._meetings(
        spark.createDataFrame(rows, "id long, size long, k0 long, k1 long, k2 long").repartition(7)).collect()}
    want = set()
    for i, _, *path in rows:
        path = [k for k in path if k is not None]
        for at, key in enumerate(path):
            n = sum(key == r[2 + at] for r in rows)
            if n <= small or at + 1 == len(path):
                if n > 1:
                    want.add((i, key, n))
                break
    assert got == want


def test_ids_that_repeat_with_other_texts(spark):
    rng = random.Random(3)
    a, b, c = (words(rng, 90) for _ in range(3))
    rows = [(1, a), (1, b), (2, a), (3, b), (3, mutated(rng, b, 1)), (4, ""), (4, c), (4, ""), (5, c), (1, a), (6, mutated(rng, c, 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS size", "1 AS f1", "2 AS least")
    got = L.classes(docs).collect()
    assert len(got) == len(rows)
    want, _ = brute([t for _, t in rows])
    groups = {}
    for (i, t), w in zip(rows, want, strict=True):
        groups.setdefault((w if t else i, bool(t)), []).append(i)
    found = {}
    for r in got:
        found.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups.values()))
    kept = L.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    texts = [r["text"] for r in kept.collect()]
    assert len({t for t in texts if t}) == 3 and texts.count("") == 1
    # The four rows of two unrelated texts with one id in common.
    four = docs.limit(0).unionByName(spark.createDataFrame(rows[:4], "doc_id long, text string").selectExpr("*", "'x' AS size", "1 AS f1", "2 AS least"))
    assert sorted(r["text"] for r in L.keep_one(four).collect()) == sorted([a, b])
    assert sorted(r["n_copies"] for r in L.classes(four).collect()) == [2, 2, 2, 2]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = L.classes(docs).collect()
    assert len(rows) == len(odd_rows())
    by = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in rows}
    assert by[1] == by[2] == (1, 0, 3)
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert by[i] == (i, 0, 1)
    assert by[None] == (None, 0, 1)
    kept = L.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "10", "None"])
    assert L.classes(no_docs(spark)).count() == 0 and L.keep_one(no_docs(spark)).count() == 0
