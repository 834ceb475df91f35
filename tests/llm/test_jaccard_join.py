import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from conftest_llm import ascii_lower

from sqlloom.llm import jaccard_join as jj
from sqlloom.llm.common import pieces, table
from sqlloom.llm.queries import op7_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall(ascii_lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(sets):
    """Least index of the component of each set."""
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in where[x] if j < i)
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def expected(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    roots = brute_components(sets)
    names = {}
    for (doc_id, *_), root, s in zip(rows, roots, sets):
        if doc_id is not None and s:
            names[root] = min(names.get(root, doc_id), doc_id)
    return Counter((row[0], len(s), names.get(root) if s else row[0]) for row, root, s in zip(rows, roots, sets))


def families(seed):
    """Families of near copies around the threshold, with chains, shells and shared passages."""
    rnd, texts = random.Random(seed), []
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(5):
        base = [rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 40)) for _ in range(rnd.choice([30, 60, 120, 300]))]
        for _ in range(60):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, 6, 8])):
                i, kind = rnd.randrange(len(w)), rnd.random()
                if kind < 0.6:
                    w[i] = "m" + str(rnd.randint(0, 9))
                elif kind < 0.8:
                    del w[i : i + rnd.randint(1, 8)]
                else:
                    w[i:i] = ["k" + str(rnd.randint(0, 9))]
                w = w or ["z"]
            text = " ".join(w)
            texts.append(text.upper() if rnd.random() < 0.1 else text)
    texts += [" ".join(f"u{i}x{j}" for j in range(150)) + " " + passage for i in range(60)]
    return list(enumerate(texts + ["", None, "a", "a", "a b c", "A B\tC", "a b c d e", "a b c d"]))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jj.near_duplicates(df).collect())


@pytest.mark.parametrize("seed", range(2))
def test_components_by_brute_force(spark, seed):
    rows = families(seed)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == expected(rows)


def test_small_blocks_and_no_frequent_list(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 2_000)
    monkeypatch.setattr(jj, "SEEN", 1 << 40)
    rows = families(7)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == expected(rows)


def test_edge_rows(edge_docs, edge_rows):
    assert got(edge_docs) == expected(edge_rows)


def test_one_of_each(spark, edge_docs, edge_rows):
    kept = jj.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    distinct = {(i, t) for i, t, *_ in edge_rows if shingles(t)}
    assert Counter(r for r in rows if shingles(r[1])) == Counter(distinct)  # no near copies but repeated rows
    assert len([r for r in rows if not shingles(r[1])]) == sum(not shingles(t) for _, t, *_ in edge_rows)
    rows = families(3)
    kept = {r.doc_id for r in jj.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {c for (_, n, c) in expected(rows) if n} | {i for i, t in rows if not shingles(t)}


def test_query_over_the_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in op7_jaccard_join(spark, sf).collect()) == expected(rows)


def test_query_matches_oracle(spark, sf):
    assert differences(op7_jaccard_join(spark, sf), connect(sf), jj.oracle()) is None


def test_bitmaps_never_exceed_the_distance():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, rng.integers(1, 900), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(0, len(a) + 1)), rng.integers(0, 2**64, rng.integers(1, 900), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        assert jj.least_distance(jj.bitmap(a), len(a), jj.bitmap(b), len(b)) <= 1 - both / (len(a) + len(b) - both) + 1e-12


def test_spanning_links_join_what_all_links_join():
    rng = np.random.default_rng(9)
    for _ in range(300):
        m = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < rng.choice([0.05, 0.2, 0.6])
        a, b = jj.spanning(m)
        assert m[a, b].all() and len(a) <= sum(m.shape)

        def parts(pairs):
            p = list(range(sum(m.shape)))
            for i, j in pairs:
                x, y = p[i], p[m.shape[0] + j]
                p = [min(x, y) if v in (x, y) else v for v in p]
            return p

        assert parts(zip(a, b)) == parts(zip(*np.nonzero(m)))


def test_empty_table(no_docs):
    assert jj.near_duplicates(no_docs).count() == 0
    assert jj.one_of_each(no_docs).count() == 0


def test_memory_of_a_task_is_bounded_by_small_pieces_of_a_batch():
    texts = [" ".join(f"w{i}x{j}" for j in range(12_000)) for i in range(60)]
    batch = pa.record_batch({"doc_id": pa.array(range(60), pa.int64()), "text": pa.array(texts, pa.string())})
    assert batch.nbytes > 4 << 20
    tracemalloc.start()
    rows, shingles = 0, 0
    for part in pieces(batch, "text"):
        rows += part.num_rows
        shingles += len(jj.shingle_sets(part.column("text"))[1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 60 and shingles == 60 * 11_996
    assert peak < 64 << 20


def test_measured_sets_are_passed_on_in_small_batches():
    sets = [np.arange(i, i + 10_000, dtype="<u8").tobytes() for i in range(40)]
    batch = pa.record_batch(
        {"region": pa.array([0] * 40), "class": pa.array(range(40)), "guest": pa.array([False] * 40), "shingles": pa.array(sets, pa.binary()), "pivot_shingles": pa.array([sets[0]] * 40, pa.binary())}
    )
    out = list(jj._against_pivot(iter([batch])))
    assert max(sum(map(len, b.column("shingles").to_pylist())) for b in out) <= 1 << 19
    got = [r for b in out for r in b.to_pylist()]
    assert [r["class"] for r in got] == list(range(40)) and [r["shingles"] for r in got] == sets
    assert [r["linked"] for r in got] == [5 * (10_000 - i) >= 4 * (10_000 + i) for i in range(40)]
