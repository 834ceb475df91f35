import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import words

from sqlloom.llm import decontaminate as dc
from sqlloom.llm.common import table
from sqlloom.llm.queries import op3_decontaminate

ITEMS = [" ".join(f"{'abcdefgh'[i % 8]}{j}" for j in range(n)) for i, n in enumerate([12, 20, 33, 48, 59, 90])]


def edit_table(item, text):
    """Least edit distance of the item to a stretch of the text that ends at each place."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for x in text:
        new = [0]
        for i, y in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != y)))
        row, best = new, min(best, new[-1])
    return best


def edited(text, edits, rnd):
    w = text.split()
    for _ in range(edits):
        i, kind = rnd.randrange(len(w)), rnd.random()
        if kind < 0.5:
            w[i] = f"zz{rnd.randint(0, 99)}"
        elif kind < 0.75:
            del w[i]
        else:
            w.insert(i, f"yy{rnd.randint(0, 99)}")
    return " ".join(w)


def test_nearest_by_brute_force():
    rnd = random.Random(2)
    for _ in range(800):
        item, text = ([rnd.randint(0, 3) for _ in range(rnd.randint(a, b))] for a, b in ((5, 9), (0, 14)))
        best = edit_table(item, text)
        found = dc.nearest(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        if found is None:
            assert best > 3
        else:
            d, a, b = found
            assert d == best and edit_table(item, text[a:b]) == d


@pytest.mark.parametrize("share, recall", [(0.0, 1.0), (0.1, 0.99), (0.2, 0.9)])
def test_recall_of_edited_windows(share, recall):
    rnd = random.Random(int(share * 100))
    index = dc.Index(list(enumerate(ITEMS)))
    vocabulary = [w for t in ITEMS for w in t.split()]
    found = trials = 0
    for k in range(180):
        item = ITEMS[k % len(ITEMS)]
        w = edited(item, int(len(item.split()) * share + 1e-9), rnd)
        text = " ".join(rnd.choices(vocabulary, k=40)) + " " + w.upper() + ", " + " ".join(rnd.choices(vocabulary, k=40))
        if edit_table(item.split(), words(text)) <= dc.allowed(np.array(len(item.split()))):
            trials += 1
            found += any(m[1] == k % len(ITEMS) for m in index.matches(dc.Sequences(pa.array([text]))))
    assert trials > 150 and found / trials >= recall


@pytest.mark.parametrize("size", [5, 9, 15, 59, 150, 300, 600, 1200])
@pytest.mark.parametrize("share", [0.1, 0.2])
def test_nothing_in_reach_is_missed_at_any_size(size, share):
    rnd = random.Random(size)
    vocabulary = [f"v{i}" for i in range(2000)]
    items = [" ".join(rnd.choices(vocabulary, k=size)) for _ in range(10)]
    index = dc.Index(list(enumerate(items)))
    for i, item in enumerate(items):
        w = edited(item, int(size * share + 1e-9), rnd)
        text = " ".join(rnd.choices(vocabulary, k=40)) + " " + w + " " + " ".join(rnd.choices(vocabulary, k=40))
        found = {m[1]: m[4] for m in index.matches(dc.Sequences(pa.array([text])))}
        assert found.get(i) == (edit_table(item.split(), text.split()))


def test_matches_by_brute_force():
    """Few different words, so that pieces and items overlap and repeat."""
    rnd = random.Random(5)
    for _ in range(150):
        items = [" ".join(rnd.choices("abc", k=rnd.randint(2, 24))) for _ in range(4)]
        texts = [" ".join(rnd.choices("abcd", k=rnd.randint(0, 60))) for _ in range(4)]
        got = {(d, i): n for d, i, _, _, n in dc.Index(list(enumerate(items))).matches(dc.Sequences(pa.array(texts)))}
        tables = {(d, i): edit_table(y.split(), x.split()) for d, x in enumerate(texts) for i, y in enumerate(items)}
        assert got == {(d, i): n for (d, i), n in tables.items() if n <= dc.allowed(np.array(len(items[i].split())))}


def test_many_places_of_pieces_are_taken_in_turns(monkeypatch):
    items, texts = ["a b c d", "a a a a a a", "d c b a x"], ["a b c d " * 40, "a " * 60, "d c b y a x"]
    whole = dc.Index(list(enumerate(items))).matches(dc.Sequences(pa.array(texts)))
    monkeypatch.setattr(dc, "HITS", 7)
    assert dc.Index(list(enumerate(items))).matches(dc.Sequences(pa.array(texts))) == whole and len(whole) >= 3


def test_short_items_and_scripts_without_spaces():
    index = dc.Index([(0, "Paris, France"), (1, "the mitral valve prolapse"), (2, "请问下列哪一项是正确的答案"), (3, "日本の首都はどこですか")])
    texts = ["in paris france now", "paris in france", "a mitral valve prolapse", "x the Mitral valve prolapse.", "前文请问下列哪个是正确的答案。后文", "これは日本の首都はどこですか"]
    got = {(d, i, n) for d, i, _, _, n in index.matches(dc.Sequences(pa.array(texts)))}
    assert got == {(0, 0, 0), (3, 1, 0), (4, 2, 2), (5, 3, 0)}


def test_edge_rows(spark, edge_docs, edge_rows):
    items = [(1, "see the general public license under license"), (2, None), (None, " ".join(f"word{i}x" for i in range(100, 140))), (3, "one"), (4, ""), (1, "another text under the same id")]
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS n")
    got = {(r.doc_id, r.item_id): r for r in dc.contaminated(edge_docs, df).collect()}
    assert set(got) == {(4, None), (8, 1)}
    assert got[4, None].first_word == 100 and got[4, None].n_words == 40 and got[4, None].similarity == 1
    kept = dc.without_contaminated(edge_docs, df)
    assert kept.columns == edge_docs.columns and kept.count() == len(edge_rows) - 2


def test_query_by_brute_force(spark, sf):
    docs, items = (table(spark, sf, t).collect() for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id): r.distance for r in op3_decontaminate(spark, sf).collect()}
    split = [(i.item_id, words(i.text)) for i in items]
    for d in docs:
        w = words(d.text)
        if len(w) > 1500:
            continue
        known = set(w)
        for item_id, item in split:
            most = int(dc.allowed(np.array(len(item))))
            near = sum(x in known for x in item) >= len(item) - most and edit_table(item, w)
            expected = near if near is not False and near <= most else None
            assert got.get((d.doc_id, item_id)) == expected, (d.doc_id, item_id)


def test_several_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 4)
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    docs = spark.createDataFrame([(10 + i, "x y " + t) for i, t in enumerate(ITEMS)] + [(99, "clean text of some words")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(docs, items).collect()} == {(10 + i, i) for i in range(len(ITEMS))}
    assert [r.doc_id for r in dc.without_contaminated(docs, items).collect()] == [99]


def test_empty_tables(spark, no_docs, edge_docs, edge_rows):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(edge_docs, no_items).count() == 0
    assert dc.without_contaminated(edge_docs, no_items).count() == len(edge_rows)
    assert dc.contaminated(no_docs, spark.createDataFrame([(1, ITEMS[0])], "item_id long, text string")).count() == 0
