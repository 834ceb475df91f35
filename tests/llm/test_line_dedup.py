import hashlib
import random

import pytest
from compare import connect, differences

from sqlloom.llm import line_dedup as ld
from sqlloom.llm.queries import op11_line_dedup

DOCS = "doc_id long, text string"


def brute(rows):
    """Plain restatement: (doc_id, n_lines, n_dropped, kept_sha256) per row."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                holders.setdefault(k, []).append(doc)
    keeper = {k: min((d for d in docs if d is not None), default=None) for k, docs in holders.items()}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = keeper.get(key(line)) if len(key(line)) >= 10 else None
            if k is not None and (doc is None or doc > k):
                continue
            kept.append(line)
        kept_text = "\n".join(kept)
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256(kept_text.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    kept = ld.dedupe_lines(df, **kw)
    got = kept.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(coalesce(text, ''), 256)").collect()
    return sorted((tuple(r) for r in got), key=repr)


def random_rows(seed, n=60):
    rnd = random.Random(seed)
    pool = [f"Shared line number {i} here" for i in range(12)] + ["short", "   SHARED LINE NUMBER 3 HERE \t", "", "ΩΩΩΩΩΩΩΩΩΩ ünï"]
    rows = []
    for i in range(n):
        lines = [rnd.choice(pool) if rnd.random() < 0.6 else f"own line {i} {j} of this document" for j in range(rnd.randint(0, 6))]
        doc = rnd.choice([None, *range(40)]) if rnd.random() < 0.2 else i
        rows.append((doc, "\n".join(lines) if lines or rnd.random() < 0.5 else None))
    rows += rows[:5]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_by_brute_force(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == brute(rows)


def test_full_filter_gives_the_same_rows(spark, monkeypatch):
    """A filter of few bits holds nearly every hash: more suspects, equal results."""
    rows = random_rows(7)
    monkeypatch.setattr(ld, "BITS", 1 << 6)
    assert run(spark, rows) == brute(rows)


def test_lines_of_one_key_in_the_keeper_all_stay(spark):
    rows = [(1, "A repeated line!\na repeated line!"), (2, "x\n  A REPEATED LINE!  \ny")]
    assert run(spark, rows) == brute(rows)
    got = dict((r[0], r[1:3]) for r in run(spark, rows))
    assert got == {1: (2, 0), 2: (3, 1)}


def test_nulls_and_rows_without_id(spark):
    rows = [(None, "only rows without id hold this"), (None, "only rows without id hold this"), (None, "a key held with an id\nz"), (3, "a key held with an id"), (4, None), (5, "")]
    got = {(r[0], r[1], r[2]) for r in run(spark, rows)}
    assert (None, 1, 0) in got and (None, 2, 1) in got and (4, 1, 0) in got and (5, 1, 0) in got
    assert run(spark, rows) == brute(rows)


def test_edge_rows(edge_docs, edge_rows):
    kept = ld.dedupe_lines(edge_docs)
    assert set(edge_docs.columns) <= set(kept.columns)
    got = sorted((tuple(r) for r in kept.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(coalesce(text, ''), 256)").collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in edge_rows])


def test_clashing_output_names(spark):
    df = spark.createDataFrame([(1, "same long line here", 9, 9), (2, "same long line here", 9, 9)], "doc_id long, text string, n_lines int, n_dropped int")
    rows = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in ld.dedupe_lines(df).collect()}
    assert rows == {1: (1, 0, "same long line here"), 2: (1, 1, "")}


def test_empty_table(no_docs):
    assert ld.dedupe_lines(no_docs).count() == 0


def test_query_matches_oracle(spark, sf):
    assert differences(op11_line_dedup(spark, sf), connect(sf), ld.oracle()) is None


def test_query_matches_oracle_sf001(spark):
    sf = "/root/testdata/sf0.01"
    result = op11_line_dedup(spark, sf)
    assert result.where("n_dropped > 0").count() > 0
    assert differences(result, connect(sf), ld.oracle()) is None
