from collections import Counter

from compare import connect, differences
from conftest_llm import words

from sqlloom.llm import license_scan
from sqlloom.llm.queries import op1_license_scan


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in license_scan.PHRASES.items() for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_base_places_by_brute_force(edge_docs, edge_rows):
    got = license_scan.scan(edge_docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((i, *base(t)) for i, t, *_ in edge_rows)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


def test_notices_with_lost_and_added_words(spark):
    notice = dict(license_scan.NOTICES)["bsd"].split()
    cut = " ".join(notice[:8] + ["really"] + notice[8:13] + notice[14:])
    rows = [(1, "x " * 50 + cut + " y" * 50), (2, " ".join(notice[:6])), (3, cut.upper()), (4, " ".join(reversed(notice)))]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["bsd", "", "bsd", ""]
    assert got[1].score == got[3].score >= license_scan.COVERAGE and got[4].score == 0


def test_matches_oracle_without_python(spark, sf):
    df = op1_license_scan(spark, sf)
    assert differences(df, connect(sf), license_scan.oracle()) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_empty_table(no_docs):
    assert license_scan.scan(no_docs).count() == 0
