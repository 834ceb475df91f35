import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sqlloom.llm import language_crf as crf, pu_quality as pu
from sqlloom.llm.common import table
from sqlloom.llm.queries import op4_language_crf, op10_pu_quality


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def area(score, good):
    """Probability that a good row scores above a bad one."""
    rank = score.argsort().argsort() + 1
    n, m = good.sum(), (~good).sum()
    return (rank[good].sum() - n * (n + 1) / 2) / (n * m)


# Quality


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = op10_pu_quality(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    score, good = np.array([r.score for r in judged]), np.array([labels[r.doc_id] == 1 for r in judged])
    assert area(score, good) > 0.95
    assert np.mean([r.predicted == labels[r.doc_id] for r in judged]) > 0.95


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source", "0L AS n_chars")
    a = {r.doc_id: r.score for r in pu.quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in pu.quality(other.repartition(5), flipped).collect()}
    assert a == pytest.approx(b)


def test_quality_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (4, 1, 1), (8, 1, 0), (None, 1, 1), (5, None, None), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = pu.quality(edge_docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows)
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert pu.quality(no_docs, labels).count() == 0
    none = pu.quality(edge_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_non_negative_risk_finds_the_positives_among_unlabelled():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (3_000, 5)), rng.normal(-1.5, 1, (1_000, 5))
    unlabelled = np.concatenate([good[1_500:], bad])
    truth = np.arange(len(unlabelled)) < 1_500
    for prior in (0.6, None):
        model = pu.fit(good[:1_500], unlabelled, prior)
        assert ((model.margin(unlabelled) >= 0) == truth).mean() > 0.97
    assert 0.45 < model.prior < 0.75


# Language


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = op4_language_crf(spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.98


def test_languages_of_edge_rows(spark, edge_docs, edge_rows, no_docs):
    got = crf.languages(edge_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (2, 3, 5, 7))
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (1, 4, 6, 8))
    assert crf.languages(no_docs).count() == 0
    unknown = crf.languages(edge_docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_forward_backward_by_brute_force():
    rng = np.random.default_rng(1)
    lengths, k = [1, 4, 3], 3
    scores, move = rng.normal(size=(sum(lengths), k)), rng.normal(size=(k, k))
    chain = np.repeat(np.arange(len(lengths)), lengths)
    place = np.concatenate([np.arange(n) for n in lengths])
    got, pairs, log_z = crf.forward_backward(scores, chain, place, move)
    expected, seen, total = np.zeros_like(scores), np.zeros((k, k)), 0.0
    for c, n in enumerate(lengths):
        rows = np.flatnonzero(chain == c)
        paths = list(itertools.product(range(k), repeat=n))
        weight = np.array([np.exp(sum(scores[rows[t], p[t]] for t in range(n)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        total += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for t, y in enumerate(p):
                expected[rows[t], y] += w
            for a, b in zip(p, p[1:]):
                seen[a, b] += w
    assert np.allclose(got, expected) and np.allclose(pairs, seen) and np.isclose(log_z, total)


def test_code_switched_words(spark):
    rnd = random.Random(3)
    made = {"xx": ["foo", "bar", "bazo", "quxo"], "yy": ["zin", "zen", "zyl", "wyz"]}
    say = lambda lang, n: " ".join("".join(rnd.choices(made[lang], k=2)) for _ in range(n))
    rows = [(i, say("xx" if i % 2 else "yy", 60), "xx" if i % 2 else "yy") for i in range(80)]
    model = crf.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = [(1, say("xx", 70) + ". " + say("yy", 90)), (2, None), (3, "...")]
    runs = crf.language_runs(spark.createDataFrame(mixed, "doc_id long, text string"), model).collect()
    assert [(r.first_word, r.n_words, r.lang) for r in sorted(runs, key=lambda r: r.first_word)] == [(0, 70, "xx"), (70, 90, "yy")]
    assert model.transitions.trace() > 0 > model.transitions.sum() - model.transitions.trace()


def test_chains_cover_every_word_once():
    texts = ["a " * n for n in (0, 1, 63, 64, 65, 200)]
    words = crf.Words(pa.array(texts), crf.NO_LETTERS)
    chain, place = crf.chains(words.doc)
    assert len(set(zip(chain.tolist(), place.tolist()))) == 393 and place.max() == crf.CHAIN - 1
    assert all(len(set(words.doc[chain == c])) == 1 for c in set(chain.tolist()))
