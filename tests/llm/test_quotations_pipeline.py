import random
from collections import Counter, defaultdict

import corpus_pipeline
from conftest_llm import words
from pyspark.sql import functions as F

from sqlloom.llm import decontaminate, jaccard_join, language_crf, pu_quality, quotations
from sqlloom.llm.common import table
from sqlloom.llm.queries import op8_quotations
from test_jaccard_join import shingles
from test_tokens import check_packing

MESSAGES = "conv_id long, turn long, role string, text string"
THREAD = [
    (1, 0, "user", "Hello there. How are you?\nI have a question."),
    (1, 1, "assistant", "> How are\n> you?\n\nFine, thanks!"),
    (1, 2, "user", "Other topic starts here."),
    (1, 3, "user", "On Monday, Bob wrote:\n> > How are you?\n> Fine, thanks!\n\nGood to hear."),
    (1, 4, "assistant", "> I have a question.\nAsk it."),
    (1, 5, "user", "> Other topic starts here.\nok then"),
    (2, 0, "user", None),
    (2, 1, None, "> said in another conversation"),
    (2, 1, None, "> said in another conversation"),
    (3, 0, "user", "said in another conversation"),
    (None, 0, "user", "no conversation"),
    (3, None, "user", "no turn"),
    (4, 0, "user", "> quoted before it is said\nx y z"),
    (4, 1, "user", "quoted before it is said"),
]


def told(df):
    return quotations.link_replies(df).collect()


def test_thread(spark):
    got = {(r.conv_id, r.turn): r for r in told(spark.createDataFrame(THREAD, MESSAGES).selectExpr("*", "1 AS row", "2 AS n"))}
    one = {t: got[1, t] for t in range(6)}
    assert {t: r.parent_turn for t, r in one.items()} == {0: None, 1: 0, 2: None, 3: 1, 4: 0, 5: 2}
    assert {t: (r.root_turn, r.depth) for t, r in one.items()} == {0: (0, 0), 1: (0, 1), 2: (2, 0), 3: (0, 2), 4: (0, 1), 5: (2, 1)}
    assert [t for t, _ in sorted(one.items(), key=lambda x: x[1].position)] == [0, 1, 4, 3, 2, 5]
    assert one[3].text == "Good to hear." and one[1].text == "Fine, thanks!" and one[5].chat == "<|im_start|>user\nok then<|im_end|>\n"
    assert got[2, 1].parent_turn is None and got[2, 1].text == "" and got[4, 0].parent_turn is None
    assert got[None, 0].position is None and got[3, None].position is None


def test_positions_have_no_gaps_and_rows_stay(spark):
    rows = told(spark.createDataFrame(THREAD, MESSAGES))
    assert Counter((r.conv_id, r.turn, r.role) for r in rows) == Counter(m[:3] for m in THREAD)
    by = defaultdict(list)
    for r in rows:
        if r.position is not None:
            by[r.conv_id].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in by.values())
    assert told(spark.createDataFrame([], MESSAGES)) == []


def test_long_chain_of_replies(spark):
    rows = [(1, 0, "user", "line number zero.")] + [(1, i, "user", f"> line number {i - 1 or 'zero'}.\nline number {i}.") for i in range(1, 70)]
    got = sorted(told(spark.createDataFrame(rows, MESSAGES)), key=lambda r: r.turn)
    assert [(r.depth, r.root_turn, r.position) for r in got] == [(i, 0, i) for i in range(70)]


def test_query_keeps_every_message(spark, sf):
    source = table(spark, sf, "conversations").collect()
    quoted = spark.createDataFrame([(m.conv_id, m.turn, m.role, m.text) for m in source], MESSAGES)
    assert Counter((r.conv_id, r.turn, r.role, r.text) for r in op8_quotations(spark, sf).collect()) == Counter(tuple(m) for m in quoted.collect())


def test_quotes_made_from_the_table(spark, sf):
    """Each third message quotes the first lines of an earlier one of its conversation."""
    by = defaultdict(list)
    for m in table(spark, sf, "conversations").collect():
        by[m.conv_id].append(m)
    rows, parents = [], {}
    for conv, messages in by.items():
        messages.sort(key=lambda m: m.turn)
        for i, m in enumerate(messages):
            text = m.text or ""
            if i % 3 == 2 and messages[i - 2].text:
                text = "\n".join("> " + x for x in messages[i - 2].text.split("\n")) + "\n" + text
                parents[conv, m.turn] = messages[i - 2].turn
            rows.append((conv, m.turn, m.role, text))
    got = {(r.conv_id, r.turn): r.parent_turn for r in told(spark.createDataFrame(rows, MESSAGES))}
    assert parents and sum(got[k] == v for k, v in parents.items()) >= 0.98 * len(parents)
    assert all(v is None for k, v in got.items() if k not in parents)


# The pipeline


def test_stages_over_the_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == before.columns
        gone = before.exceptAll(docs).collect()
        assert docs.exceptAll(before).count() == 0
        kept = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            spoken = language_crf.label(before, language_crf.learn(before), "l", "s").where("l = 'und' OR s < 0.3")
            assert {r.doc_id for r in gone} == {r.doc_id for r in spoken.collect()}
        elif name == "quality":
            scored = pu_quality.score(before, pu_quality.learn(before, table(spark, sf, "labels")), "q")
            assert kept == {r.doc_id for r in scored.where(F.col("q") >= 0.7).collect()} and gone
        elif name == "near_duplicates":
            roots = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(before).collect()}
            assert kept == {d for d, c in roots.items() if d == c} and gone
        else:
            items = [" " + " ".join(words(i.text)) + " " for i in table(spark, sf, "benchmark").collect()]
            exact = {r.doc_id for r in before.collect() if any(i in " " + " ".join(words(r.text)) + " " for i in items)}
            found = {r.doc_id for r in decontaminate.contaminated(before, table(spark, sf, "benchmark")).collect()}
            assert exact <= found == {r.doc_id for r in gone} and found
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    check_packing([(r.doc_id, r.text) for r in docs.collect()], pieces, 4096)
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).drop("sequence_id", "offset").collect())) == Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens, p.curve_key) for p in pieces)


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej deklaracji bez względu na różnice rasy.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
]


def test_foreign_and_random_texts_go_and_clean_ones_stay(spark):
    sf, rnd = "/root/testdata/sf0.001", random.Random(3)
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    junk = [" ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 10))) for _ in range(60)) for _ in range(20)]
    planted = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(FOREIGN + junk)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs.unionByName(planted), sf).collect()}
    assert kept == {r.doc_id for r in docs.collect()}


def test_edge_rows_through_all_stages(spark, tmp_path, edge_docs, edge_rows):
    """Nulls, empty texts, repeated rows and clashing names pass; what goes goes for a reason."""
    for table_name in ("labels", "benchmark"):
        table(spark, "/root/testdata/sf0.001", table_name).write.parquet(str(tmp_path / f"{table_name}.parquet"))
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    left = docs.collect()
    assert {r.doc_id for r in left} <= {1, 4, 6, 8, None}
    texts = [(r.doc_id, r.text) for r in left if shingles(r.text)]
    assert len(texts) == len(set(texts))
    check_packing([(r.doc_id, r.text) for r in left], corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect(), 4096)


def test_empty_documents(spark, tmp_path, no_docs):
    for table_name in ("labels", "benchmark"):
        table(spark, "/root/testdata/sf0.001", table_name).write.parquet(str(tmp_path / f"{table_name}.parquet"))
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
