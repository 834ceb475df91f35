import json

import pytest
from pyspark.sql import functions as F

from sqlloom.sources import quarantine as Q, readers

GOOD = [{"db_id": "d", "question": f"q{i}", "query": f"SELECT {i}"} for i in range(5)]


def write(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part-0.json").write_text(text)
    return str(folder)


def lines(rows):
    return "".join(json.dumps(r) + "\n" for r in rows)


def test_clean_lines_read_as_before(spark, tmp_path):
    path = write(tmp_path, "clean", lines(GOOD))
    read = Q.read_json_checked(spark, path, readers.EXAMPLES)
    assert (read.rows, read.bad_rows) == (5, 0)
    assert sorted(r.question for r in read.good.collect()) == [f"q{i}" for i in range(5)]
    assert read.good.columns == readers.EXAMPLES.fieldNames()


def test_truncated_lines_raise_by_default(spark, tmp_path):
    path = write(tmp_path, "cut", lines(GOOD) + '{"db_id": "d", "quest')
    with pytest.raises(Q.MalformedSourceError, match="1 of 6 records"):
        Q.read_json_checked(spark, path, readers.EXAMPLES)


def test_counted_by_file_and_quarantined(spark, tmp_path):
    clean = write(tmp_path, "a", lines(GOOD))
    # Spark reads any JSON value of a string field as its text, so only lines that do not parse are bad.
    broken = write(tmp_path, "b", lines(GOOD[:2]) + "not json\n" + '{"db_id": "d", "question": \n')
    out = str(tmp_path / "quarantine")
    read = Q.read_json_checked(spark, [clean, broken], readers.EXAMPLES, policy=Q.MalformedPolicy(max_bad_share=0.5, quarantine_path=out))
    by_file = {r[Q.FILE].rsplit("/", 2)[-2]: (r.rows, r.bad_rows) for r in read.counts.collect()}
    assert by_file == {"a": (5, 0), "b": (4, 2)}
    assert read.good.count() == 7
    records = spark.read.parquet(f"{out}/records")
    assert records.count() == 2 and records.where(F.col("record") == "not json").count() == 1
    assert spark.read.parquet(f"{out}/counts").count() == 2


def test_share_above_the_policy_raises_and_names_the_file(spark, tmp_path):
    broken = write(tmp_path, "b", lines(GOOD[:1]) + "x\ny\n")
    with pytest.raises(Q.MalformedSourceError, match="/b/part-0.json: 2 of 3"):
        Q.read_json_checked(spark, broken, readers.EXAMPLES, policy=Q.MalformedPolicy(max_bad_share=0.5))


def test_cut_off_array_file_is_one_bad_record(spark, tmp_path):
    whole = write(tmp_path, "whole", json.dumps(GOOD))
    cut = write(tmp_path, "cut", json.dumps(GOOD)[:-20])
    read = Q.read_json_checked(spark, [whole, cut], readers.EXAMPLES, lines=False, policy=Q.MalformedPolicy(max_bad_share=1.0))
    assert read.good.count() == 5 and read.bad_rows == 1


def test_readers_take_the_policy(spark, tmp_path):
    path = write(tmp_path, "block", lines([{"question": "q", "sql": "s"}]) + "{broken\n")
    assert readers.read_blocklist(spark, path, lines=True).count() == 2  # without a policy: a row of nulls
    with pytest.raises(Q.MalformedSourceError):
        readers.read_blocklist(spark, path, lines=True, policy=Q.MalformedPolicy())
    assert readers.read_blocklist(spark, path, lines=True, policy=Q.MalformedPolicy(max_bad_share=0.5)).count() == 1


def test_empty_folder(spark, tmp_path):
    path = write(tmp_path, "empty", "")
    read = Q.read_json_checked(spark, path, readers.EXAMPLES)
    assert (read.rows, read.bad_rows, read.good.count()) == (0, 0, 0)


def test_own_column_name_is_refused(spark, tmp_path):
    from pyspark.sql import types as T

    with pytest.raises(ValueError):
        Q.read_json_checked(spark, str(tmp_path), T.StructType([T.StructField(Q.CORRUPT, T.StringType())]))
