from pyspark.sql import functions as F

from sqlloom.plans import jobs, views
from sqlloom.streaming.screening import screened_stream, write_screened


def test_stream_gives_the_batch_result(spark, sf, tmp_path):
    source = views.corpus(spark, sf)
    incoming, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    halves = [source.where(F.col("example_id") < 700), source.where(F.col("example_id") >= 700)]
    for half in halves:
        half.write.mode("append").json(incoming)
        query = write_screened(screened_stream(spark, incoming), out, checkpoint)
        assert query.awaitTermination(120)
    columns = ["example_id", "drop_reason", "sql_prompt", "sql", "ddl"]
    streamed = spark.read.parquet(out).select(columns)
    batch = jobs.screen(source).select(columns)
    assert streamed.count() == source.count()
    assert streamed.exceptAll(batch).count() == 0
