from pyspark.sql import functions as F

from reelkit.streaming import score_stream


def test_score_stream_applies_batch_scorer(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 10), (2, 11)], "user_id long, movie_id long").write.parquet(src)
    stream = spark.readStream.schema("user_id long, movie_id long").parquet(src)
    out = str(tmp_path / "out")
    q = score_stream(stream, lambda b: b.withColumn("pred", F.lit(3.0)), out, str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(out).orderBy("user_id").collect()
    assert [(r.user_id, r.pred) for r in got] == [(1, 3.0), (2, 3.0)]
