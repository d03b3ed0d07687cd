from tessera.functions.scoring import predicted_arrival_hhmm
from tessera.session import scratch_path
from tessera.streaming.scoring import start_scoring


def test_stream_scoring_matches_rule_and_is_restartable(spark):
    rows = [(i, (i * 37) % 2400, float(i % 90) - 10.5) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, sched_arr_time int, dep_delay double")
    src, sink, ckpt = (scratch_path(spark, p) for p in ("t-src", "t-sink", "t-ckpt"))
    df.write.parquet(src)
    q = start_scoring(spark, src, df.schema, sink, ckpt)
    q.awaitTermination()
    # a second run over the same checkpoint finds nothing new: no duplicates
    q2 = start_scoring(spark, src, df.schema, sink, ckpt)
    q2.awaitTermination()
    out = {r.id: r.pred_arr_time for r in spark.read.parquet(sink).collect()}
    assert len(out) == 500 and spark.read.parquet(sink).count() == 500
    batch = df.select("id", predicted_arrival_hhmm("sched_arr_time", "dep_delay").alias("p")).collect()
    assert out == {r.id: r.p for r in batch}
