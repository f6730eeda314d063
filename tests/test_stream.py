"""Stream trigger (S9, K7, F3, T1, T2, T4, X7) with a watched directory."""

from tagwerk.sinks.notify import emit_file
from tagwerk.sources.notifications import file_notifications
from tagwerk.streaming.trigger import matching_messages, start_refresh_stream


def run(spark, inbox, ckpt, calls, **kw):
    q = start_refresh_stream(spark, file_notifications(spark, inbox),
                             lambda s: calls.append(1), checkpoint=ckpt, available_now=True, **kw)
    q.awaitTermination()


def test_one_refresh_per_batch_and_restart(spark, scratch):
    inbox, ckpt, calls = f"{scratch}/inbox", f"{scratch}/ckpt", []
    emit_file(spark, inbox)
    emit_file(spark, inbox)
    emit_file(spark, inbox, "hello")
    run(spark, inbox, ckpt, calls)
    assert calls == [1]                      # two matching messages, one batch, one run
    run(spark, inbox, ckpt, calls)
    assert calls == [1]                      # restart with the same checkpoint: nothing new
    emit_file(spark, inbox, "hello")
    run(spark, inbox, ckpt, calls)
    assert calls == [1]                      # other words are ignored
    emit_file(spark, inbox)
    run(spark, inbox, ckpt, calls)
    assert calls == [1, 1]


def test_run_at_start(spark, scratch):
    calls = []
    emit_file(spark, f"{scratch}/inbox", "hello")
    run(spark, f"{scratch}/inbox", f"{scratch}/ckpt", calls, run_at_start=True)
    assert calls == [1]


def test_matching_messages_bytes_and_text(spark):
    df = spark.createDataFrame([("new_data_available",), ("x",)], "value string")
    assert matching_messages(df.selectExpr("cast(value as binary) as value")).count() == 1
    assert matching_messages(df).count() == 1


def test_kafka_sink_needs_connector(spark):
    from tagwerk.sinks.notify import emit_kafka
    try:
        emit_kafka(spark, "localhost:9092", "spark_notification")
    except Exception as e:  # connector jar not on this classpath; no broker is contacted
        assert "kafka" in str(e).lower()
