from conftest import rows

from tidemark.operators import reports
from tidemark.streaming.events import events_per_minute, write_per_minute
from tidemark.workload.views import Views


def test_stream_agrees_with_the_batch_report(spark, small, folder):
    events = Views(spark, small).events
    events.write.parquet(f"{folder}/in")
    batch = events_per_minute(events)
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    query = write_per_minute(events_per_minute(stream), f"{folder}/out", f"{folder}/state")
    query.awaitTermination(120)
    done = spark.read.parquet(f"{folder}/out")
    # Append mode holds back the minutes that the watermark has not passed.
    assert done.count() > 0
    assert set(rows(done, "minute", "agent", "events")) <= set(rows(batch, "minute", "agent", "events"))
    latest = events.selectExpr("max(ts)").first()[0]
    report = reports.events_over_time(events, latest, hours=24 * 365)
    assert rows(report, "minute", "agent", "events") == rows(batch, "minute", "agent", "events")
