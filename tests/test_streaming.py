"""Streams give what a batch over the same rows gives, and restarts add nothing."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake.operators.merge import KEY, latest_per_key, merge_frames
from carelake.sources import bronze, streams
from carelake.sources.parts import read_parts
from carelake.streaming import sinks

AT = dt.datetime(2024, 1, 1)


def put(folder, name, *values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(values) + "\n")


RESOURCES = [f'{{"resourceType":"Patient","id":{i},"payload":"x"}}' for i in range(20)]


def test_append_restart_and_late_files(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(inbox, "1.txt", *RESOURCES[:10])
    put(inbox, "2.txt", *RESOURCES[10:], "bad")

    def run():
        stream = bronze.stream_extract(streams.file_lines(spark, str(inbox), files_per_batch=1), at=AT)
        query = sinks.start_append(stream, out, checkpoint, trigger=None)
        query.awaitTermination()
        return query

    run()
    batch = bronze.stream_extract(bronze.text_lines(spark, str(inbox)), at=AT)
    assert rows(spark.read.parquet(out)) == rows(batch)
    run()
    assert rows(spark.read.parquet(out)) == rows(batch)
    put(inbox, "3.txt", '{"resourceType":"Observation","id":"late"}')
    run()
    assert spark.read.parquet(out).count() == 22


def test_landing_and_change_log_on_a_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.txt", '{"payload":{"after":{"id":"1"},"source":{"db":"pg"},"op":"u"}}', "bad")
    for number, operator in enumerate((lambda d: bronze.cdc_extract(d, at=AT), lambda d: bronze.land_text(d, at=AT))):
        out = str(tmp_path / f"out{number}")
        stream = operator(streams.file_lines(spark, str(inbox)))
        sinks.start_append(stream, out, f"{out}-check", trigger=None).awaitTermination()
        expected = operator(bronze.text_lines(spark, str(inbox)).drop("position"))  # a stream has none
        assert rows(spark.read.schema(expected.schema).parquet(out)) == rows(expected)


def test_partitioned_append_and_table(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "1.txt", "a", "b")
    landed = bronze.land_text(streams.file_lines(spark, str(inbox)), at=AT)
    out = str(tmp_path / "out")
    sinks.start_append(landed, out, f"{out}-check", trigger=None, partition_by=["ingestion_date"]).awaitTermination()
    assert (tmp_path / "out" / "ingestion_date=2024-01-01").is_dir()
    try:
        sinks.start_append_table(landed, "stream_table", f"{out}-check2", trigger=None).awaitTermination()
        assert spark.table("stream_table").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS stream_table")


def test_counts_follow_new_rows(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "counts")
    put(inbox, "1.txt", "s1,ida", "s2,ida", "s3,ida", "s4,otto", "s5,uma")

    def run():
        lines = streams.file_lines(spark, str(inbox), files_per_batch=1)
        stream = lines.select(
            F.split("value", ",")[0].alias("condition_occurrence_id"), F.split("value", ",")[1].alias("person_id")
        )
        sinks.start_counts(stream, out, f"{out}-check", trigger=None, parts=4).awaitTermination()
        return rows(read_parts(spark, out, "person_id").filter("admission_count > 1"))

    assert run() == [("ida", 3)]
    put(inbox, "2.txt", "s6,uma", "s7,ida")
    assert run() == [("ida", 4), ("uma", 2)]
    assert run() == [("ida", 4), ("uma", 2)]


def test_merge_of_a_stream_equals_the_batch_merges(spark, tmp_path):
    schema = "condition_occurrence_id string, person_id string, updated_at timestamp, cdc_op string"
    day = lambda n: dt.datetime(2023, 1, n)
    first = spark.createDataFrame([("A", "1", day(1), "c"), ("B", "1", day(1), "c"), ("B", "2", day(2), "u")], schema)
    second = spark.createDataFrame([("A", "9", day(3), "u"), ("B", "2", day(3), "d"), ("C", "3", day(3), "c")], schema)
    inbox, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "check")

    def run():
        stream = streams.file_rows(spark, inbox, first.schema, files_per_batch=1)
        sinks.start_merge(stream, table, checkpoint, trigger=None, parts=4).awaitTermination()
        return rows(read_parts(spark, table, KEY))

    first.coalesce(1).write.mode("append").parquet(inbox)
    after_first = rows(merge_frames(first.limit(0), first))
    assert run() == after_first == rows(latest_per_key(first))
    second.coalesce(1).write.mode("append").parquet(inbox)
    expected = rows(merge_frames(latest_per_key(first), second))
    assert run() == expected
    assert run() == expected


def test_streams_and_batches_land_in_one_bronze(spark, tmp_path):
    inbox, lake = tmp_path / "in", str(tmp_path / "lake")
    put(inbox, "1.txt", *RESOURCES[:5])
    bronze.land(bronze.land_text(bronze.text_lines(spark, str(inbox)), at=AT), lake, "files", batch=0)

    def run():
        stream = bronze.stream_extract(streams.file_lines(spark, str(inbox), files_per_batch=1), at=AT)
        sinks.start_landing(stream, lake, "stream", str(tmp_path / "check"), trigger=None).awaitTermination()
        return rows(bronze.landed(spark, lake).groupBy("feed").count())

    assert run() == [("files", 5), ("stream", 5)]
    put(inbox, "2.txt", *RESOURCES[5:7])
    assert run() == [("files", 5), ("stream", 7)]
    bronze.land(bronze.land_text(bronze.text_lines(spark, str(inbox)), at=AT), lake, "files", batch=0)
    assert run() == [("files", 7), ("stream", 7)]
    assert rows(bronze.landed(spark, lake), "ingestion_date")[0] == (AT.date(),)


def test_a_folder_of_files_streams_like_one_file(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as string) p")
    df.repartition(4).write.parquet(str(tmp_path / "orders.parquet"))
    out = str(tmp_path / "out")
    stream = streams.file_rows(spark, str(tmp_path / "orders*.parquet"), df.schema)
    sinks.start_append(stream, out, f"{out}-check", trigger=None).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(df)


def test_simulated_payloads_have_the_bronze_columns(spark):
    stream = streams.simulated_payloads(spark, 5)
    assert stream.isStreaming
    assert stream.columns == ["payload_id", "source_system_id", "raw_payload_json", "ingestion_timestamp"]
    query = stream.writeStream.format("noop").trigger(processingTime="1 second").start()
    query.awaitTermination(2)
    query.stop()
    assert not query.isActive


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_lines(spark, "nowhere:9092", "topic")


def test_routing_in_batches_and_a_stopped_query(spark, tmp_path):
    schema = "condition_occurrence_id string, person_id string, condition_concept_id int"
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    good, bad = [("a", "p", 1), ("b", "p", None)], [("c", None, 1), (None, "p", 1), ("d", "p", -1)]

    def run(on_fail):
        stream = streams.file_rows(spark, inbox, spark.createDataFrame([], schema).schema, files_per_batch=1)
        sinks.start_routing(stream, out, f"{out}-check", on_fail=on_fail, trigger=None).awaitTermination()

    spark.createDataFrame(good, schema).coalesce(1).write.mode("append").parquet(inbox)
    run("raise")
    assert rows(spark.read.parquet(f"{out}/valid"), "condition_occurrence_id") == [("a",), ("b",)]
    spark.createDataFrame(bad + [("e", "p", 5)], schema).coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):
        with pytest.raises(Exception, match="QualityBreach"):
            run("raise")
        assert spark.read.parquet(f"{out}/valid").count() == 2
    run("route")  # the batch comes again
    run("route")
    assert rows(spark.read.parquet(f"{out}/valid"), "condition_occurrence_id") == [("a",), ("b",), ("e",)]
    dead = spark.read.parquet(f"{out}/dead_letters")
    assert rows(dead, "condition_occurrence_id", F.array_join("reasons", ",")) == [
        ("c", "complete(person_id)"), ("d", "non_negative(condition_concept_id)"), (None, "complete(condition_occurrence_id)")]
    with pytest.raises(ValueError, match="on_fail"):
        run("stop")
