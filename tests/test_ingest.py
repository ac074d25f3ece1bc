"""Landing, change log and resource parsing."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.schemas import BRONZE_PAYLOADS, CLINICAL_RECORD, MissingColumns, conform
from carelake.sources import bronze, tables

AT = dt.datetime(2024, 3, 1, 12, 0)
CLAIM = "NTE*ward north*4 beds, one  free*~"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_text_files_land_unchanged_with_stable_ids(spark, tmp_path):
    (tmp_path / "a.txt").write_text(CLAIM + "\nsecond\n")
    (tmp_path / "b.txt").write_text(CLAIM + "\n")
    landed = bronze.land_text(bronze.text_lines(spark, str(tmp_path)), at=AT)
    assert rows(landed, "source_system_id", "raw_payload_json", "ingestion_timestamp", "ingestion_date") == [
        ("EDI_X12_BATCH", CLAIM, AT, AT.date()), ("EDI_X12_BATCH", CLAIM, AT, AT.date()),
        ("EDI_X12_BATCH", "second", AT, AT.date()),
    ]
    ids = rows(landed, "payload_id")
    assert len(set(ids)) == 3
    again = bronze.land_text(bronze.text_lines(spark, str(tmp_path)), at=dt.datetime(2025, 1, 1))
    assert rows(again, "payload_id") == ids
    assert conform(landed, BRONZE_PAYLOADS).schema.fieldNames() == BRONZE_PAYLOADS.fieldNames()


def test_landing_without_a_time_uses_the_clock(spark):
    landed = bronze.land_text(lines(spark, "x")).first()
    assert abs(landed["ingestion_timestamp"] - dt.datetime.now()) < dt.timedelta(days=1)


CHANGES = [
    '{"payload":{"op":"c","before":null,"after":{"id":"w-1","beds":"4"},"source":{"db":"wards","lsn":17}}}',
    '{"payload":{"op":"u","before":{"id":"w-0"},"after":{"id":"w-2","beds":"5"},"source":{"db":"wards"}}}',
    '{"payload":{"after":{"id":1,"n":{"x":2}},"source":{"db":"pg"},"op":"u"}}',
    '{"payload":{"before":{"id":"b"},"after":null,"source":{"db":"pg"},"op":"d"}}',
    '{"payload":{"after":{"id":"r1"},"op":"r"}}',
    "not json",
    "",
    '{"payload":{"after":"str","op":"c","source":{"db":"z"}}}',
]


def test_change_log(spark):
    changes = lines(spark, *CHANGES)
    assert rows(bronze.cdc_extract(changes), "payload_id", "source_system_id") == [
        ("1", "pg"), ("b", "pg"), ("w-1", "wards"), ("w-2", "wards"), (None, "z"),
    ]
    strict = bronze.cdc_extract(changes, strict_after=True)
    assert rows(strict, "payload_id", "source_system_id") == [
        ("1", "pg"), ("w-1", "wards"), ("w-2", "wards"), (None, "pg"), (None, "z"),
    ]
    assert rows(bronze.cdc_rejects(changes)) == [("",), ("not json",), (CHANGES[4],)]
    kept = ("c", "u", "d", "r")
    assert bronze.cdc_extract(changes, kept=kept).count() + bronze.cdc_rejects(changes, kept).count() == len(CHANGES)


def test_resources_keep_unreadable_lines(spark):
    got = bronze.stream_extract(lines(
        spark, '{"resourceType":"Patient","id":7,"payload":{"a":1}}',
        '{"resourceType":"Bed","free":true}', "bad",
    ), at=AT)
    assert rows(got, "payload_id", "source_system_id") == [
        ("7", "Patient"), (None, "Bed"), (None, None),
    ]


def test_binary_values_are_read_as_text(spark):
    got = bronze.stream_extract(lines(spark, '{"resourceType":"Patient","id":"p"}').select(
        F.col("value").cast("binary").alias("value")
    ))
    assert rows(got, "payload_id", "source_system_id") == [("p", "Patient")]


def test_flatten_gives_null_for_what_does_not_fit(spark):
    raw = spark.createDataFrame([
        ("1", '{"patient_id":"P1","patient_ssn":"1","patient_mrn":"M","admission_date":"2023-01-15","clinical_notes":"n"}'),
        ("2", '{"patient_id":5,"admission_date":"soon"}'),
        ("3", "bad"),
    ], "payload_id string, raw_payload_json string")
    flat = bronze.flatten_payload(raw, CLINICAL_RECORD)
    assert flat.columns == ["payload_id", *CLINICAL_RECORD.fieldNames()]
    assert rows(flat) == [
        ("1", "P1", "1", "M", dt.datetime(2023, 1, 15), "n"),
        ("2", "5", None, None, None, None),
        ("3", None, None, None, None, None),
    ]
    nested = bronze.flatten_payload(
        spark.createDataFrame([("1", '{"who":{"id":"P9"}}')], "payload_id string, raw_payload_json string"),
        T.StructType([T.StructField("pid", T.StringType())]), {"pid": "who.id"},
    )
    assert rows(nested) == [("1", "P9")]


def test_missing_columns_fail_when_the_plan_is_built(spark):
    with pytest.raises(MissingColumns):
        bronze.land_text(spark.createDataFrame([("x",)], "text string"))


def test_zone_tables(spark, tmp_path):
    tables.create_zone(spark, "bronze_test", str(tmp_path / "zone"))
    name = "bronze_test.raw_payloads"
    schema = T.StructType([*BRONZE_PAYLOADS, T.StructField("ingestion_date", T.DateType())])
    tables.create_table(spark, name, schema, partition_by=["ingestion_date"], location=str(tmp_path / "raw"))
    try:
        tables.append_table(bronze.land_text(lines(spark, "x", "y"), at=AT), name)
        assert tables.read_table(spark, name).count() == 2
        pruned = tables.read_table(spark, name).filter("ingestion_date = date '2024-03-02'")
        assert pruned.count() == 0
        tables.replace_table(tables.read_table(spark, name).groupBy("source_system_id").count(), "bronze_test.sizes")
        assert rows(tables.read_table(spark, "bronze_test.sizes")) == [("EDI_X12_BATCH", 2)]
        assert tables.read_table(spark, str(tmp_path / "raw"), "parquet").count() == 2
    finally:
        spark.sql("DROP DATABASE bronze_test CASCADE")


def test_replace_files_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    tables.replace_files(first, path, ["p"])
    tables.replace_files(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [(1, "a"), (3, "b")]
    tables.append_files(first, path, ["p"])
    assert spark.read.parquet(path).count() == 4


def test_equal_lines_of_a_file_have_their_own_ids(spark, tmp_path):
    """Whatever the splits; landing again gives the same ids, and a merge by id keeps all lines."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    lines = [f"claim {i % 7}" for i in range(400)]
    (inbox / "a.txt").write_text("\n".join(lines) + "\n")
    (inbox / "b.txt").write_text("\n".join(lines[:9]))
    (inbox / "empty.txt").write_text("")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    found = []
    try:
        for size in ("128m", "500b", "73b"):
            spark.conf.set(key, size)
            numbered = bronze.text_lines(spark, str(inbox))
            got = [(r["origin"].rsplit("/", 1)[1], r["position"], r["value"]) for r in numbered.collect()]
            assert sorted(got) == sorted([("a.txt", i, v) for i, v in enumerate(lines)] + [("b.txt", i, v) for i, v in enumerate(lines[:9])])
            found.append(rows(bronze.land_text(numbered), "payload_id"))
    finally:
        spark.conf.set(key, before)
    assert found[0] == found[1] == found[2] and len(set(found[0])) == 409
