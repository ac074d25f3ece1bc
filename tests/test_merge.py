"""Keyed merge: examples, the full truth table, and random cases against a MERGE."""

import datetime as dt
import random

import duckdb
import pytest
from conftest import rows

from carelake.operators import merge as m
from carelake.sources.snapshots import read_snapshot, write_snapshot

SCHEMA = "condition_occurrence_id string, person_id string, condition_concept_id int, updated_at timestamp, cdc_op string"
T1, T2, T3 = (dt.datetime(2019, 8, d, 7) for d in (4, 9, 30))
TARGET = [
    ("ward-1", "ida", 7, T1, "c"), ("ward-2", "ida", 7, T2, "u"), ("ward-3", "otto", 8, T1, "c"),
    ("ward-4", "otto", 8, T3, "c"),
]
UPDATES = [
    ("ward-2", "uma", 9, T3, "u"), ("ward-3", "otto", 8, T3, "d"), ("ward-4", "otto", 1, T2, "u"),
    ("ward-5", "pia", 4, T1, None),
]
AFTER = [TARGET[0], UPDATES[0], TARGET[3], UPDATES[3]]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_update_delete_insert_and_replay(spark):
    once = m.merge_frames(frame(spark, TARGET), frame(spark, UPDATES))
    assert rows(once) == AFTER
    late = [u for u in UPDATES if u[4] != "d"]
    assert rows(m.merge_frames(frame(spark, AFTER), frame(spark, late))) == AFTER


@pytest.mark.parametrize("op", ["c", "u", "d", None, "x"])
def test_truth_table(spark, op):
    times = {"newer": (T1, T2), "equal": (T1, T1), "older": (T2, T1), "no_t": (None, T2), "no_s": (T1, None)}
    target = [(f"K-{n}", "t", 1, t, "c") for n, (t, _) in times.items()]
    changes = [(f"K-{n}", "s", 2, s, op) for n, (_, s) in times.items()] + [("NEW", "s", 2, T2, op)]
    got = {r[0]: r[1] for r in m.merge_frames(frame(spark, target), frame(spark, changes)).collect()}
    expected = {f"K-{n}": "t" for n in times}
    if op in ("u", None):
        expected["K-newer"] = "s"
    if op == "d":
        del expected["K-newer"]
    if op in ("c", "u", None):
        expected["NEW"] = "s"
    assert got == expected


def test_random_cases_equal_a_merge_statement(spark):
    rng = random.Random(7)
    for _ in range(3):
        keys = [f"K{i}" for i in range(40)]

        def some(n, ops, nulls):
            picked = rng.sample(keys, n)
            data = [(k, rng.choice("ab"), rng.randrange(9), rng.choice([None, T1, T2, T3]), rng.choice(ops)) for k in picked]
            return data + [(None, "z", i, T1, rng.choice(ops)) for i in range(nulls)]

        target, changes = some(25, ["c", "u"], 1), some(25, ["c", "u", "d", None, "x"], 4)
        con = duckdb.connect()
        for name, data in (("t", target), ("s", changes)):
            con.execute(f"CREATE TABLE {name} (condition_occurrence_id VARCHAR, person_id VARCHAR, condition_concept_id INT, updated_at TIMESTAMP, cdc_op VARCHAR)")
            con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?, ?)", data)
        con.execute("""
            MERGE INTO t USING s ON t.condition_occurrence_id = s.condition_occurrence_id
            WHEN MATCHED AND s.cdc_op = 'd' AND s.updated_at > t.updated_at THEN DELETE
            WHEN MATCHED AND (s.cdc_op = 'u' OR s.cdc_op IS NULL) AND s.updated_at > t.updated_at THEN UPDATE SET
                person_id = s.person_id, condition_concept_id = s.condition_concept_id,
                updated_at = s.updated_at, cdc_op = s.cdc_op
            WHEN NOT MATCHED AND (s.cdc_op = 'c' OR s.cdc_op = 'u' OR s.cdc_op IS NULL) THEN INSERT
        """)
        key = lambda t: tuple((v is None, str(v)) for v in t)
        expected = sorted(con.execute("SELECT * FROM t").fetchall(), key=key)
        for dedupe in (True, False):
            got = m.merge_frames(frame(spark, target), frame(spark, changes), null_keys="insert", dedupe=dedupe)
            assert rows(got) == expected


def test_a_null_key_fails_the_merge(spark):
    with pytest.raises(Exception, match="null condition_occurrence_id"):
        m.merge_frames(frame(spark, TARGET), frame(spark, [(None, "P", 1, T1, "c")])).collect()
    with pytest.raises(Exception, match="null condition_occurrence_id"):
        m.merge_frames(frame(spark, TARGET), frame(spark, [(None, "P", 1, T1, "c")]), dedupe=False).collect()


def test_latest_per_key(spark):
    versions = [
        ("A", "p", 1, T1, "c"), ("A", "p", 2, T2, "u"), ("A", "p", 3, T2, "d"), ("A", "p", 4, None, "u"),
        ("B", "p", 5, None, None), ("B", "p", 6, None, "c"), (None, "p", 7, T1, "c"), (None, "p", 7, T1, "c"),
    ]
    assert rows(m.latest_per_key(frame(spark, versions)), "condition_occurrence_id", "condition_concept_id") == [
        ("A", 3), ("B", 5), (None, 7), (None, 7),
    ]


def test_tombstones_stop_a_late_update(spark):
    delete, late = [("ward-3", "otto", 8, T3, "d")], [("ward-3", "otto", 1, T2, "u")]
    plain = m.merge_frames(m.merge_frames(frame(spark, TARGET), frame(spark, delete)), frame(spark, late))
    assert "ward-3" in {r[0] for r in plain.collect()}
    kept = m.merge_frames(frame(spark, TARGET), frame(spark, delete), tombstones=True)
    after = m.merge_frames(kept, frame(spark, late), tombstones=True)
    assert rows(m.live_rows(after), "condition_occurrence_id") == [("ward-1",), ("ward-2",), ("ward-4",)]
    again = [("ward-3", "otto", 5, T3 + dt.timedelta(days=1), "c")]
    revived = m.live_rows(m.merge_frames(after, frame(spark, again), tombstones=True))
    assert rows(revived, "condition_occurrence_id", "condition_concept_id") == [
        ("ward-1", 7), ("ward-2", 7), ("ward-3", 5), ("ward-4", 8),
    ]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_snapshot(spark, path) is None
    assert m.merge_snapshot(spark, path, frame(spark, TARGET)) == 1
    assert m.merge_snapshot(spark, path, frame(spark, UPDATES)) == 2
    assert rows(read_snapshot(spark, path)) == AFTER
    # A later copy without its success mark is not read, and is written over.
    frame(spark, TARGET).write.parquet(f"{path}/snapshot=3")
    (tmp_path / "table" / "snapshot=3" / "_SUCCESS").unlink()
    assert rows(read_snapshot(spark, path)) == AFTER
    assert write_snapshot(frame(spark, TARGET), path) == 3
    assert rows(read_snapshot(spark, path)) == TARGET


def test_old_snapshots_are_removed_on_request(spark, tmp_path):
    path = str(tmp_path / "table")
    for _ in range(3):
        write_snapshot(frame(spark, TARGET), path)
    assert write_snapshot(frame(spark, UPDATES), path, keep=2) == 4
    assert sorted(p.name for p in (tmp_path / "table").iterdir()) == ["snapshot=3", "snapshot=4"]
    assert rows(read_snapshot(spark, path)) == rows(frame(spark, UPDATES))
    with pytest.raises(ValueError):
        write_snapshot(frame(spark, TARGET), path, keep=0)


def test_plain_files_refuse_a_row_level_merge(spark):
    frame(spark, TARGET).write.mode("overwrite").saveAsTable("plain_target")
    try:
        with pytest.raises(Exception, match="MERGE"):
            m.merge_into(frame(spark, UPDATES), "plain_target")
    finally:
        spark.sql("DROP TABLE plain_target")
