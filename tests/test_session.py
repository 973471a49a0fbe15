import os

from tidemark import session
from tidemark.session import (
    INITIAL_PARTITIONS,
    MEBIBYTE,
    SCAN_BYTES,
    scratch_path,
    size_for,
    sizing,
    stored_bytes,
)

TEBIBYTE = 1 << 40


def test_sizing_keeps_partitions_at_their_size():
    assert sizing(1)[INITIAL_PARTITIONS] == "200"
    for tebibytes in (1, 24, 100, 1000):
        assert sizing(tebibytes * TEBIBYTE)[INITIAL_PARTITIONS] == str(2048 * tebibytes)


def test_scan_tasks_grow_where_they_would_be_too_many():
    assert sizing(TEBIBYTE)[SCAN_BYTES] == str(128 * MEBIBYTE)
    assert 500 < int(sizing(100 * TEBIBYTE)[SCAN_BYTES]) / MEBIBYTE < 530


def test_a_run_is_sized_by_its_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    assert stored_bytes(spark, path) == 0
    spark.range(10).write.parquet(path)
    assert stored_bytes(spark, path) > 100
    size_for(spark, path)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr("tidemark.session.stored_bytes", lambda *_: 10 * TEBIBYTE)
    size_for(spark, path)
    assert spark.conf.get(INITIAL_PARTITIONS) == "20480"
    monkeypatch.undo()
    size_for(spark, path)
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_scratch_lies_in_the_shared_folder(spark):
    path = scratch_path(spark, "test")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_path(spark, "test")


def test_scratch_is_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "SCRATCH", [])
    path = scratch_path(spark, "test")
    spark.range(3).write.parquet(path)
    session.remove_scratch()
    assert not os.path.exists(path) and session.SCRATCH == []


def test_session_pins_its_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
