import pytest
from pyspark.sql import functions as F

from meterlake.session import materialize, scratch_dir
from meterlake.sinks import files
from meterlake.sinks.counters import Aggregate, Watch, load_counters, save_counters, summed
from meterlake.sinks.snapshots import create_snapshot_if_missing, publish, read_snapshot, refresh, snapshot_exists
from meterlake.sinks.tables import (
    append,
    create_if_missing,
    overwrite_partitions,
    read_table,
    restate_partitions,
    table_exists,
)


def table(spark, *pairs):
    return spark.createDataFrame(list(pairs), "d int, v string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    append(table(spark, (1, "a")), path, "d")
    append(table(spark, (1, "b")).withColumn("extra", F.lit(5)), path, "d")
    assert table_exists(spark, path)
    got = read_table(spark, path).select("d", "v", "extra")
    assert sorted((r.v, r.extra) for r in got.collect()) == [("a", None), ("b", 5)]


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    append(table(spark, (1, "a"), (2, "b")), path, "d")
    for _ in range(2):
        overwrite_partitions(table(spark, (2, "B"), (3, "c")), path, "d")
        assert rows(read_table(spark, path).select("d", "v")) == [(1, "a"), (2, "B"), (3, "c")]


def test_restate_reads_what_it_replaces(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    append(table(spark, (1, "a"), (2, "b")), path, "d")
    doubled = read_table(spark, path).filter("d = 2").select("d", F.concat("v", "v").alias("v"))
    restate_partitions(doubled, path, "d", stage)
    assert rows(read_table(spark, path).select("d", "v")) == [(1, "a"), (2, "bb")]
    assert not files.exists(spark, stage)


def test_restate_resumes_from_its_stage(spark, tmp_path):
    """A run that died after staging, with the partition already gone, loses nothing."""
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    append(table(spark, (1, "a"), (2, "b")), path, "d")
    plan = read_table(spark, path).filter("d = 2").select("d", "v")
    plan.write.parquet(stage)
    files.remove(spark, f"{path}/d=2")
    restate_partitions(read_table(spark, path).filter("d = 2").select("d", "v"), path, "d", stage)
    assert rows(read_table(spark, path).select("d", "v")) == [(1, "a"), (2, "b")]


def test_create_if_missing_keeps_what_is_there(spark, tmp_path):
    for create, read, name in (
        (create_if_missing, read_table, "a"),
        (create_snapshot_if_missing, read_snapshot, "b"),
    ):
        path = str(tmp_path / name)
        create(table(spark, (1, "a")), path)
        create(table(spark, (2, "b")), path)
        assert rows(read(spark, path)) == [(1, "a")]


def test_snapshot_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    refresh(table(spark, (1, "a")), path)
    for _ in range(3):
        refresh(read_snapshot(spark, path).withColumn("v", F.concat("v", F.lit("!"))), path)
    assert rows(read_snapshot(spark, path)) == [(1, "a!!!")]
    assert files.names(spark, path) == ["v=3", "v=4"]


def test_unfinished_snapshot_is_ignored(spark, tmp_path):
    path = str(tmp_path / "s")
    refresh(table(spark, (1, "a")), path)
    table(spark, (9, "broken")).write.parquet(f"{path}/v=2")
    files.remove(spark, f"{path}/v=2/_SUCCESS")
    assert rows(read_snapshot(spark, path)) == [(1, "a")] and snapshot_exists(spark, path)
    refresh(table(spark, (2, "b")), path)
    assert rows(read_snapshot(spark, path)) == [(2, "b")]


def test_scratch_is_under_the_shared_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    stored = materialize(table(spark, (1, "a")))
    assert rows(stored) == [(1, "a")] and "Scan parquet" in stored._jdf.queryExecution().toString()


def test_counters_fill_while_writing(spark, tmp_path):
    watch = Watch({"missing": "v IS NULL", "least": Aggregate("min(v)")})
    watch.on(table(spark, (1, "a"), (2, None))).write.parquet(str(tmp_path / "c"))
    assert watch.counts == {"total": 2, "missing": 1, "least": "a"}
    empty = Watch({"missing": "v IS NULL"})
    empty.on(table(spark, (1, "a")).limit(0)).write.parquet(str(tmp_path / "e"))
    assert empty.counts == {"total": 0, "missing": 0}


def test_counters_are_replaced_by_part(spark, tmp_path):
    place = str(tmp_path / "t")
    assert load_counters(spark, place) == {}
    save_counters(spark, place, {"a": {"total": 1}, "b": {"total": 2}})
    save_counters(spark, place, {"b": {"total": 5}})
    assert summed(load_counters(spark, place), ["total", "none"]) == {"total": 6, "none": 0}
    # A text whose writing broke off is passed over.
    files.write_text(spark, f"{place}.counters/9.json", '{"a": {"tot')
    assert summed(load_counters(spark, place), ["total"]) == {"total": 6}
    save_counters(spark, place, {"all": {"total": 3}}, keep_others=False)
    assert load_counters(spark, place) == {"all": {"total": 3}}


def test_a_staged_table_is_published_once(spark, tmp_path):
    staged, path = str(tmp_path / "stage"), str(tmp_path / "t")
    refresh(table(spark, (0, "old")), path)
    table(spark, (1, "a")).write.parquet(staged)
    publish(spark, staged, path)
    publish(spark, staged, path)
    assert rows(read_snapshot(spark, path)) == [(1, "a")] and not files.exists(spark, staged)
