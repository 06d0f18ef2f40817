import datetime as dt
import json
import time

import pytest
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from meterlake.sources.schemas import common_type, evolve_schema, infer_or_load_schema, load_schema
from meterlake.streaming.bronze import ingest_csv, ingest_versions, read_bronze
from meterlake.sinks.snapshots import read_snapshot

NOW = dt.datetime(2024, 2, 1, 6)


class Landing:
    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.source = base / "landing"
        self.source.mkdir()

    def put(self, name, *lines):
        (self.source / name).write_text("\n".join(lines) + "\n")

    def run(self, **more):
        b = self.base
        ingest_csv(self.spark, str(self.source), f"{b}/bronze", f"{b}/store", f"{b}/ckpt", "run", ingested_at=NOW, **more)
        return read_bronze(self.spark, f"{b}/bronze", f"{b}/store")


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_columns_are_mapped_by_name(landing):
    landing.put("a.csv", "id,meter,value", "1,0,1.5")
    landing.put("b.csv", "value,id,meter", "2.5,2,1")
    landing.put("empty.csv")
    landing.put("_hidden.csv", "id", "9")
    got = landing.run()
    assert sorted((r.id, r.meter, r.value) for r in got.collect()) == [(1, 0, 1.5), (2, 1, 2.5)]
    row = got.filter("id = 1").first()
    assert row.source_file_name.endswith("/a.csv") and row.batch_id == "run"
    assert row.ingestion_timestamp == NOW and row.ingestion_date == NOW.date()


def test_new_column_in_a_later_run(landing, spark):
    landing.put("a.csv", "id,value", "1,1.5")
    landing.run()
    landing.put("b.csv", "id,flag,VALUE", "2,yes,2.5")
    got = landing.run()
    assert sorted((r.id, r.value, r.flag) for r in got.collect()) == [(1, 1.5, None), (2, 2.5, "yes")]
    assert load_schema(spark, f"{landing.base}/store").names == ["id", "value", "flag"]


def test_misfit_value_is_rescued(landing):
    landing.put("a.csv", "id,value", "1,10", "2,20")
    landing.run()
    landing.put("b.csv", "id,value", "3,oops", "4,40")
    rows = {r.id: r for r in landing.run().collect()}
    assert (rows[3].value, json.loads(rows[3]._rescued_data)) == (None, {"value": "oops"})
    assert (rows[4].value, rows[4]._rescued_data) == (40, None)


def test_every_misfit_of_a_line_is_rescued_by_name(landing):
    landing.put("a.csv", "id,value,at,note", "1,10,2024-01-01 05:00:00,x")
    landing.run()
    landing.put("b.csv", "note,at,value,id", 'hi,never,ten,2', "short,2024-01-02 00:00:00", ' ,"", , 4', "a,b,c,5,more")
    rows = {r.id: r for r in landing.run().collect()}
    assert json.loads(rows[2]._rescued_data) == {"value": "ten", "at": "never"} and rows[2].note == "hi"
    assert (rows[4].value, rows[4].at, rows[4]._rescued_data) == (None, None, None)
    assert json.loads(rows[None]._rescued_data) == {"_line": "short,2024-01-02 00:00:00"}
    assert json.loads(rows[5]._rescued_data) == {"value": "c", "at": "b", "_line": "a,b,c,5,more"}


def test_types_widen_without_losing_a_value(landing, spark):
    landing.put("a.csv", "id,value,big", "1,10,1", "2,20,2")
    assert [f.dataType.simpleString() for f in landing.run(on_misfit="widen").schema.fields[:3]] == ["int", "int", "int"]
    landing.put("b.csv", "id,value,big", f"3,2.5,{2**40}", "4,many,5")
    got = landing.run(on_misfit="widen")
    assert [f.dataType.simpleString() for f in got.schema.fields[:3]] == ["int", "double", "bigint"]
    rows = {r.id: r for r in got.collect()}
    assert [rows[i].value for i in (1, 2, 3, 4)] == [10.0, 20.0, 2.5, None]
    assert (rows[3].big, json.loads(rows[4]._rescued_data)) == (2**40, {"value": "many"})
    landing.put("c.csv", "id,value,big", "5,lots,1.5")
    got = landing.run(on_misfit="widen_to_text")
    assert [f.dataType.simpleString() for f in got.schema.fields[:3]] == ["int", "string", "double"]
    rows = {r.id: r for r in got.collect()}
    assert [rows[i].value for i in (1, 3, 5)] == ["10", "2.5", "lots"]
    assert [rows[i].big for i in (1, 3, 5)] == [1.0, float(2**40), 1.5]
    # Files of each type stay what they were.
    assert sorted(p.name for p in (landing.base / "bronze").iterdir()) == ["types=0", "types=1", "types=2"]
    landing.put("d.csv", "id", "6")
    with pytest.raises(Exception, match="on_misfit"):
        landing.run(on_misfit="other")


def test_taken_files_are_moved_away(landing):
    archive = landing.base / "archive"
    for n in range(3):
        landing.put(f"{n}.csv", "id", str(n))
        assert sorted(r.id for r in landing.run(archive=str(archive)).collect()) == list(range(n + 1))
        waiting = time.monotonic() + 20
        # The files of a run leave once the next one has begun its batch.
        while {p.name for p in landing.source.glob("*.csv")} != {f"{n}.csv"} and time.monotonic() < waiting:
            time.sleep(0.1)
        assert {p.name for p in landing.source.glob("*.csv")} == {f"{n}.csv"}
    assert sorted(p.name for p in archive.rglob("*.csv")) == ["0.csv", "1.csv"]
    assert sorted(r.id for r in landing.run(archive=str(archive)).collect()) == [0, 1, 2]


def test_files_are_taken_once_in_bounded_batches(landing):
    for n in range(5):
        landing.put(f"{n}.csv", "id", str(n))
    got = landing.run(max_files=2)
    assert sorted(r.id for r in got.collect()) == list(range(5))
    assert sorted(r.id for r in landing.run(max_files=2).collect()) == list(range(5))


def test_old_file_delivered_late_is_taken(landing):
    import os

    landing.put("a.csv", "id", "1")
    landing.run()
    landing.put("b.csv", "id", "2")
    os.utime(landing.source / "b.csv", (1_000_000_000, 1_000_000_000))
    assert sorted(r.id for r in landing.run().collect()) == [1, 2]


def test_repeated_batch_replaces_its_own_rows(landing):
    """A crash after the write but before the commit makes Spark run the batch again."""
    landing.put("a.csv", "id", "1")
    landing.run()
    for log in (landing.base / "ckpt" / "commits").glob("*0*"):
        log.unlink()
    assert [r.id for r in landing.run().collect()] == [1]


def test_building_feed_keeps_history(spark, tmp_path):
    landing = Landing(spark, tmp_path)

    def run(as_of):
        ingest_versions(spark, str(landing.source), f"{tmp_path}/v", f"{tmp_path}/s", f"{tmp_path}/c", "run", as_of,
                        ingested_at=NOW)
        return sorted((r.building_id, r.primary_use, r.is_current) for r in read_snapshot(spark, f"{tmp_path}/v").collect())

    landing.put("a.csv", "building_id,primary_use", "1,Office", "2,School")
    assert run(dt.date(2024, 1, 1)) == [(1, "Office", True), (2, "School", True)]
    landing.put("b.csv", "building_id,primary_use", "1,Lab", "3,Shop")
    want = [(1, "Lab", True), (1, "Office", False), (2, "School", True), (3, "Shop", True)]
    assert run(dt.date(2024, 2, 1)) == want
    assert run(dt.date(2024, 3, 1)) == want


def test_schema_rules(spark, tmp_path):
    i, l, d, s = IntegerType(), LongType(), DoubleType(), StringType()
    assert (common_type(i, l), common_type(l, d), common_type(i, s)) == (l, d, s)
    assert common_type(DateType(), TimestampType()) == TimestampType()
    stored, seen = StructType([StructField("a", i)]), StructType([StructField("A", s), StructField("b", d)])
    assert evolve_schema(stored, seen) == StructType([StructField("a", i), StructField("b", d)])
    (tmp_path / "x.csv").write_text("a,b\n1,2.5\n")
    store = f"{tmp_path}/schema.json"
    first = infer_or_load_schema(spark, f"{tmp_path}/x.csv", store)
    (tmp_path / "x.csv").write_text("a,b\nx,y\n")
    assert infer_or_load_schema(spark, f"{tmp_path}/x.csv", store) == first
