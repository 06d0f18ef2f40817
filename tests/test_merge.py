import datetime as dt

import pytest

from meterlake.operators.dedupe import latest_by
from meterlake.operators.merge import merge_insert, merge_update, upsert
from meterlake.operators.scd2 import scd2_apply

KV = "k int, v string, n int"
DAY1, DAY2, DAY3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def frame(spark, *rows, schema=KV):
    return spark.createDataFrame(list(rows), schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_update_changes_only_matched_rows_meeting_the_condition(spark):
    target = frame(spark, (1, "a", 1), (2, "b", 2), (None, "c", 3), (4, "d", 4))
    source = frame(spark, (1, "A", 9), (2, "b", 9), (None, "C", 9), (5, "E", 9))
    got = merge_update(target, source, ["k"], {"n": "src.n + tgt.n"}, when="tgt.v <> src.v")
    assert rows(got) == rows(frame(spark, (1, "a", 10), (2, "b", 2), (None, "c", 3), (4, "d", 4)))


def test_merge_update_rejects_ambiguous_source(spark):
    source = frame(spark, (1, "A", 9), (1, "B", 8))
    with pytest.raises(Exception, match="duplicate k"):
        merge_update(frame(spark, (1, "a", 1)), source, ["k"], {"v": "src.v"}).collect()
    got = merge_update(frame(spark, (1, "a", 1)), source, ["k"], {"v": "src.v"},
                       on_duplicate="last", newest_first=["n"])
    assert rows(got) == [(1, "A", 1)]


def test_merge_insert_adds_unknown_keys_and_columns(spark):
    source = frame(spark, (1, "x", 0), (3, "c", 3), (None, "z", 0))
    got = merge_insert(frame(spark, (1, "a"), (None, "n"), schema="k int, v string"), source, ["k"])
    assert rows(got) == sorted([(1, "a", None), (None, "n", None), (3, "c", 3), (None, "z", 0)], key=str)


def test_upsert_replaces_and_is_idempotent(spark):
    target, source = frame(spark, (1, "a", 1), (2, "b", 2)), frame(spark, (2, "B", 9), (3, "c", 3))
    once = upsert(target, source, ["k"])
    assert rows(once) == [(1, "a", 1), (2, "B", 9), (3, "c", 3)]
    assert rows(upsert(once, source, ["k"])) == rows(once)
    with pytest.raises(Exception, match="duplicate k"):
        upsert(target, frame(spark, (5, "x", 1), (5, "y", 2)), ["k"]).collect()


def test_latest_by_keeps_null_keys_and_collapses_copies_early(spark):
    df = frame(spark, (1, "a", 1), (1, "b", 2), (None, "x", 1), (None, "y", 1), (None, "y", 1))
    newest = latest_by(df, ["k"], ["n"])
    assert rows(newest) == sorted([(1, "b", 2), (None, "x", 1), (None, "y", 1)], key=str)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


B = "building_id int, primary_use string"


def build(spark, *pairs):
    return frame(spark, *pairs, schema=B)


def apply(versions, incoming, as_of, **options):
    return scd2_apply(versions, incoming, "building_id", "primary_use", as_of, **options)


END = dt.date(9999, 12, 31)


def test_change_closes_and_opens(spark):
    first = apply(None, build(spark, (1, "A"), (2, "B")), DAY1)
    second = apply(first, build(spark, (1, "X"), (2, "B"), (3, "C")), DAY2)
    assert rows(second) == sorted([
        (1, "A", DAY1, DAY2, False), (1, "X", DAY2, END, True),
        (2, "B", DAY1, END, True), (3, "C", DAY2, END, True)], key=str)


def test_replay_changes_nothing(spark):
    batch = build(spark, (1, "X"), (3, "C"))
    once = apply(apply(None, build(spark, (1, "A")), DAY1), batch, DAY2)
    assert rows(apply(once, batch, DAY2)) == rows(once)
    assert rows(apply(once, batch, DAY3)) == rows(once)


def test_null_change_counts_only_if_asked(spark):
    first = apply(None, build(spark, (1, "A"), (2, None)), DAY1)
    batch = build(spark, (1, None), (2, "B"))
    assert rows(apply(first, batch, DAY2)) == rows(first)
    assert len(rows(apply(first, batch, DAY2, null_safe=True))) == 4


def test_duplicates_in_a_batch(spark):
    batch = build(spark, (1, "A"), (1, "B"))
    with pytest.raises(Exception, match="duplicate building_id"):
        apply(None, batch, DAY1).collect()
    got = apply(None, batch, DAY1, on_duplicate="last", newest_first=["primary_use"])
    assert rows(got) == [(1, "B", DAY1, END, True)]


def test_second_change_on_one_day_is_rejected(spark):
    first = apply(None, build(spark, (1, "A")), DAY1)
    with pytest.raises(Exception, match="second change on one day"):
        apply(first, build(spark, (1, "B")), DAY1).collect()
