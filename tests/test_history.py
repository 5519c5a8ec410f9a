"""Type-2 history: new, changed, unchanged, removed and returned keys, in memory and stored."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators.history import Names, Tracking, apply_history, first_history, next_history, scd_id
from tradewind.sources.tables import Warehouse

T0, T1, T2, T3, T4 = [datetime(2024, 1, d) for d in (1, 2, 3, 4, 5)]
SCHEMA = "id string, name string, at timestamp"


def src(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def versions(df, *cols):
    return sorted([tuple(r) for r in df.select(*(cols or ("id", "name", "valid_from", "valid_to"))).collect()], key=str)


def test_scd_id(spark):
    df = spark.range(1).select(scd_id(F.lit("k"), F.lit(None), F.lit(7)).alias("h"))
    assert df.first()[0] == hashlib.md5(b"k||7").hexdigest()


def test_timestamp(spark):
    how = Tracking(("id",), updated_at="at")
    h = first_history(src(spark, ("a", "x", T0), ("b", "x", T0), ("c", "x", T0)), how, T1)
    assert versions(h) == [("a", "x", T0, None), ("b", "x", T0, None), ("c", "x", T0, None)]
    # a later, b same time (so not a change), c removed and ignored, d new
    h = next_history(h, src(spark, ("a", "y", T2), ("b", "z", T0), ("d", "x", T2)), how, T3)
    assert versions(h) == [("a", "x", T0, T2), ("a", "y", T2, None), ("b", "x", T0, None), ("c", "x", T0, None), ("d", "x", T2, None)]
    assert h.select("scd_id").distinct().count() == 5
    again = next_history(h, src(spark, ("a", "y", T2), ("b", "z", T0), ("d", "x", T2)), how, T4)
    assert versions(again) == versions(h)


def test_check(spark):
    how = Tracking(("id",), check=("name",))
    h = first_history(src(spark, ("a", None, T0), ("b", "x", T0), ("c", "x", T0)), how, T1)
    h = next_history(h, src(spark, ("a", "now set", T0), ("b", None, T0), ("c", "x", T3)), how, T2)
    assert versions(h) == sorted([
        ("a", None, T1, T2), ("a", "now set", T2, None), ("b", None, T2, None), ("b", "x", T1, T2), ("c", "x", T1, None),
    ], key=str)
    how = Tracking(("id",), check="all")
    h = first_history(src(spark, ("a", "x", T0)), how, T1)
    assert next_history(h, src(spark, ("a", "x", T1)), how, T2).count() == 2


def test_check_with_unchanged_time_adds_nothing(spark):
    # the id of the new version equals that of the old: the old one is closed, no new one is added
    how = Tracking(("id",), updated_at="at", check=("name",))
    h = first_history(src(spark, ("a", "x", T0)), how, T1)
    h = next_history(h, src(spark, ("a", "y", T0)), how, T2)
    assert versions(h) == [("a", "x", T0, T0)]


def test_added_column_changes_every_row(spark):
    how = Tracking(("id",), check="all")
    h = first_history(src(spark, ("a", "x", T0)), how, T1)
    h = next_history(h, src(spark, ("a", "x", T0)).withColumn("extra", F.lit(1)), how, T2)
    assert versions(h, "id", "extra", "valid_to") == [("a", 1, None), ("a", None, T2)]


def test_invalidate(spark):
    how = Tracking(("id",), updated_at="at", hard_deletes="invalidate")
    h = first_history(src(spark, ("a", "x", T0), ("b", "x", T0)), how, T1)
    h = next_history(h, src(spark, ("b", "x", T0)), how, T2)
    assert versions(h) == [("a", "x", T0, T2), ("b", "x", T0, None)]
    h = next_history(h, src(spark, ("b", "x", T0), ("a", "back", T3)), how, T3)
    assert versions(h) == [("a", "back", T3, None), ("a", "x", T0, T2), ("b", "x", T0, None)]


def test_new_record(spark):
    how = Tracking(("id",), updated_at="at", hard_deletes="new_record")
    cols = ("id", "name", "valid_from", "valid_to", "is_deleted")
    h = first_history(src(spark, ("a", "x", T0), ("b", "x", T0)), how, T1)
    gone = src(spark, ("b", "x", T0))
    h = next_history(h, gone, how, T2)
    want = [("a", "x", T0, T2, "False"), ("a", "x", T2, None, "True"), ("b", "x", T0, None, "False")]
    assert versions(h, *cols) == want
    assert versions(next_history(h, gone, how, T3), *cols) == want  # already deleted: nothing happens
    h = next_history(h, src(spark, ("b", "x", T0), ("a", "x", T3)), how, T4)
    assert versions(h, *cols) == [
        ("a", "x", T0, T2, "False"), ("a", "x", T2, T3, "True"), ("a", "x", T3, None, "False"), ("b", "x", T0, None, "False")]


def test_open_end_names_and_composite_keys(spark):
    far = datetime(9999, 12, 31)
    how = Tracking(("id", "name"), updated_at="at", open_end=far, names=Names(valid_to="until"))
    h = first_history(src(spark, ("a", "x", T0), ("a", None, T0)), how, T1)
    assert {r.until for r in h.collect()} == {far}
    h = next_history(h, src(spark, ("a", "x", T2), ("a", None, T2)), how, T3)
    # a NULL in the key matches nothing: the row is new each time
    assert versions(h, "id", "name", "until") == [("a", "x", T2), ("a", "x", far), ("a", None, far), ("a", None, far)]


@pytest.mark.parametrize("bad", [dict(check="some"), dict(check=()), dict(), dict(updated_at="at", hard_deletes="no")])
def test_bad_settings(bad):
    with pytest.raises(ValueError):
        Tracking(("id",), **bad)


@pytest.mark.parametrize("hard_deletes", ["ignore", "invalidate", "new_record"])
def test_stored_history_equals_history_in_memory(spark, tmp_path, hard_deletes):
    wh = Warehouse(spark, str(tmp_path), {"gold": f"hist_{hard_deletes}"})
    how = Tracking(("id",), updated_at="at", hard_deletes=hard_deletes)
    runs = [
        (src(spark, ("a", "x", T0), ("b", "x", T0), ("c", "x", T0)), T1),
        (src(spark, ("a", "y", T2), ("b", "x", T0)), T2),
        (src(spark, ("a", "y", T2), ("c", "back", T3), ("d", "x", T3)).withColumn("extra", F.lit(1)), T3),
        (src(spark, ("a", "z", T4)).withColumn("extra", F.lit(2)), T4),
    ]
    h = None
    for s, now in runs:
        h = first_history(s, how, now) if h is None else next_history(h, s, how, now)
        apply_history(wh, "gold.h", s, how, now)
        got = wh.read("gold.h").drop("_open_bucket")
        cols = sorted(h.columns)
        assert sorted(got.columns) == cols
        assert versions(got, *cols) == versions(h, *cols)
    with pytest.raises(ValueError):
        apply_history(wh, "gold.h", src(spark, ("a", "p", T4), ("a", "q", T4)).withColumn("extra", F.lit(2)), how, T4)


def test_a_small_change_leaves_most_open_files(spark, tmp_path):
    """Three of 2,000 keys change: three of 32 partitions of open versions are written again, closed ones only grow."""
    wh = Warehouse(spark, str(tmp_path), {"gold": "hist_files"})
    how = Tracking(("id",), updated_at="at")
    state = lambda day, ids: spark.range(2000).selectExpr("string(id) AS id", f"IF(id IN ({ids}), timestamp'2024-01-0{day}', timestamp'2024-01-01') AS at")
    files = lambda: {r[0]: r[1] for r in wh.read("gold.h").select("_open_bucket", "_metadata.file_path").distinct().collect()}
    apply_history(wh, "gold.h", state(1, "-1"), how, datetime(2024, 1, 1), buckets=32)
    before = files()
    apply_history(wh, "gold.h", state(2, "5, 500, 1500"), how, datetime(2024, 1, 2))
    after = files()
    assert len(before) == 32 and len([b for b in before if before[b] != after[b]]) <= 3 and set(after) - set(before) == {-1}
    assert wh.read("gold.h").count() == 2003 and wh.read("gold.h").where("valid_to IS NULL").count() == 2000
    # a run without a change writes nothing
    apply_history(wh, "gold.h", state(2, "5, 500, 1500"), how, datetime(2024, 1, 3))
    assert files() == after
