"""Merges of random states against a plain Python model, and merging twice."""

from hypothesis import HealthCheck, given, settings, strategies as st

from tradewind.operators import merge

SCHEMA = "k int, j string, a int, b int"
KEY = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from("xy")))
TABLE = st.dictionaries(KEY, st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=12)
COMMON = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, table):
    return spark.createDataFrame([(*k, *v) for k, v in table.items()], SCHEMA)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def model(old, new, columns):
    """Expected rows: a key with a NULL part matches nothing."""
    out, whole = [], lambda k: None not in k
    for k, (a, b) in old.items():
        if whole(k) and k in new:
            a, b = new[k][0] if "a" in columns else a, new[k][1] if "b" in columns else b
        out.append((*k, a, b))
    out += [(*k, *v) for k, v in new.items() if not whole(k) or k not in old]
    return sorted(out, key=str)


@settings(**COMMON)
@given(TABLE, TABLE)
def test_merge(spark, old, new):
    got = merge.merge_rows(frame(spark, old), frame(spark, new), ["k", "j"])
    assert rows(got) == model(old, new, "ab")


@settings(**COMMON)
@given(TABLE, TABLE)
def test_merge_of_one_column(spark, old, new):
    got = merge.merge_rows(frame(spark, old), frame(spark, new), ["k", "j"], update=["b"])
    assert rows(got) == model(old, new, "b")


@settings(**COMMON)
@given(TABLE, TABLE)
def test_merging_twice_is_merging_once(spark, old, new):
    new = {k: v for k, v in new.items() if None not in k}
    once = merge.merge_rows(frame(spark, old), frame(spark, new), ["k", "j"])
    assert rows(merge.merge_rows(once, frame(spark, new), ["k", "j"])) == rows(once)


@settings(**COMMON)
@given(TABLE, TABLE)
def test_delete_insert(spark, old, new):
    got = merge.delete_insert_rows(frame(spark, old), frame(spark, new), ["k", "j"])
    kept = [(*k, *v) for k, v in old.items() if None in k or k not in new]
    assert rows(got) == sorted(kept + [(*k, *v) for k, v in new.items()], key=str)
