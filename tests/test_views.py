import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.expectations import Expectation
from strata.operators.gold import dimension, mapped
from strata.operators.processed import ProcessedSpec, processed, read_rules
from strata.streaming.history import AT, HistoryStore
from strata.streaming.views import RowView

from .test_cdc import frame, random_feed, spec
from .test_history_store import many_keys, same, split

KEYED = ProcessedSpec(business_key_columns=["k"], skey_column="k_skey")


def done(df):
    return processed(df, KEYED).drop("__etl_processed_at")


def views(spark, tmp_path, changes, schema, buckets=2, merge_after=2):
    store = HistoryStore(spark, f"{tmp_path}/s", changes, schema, buckets=buckets, merge_after=merge_after)
    first = RowView(spark, f"{tmp_path}/p", store, done, repr(KEYED))
    rules = read_rules([{"target_col": "name", "expression": "upper(v)"}, *({"source_col": c, "target_col": c} for c in ("k_skey", "k", AT))])
    second = RowView(spark, f"{tmp_path}/d", first, lambda df: mapped(dimension(df), rules, "k % 5 <> 3"), repr(rules))
    return store, first, second


def files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


@pytest.mark.parametrize("scd_type, every", [(1, 2), (2, 1)])
def test_equals_full_recompute_after_each_batch(spark, tmp_path, scd_type, every):
    rows = random_feed(11, keys=20, hot=30)
    changes = spec(scd_type=scd_type, track_history_column_list=["v"])
    feed = frame(spark, rows)
    store, first, second = views(spark, tmp_path, changes, feed.schema)
    for i, part in enumerate(split(rows, 4, random.Random(scd_type))):
        store.apply(frame(spark, part), i + 1)
        if (i + 1) % every:
            continue
        first.refresh()
        second.refresh()
        want = done(store.read())
        assert same(first.read(), want)
        assert same(second.read(), want.where("k % 5 <> 3").select(F.upper("v").alias("name"), "k_skey", "k"))
    store.clean(1)
    first.clean(1)
    second.clean(1)
    assert same(first.read(), want), "a view needs nothing of what the store removes"
    first.publish("views_test.first_done")
    assert same(spark.table("views_test.first_done"), want)


def test_files_of_other_parts_stay(spark, tmp_path):
    rows = many_keys(300)
    store, first, second = views(spark, tmp_path, spec(track_history_column_list=["v"]), frame(spark, rows).schema, buckets=8, merge_after=16)
    store.apply(frame(spark, rows), 1)
    first.refresh()
    second.refresh()
    before = files(spark, f"{tmp_path}/p/rows") | files(spark, f"{tmp_path}/d/rows")
    one = [dict(k=7, seq=60, v="new", u=0, op="u", id=9)]
    store.apply(frame(spark, one), 2)
    assert first.refresh() == {} and second.refresh() == {}
    after = files(spark, f"{tmp_path}/p/rows") | files(spark, f"{tmp_path}/d/rows")
    assert before <= after
    written = spark.read.parquet(f"{tmp_path}/p/rows/__refresh=2")
    assert written.count() == 2 and {r["k"] for r in written.collect()} == {7}, "the closed and the new open run"
    assert first._refreshes() == [1, 2]
    first.refresh()
    assert first._refreshes() == [1, 2], "nothing new, nothing written"


def test_rebuilt_after_a_failure_and_with_another_build(spark, tmp_path):
    rows = many_keys(30)
    store, first, second = views(spark, tmp_path, spec(track_history_column_list=["v"]), frame(spark, rows).schema)
    store.apply(frame(spark, rows[:60]), 1)
    failing = RowView(spark, first.root, store, lambda df: done(df).where(F.when(F.col("k") >= 0, F.raise_error(F.lit("stop")))), "failing")
    with pytest.raises(Exception, match="stop"):
        failing.refresh()
    assert first._refreshes() == []
    first.refresh()
    second.refresh()
    store.apply(frame(spark, rows[60:]), 2)
    other = RowView(spark, first.root, store, lambda df: done(df).withColumn("more", F.lit(1)), "more")
    other.refresh()
    assert same(other.read(), done(store.read()).withColumn("more", F.lit(1)))
    again = RowView(spark, second.root, other, lambda df: df.select("k", "more", AT), "k")
    again.refresh()
    assert same(again.read(), store.read().select("k", F.lit(1).alias("more")))


def test_constraints_are_checked_on_what_is_built(spark, tmp_path):
    rows = many_keys(10)
    store = HistoryStore(spark, f"{tmp_path}/s", spec(track_history_column_list=["v"]), frame(spark, rows).schema, buckets=2)
    rules = [Expectation("small", "k < 8", "DROP")]
    view = RowView(spark, f"{tmp_path}/p", store, done, "x", rules)
    store.apply(frame(spark, rows), 1)
    counts = view.refresh()
    assert counts["small"] == counts["rows"] - view.read().count() > 0
    store.apply(frame(spark, [dict(k=9, seq=99, v="z", u=0, op="u", id=1)]), 2)
    assert view.refresh() == {"rows": 2, "small": 2}
    assert same(view.read(), done(store.read()).where("k < 8"))


def test_what_is_not_row_by_row_is_refused(spark, tmp_path):
    rows = many_keys(3)
    store = HistoryStore(spark, f"{tmp_path}/s", spec(), frame(spark, rows).schema, buckets=2)
    bad = {
        "numbered": lambda df: df.withColumn("n", F.row_number().over(Window.orderBy("k"))),
        "joined": lambda df: df.join(df.select("k").alias("o"), "k"),
        "aggregated": lambda df: df.groupBy("k").agg(F.first(AT).alias(AT)),
        "drawn": lambda df: df.withColumn("x", F.rand()),
        "asked": lambda df: df.where(F.expr("k < (SELECT 3)")),
    }
    for name, build in bad.items():
        with pytest.raises(ValueError, match="depend on other rows"):
            RowView(spark, f"{tmp_path}/{name}", store, build).refresh()
    with pytest.raises(ValueError, match="must be kept"):
        RowView(spark, f"{tmp_path}/lost", store, lambda df: df.select("k")).refresh()


def test_empty_source(spark, tmp_path):
    store, first, second = views(spark, tmp_path, spec(), frame(spark, many_keys(1)).schema)
    first.refresh()
    second.refresh()
    assert first.read().count() == second.read().count() == 0
    first.publish("views_test.nothing")
    assert spark.table("views_test.nothing").columns == first.read().columns


def test_parts_without_later_cuts_are_built_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Refreshed after each micro-batch, a view joins no cuts and spreads no rows, of merged parts either; refreshed later, it does."""
    plans, write = [], RowView._written

    def spy(self, df, folder, *rest):
        plans.append((folder, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, df, folder, *rest)

    monkeypatch.setattr(RowView, "_written", spy)
    rows = sorted(many_keys(60), key=lambda r: r["seq"])
    store, first, second = views(spark, tmp_path, spec(track_history_column_list=["v"]), frame(spark, rows).schema)
    other = RowView(spark, f"{tmp_path}/o", store, done, "other")
    for i in range(3):
        store.apply(frame(spark, rows[80 * i : 80 * (i + 1)]), i + 1)
        first.refresh()
        second.refresh()
    assert plans and not any("Rebalance" in plan or "Join" in plan for _, plan in plans)
    plans.clear()
    assert same(first.read(), done(store.read()))
    whole = HistoryStore(spark, f"{tmp_path}/t", store.spec, store.schema, buckets=2)
    for i in range(3):
        whole.apply(frame(spark, rows[80 * i : 80 * (i + 1)]), i + 1)
    late = RowView(spark, f"{tmp_path}/l", whole, done, "late")
    late.refresh()
    assert any("Rebalance" in plan and "Join" in plan for _, plan in plans)
    other.refresh()
    assert same(late.read(), done(whole.read())) and same(other.read(), late.read())
