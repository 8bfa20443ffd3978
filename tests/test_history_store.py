import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.cdc import ChangeSpec, apply_changes
from strata.streaming.history import CHANGES, MERGED, HistoryStore, newest_to_merge

from .test_cdc import TINY, WHOLE, expected, frame, random_feed, spec, versions


def split(rows, n, rng):
    parts = [[] for _ in range(n)]
    for row in rows:
        rng.choice(parts).append(row)
    return [p for p in parts if p]


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("carry", [False, True])
def test_any_split_equals_batch(spark, tmp_path, scd_type, carry):
    rows = random_feed(7, keys=25, hot=40)
    changes = spec(scd_type=scd_type, ignore_null_updates=carry, track_history_column_list=["v"])
    feed = frame(spark, rows)
    want = apply_changes(feed, changes, WHOLE)
    store = HistoryStore(spark, f"{tmp_path}/s", changes, feed.schema, buckets=3, merge_after=2, skew=TINY)
    for i, part in enumerate(split(rows, 2, random.Random(scd_type))):
        store.apply(frame(spark, part), i)
        if i == 1:
            store.apply(frame(spark, part), i)  # the same micro-batch once more
    assert same(store.read(), want)
    if scd_type == 2:
        assert versions(store.read()) == expected(rows, ["v"], carry)


def test_in_order_batches_add_closed_runs_only(spark, tmp_path):
    rows = [dict(k=k, seq=s, v=str(s), u=0, op="u", id=s) for k in range(4) for s in range(1, 4)]
    changes = spec(track_history_column_list=["v"])
    feed = frame(spark, rows)
    store = HistoryStore(spark, f"{tmp_path}/s", changes, feed.schema, buckets=2)
    for s in range(1, 4):
        store.apply(frame(spark, [r for r in rows if r["seq"] == s]), s * 2 if s == 3 else s)
    before = store.manifest()
    store.apply(frame(spark, []), 7)
    assert store.manifest() == before, "an empty micro-batch changes nothing"
    assert versions(store.read()) == expected(rows, ["v"], False)
    for version in (2, 6):
        written = spark.read.parquet(f"{tmp_path}/s/runs/__version={version}")
        assert written.groupBy("__open").count().orderBy("__open").collect() == [(0, 4), (1, 4)], "one closed and one open run a key"


def many_keys(n):
    return [dict(k=k, seq=s, v=str(s % 3), u=0, op="u", id=s) for k in range(n) for s in range(10, 50, 10)]


def written_runs(spark, path, version):
    return spark.read.parquet(f"{path}/runs/__version={version}").select("k").collect()


def test_cost_follows_the_micro_batch(spark, tmp_path):
    rows = many_keys(500)
    changes = spec(track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, rows).schema, buckets=4)
    store.apply(frame(spark, rows), 1)
    four = [dict(k=k, seq=60, v="new", u=0, op="u", id=9) for k in (1, 2, 3, 4)]
    store.apply(frame(spark, four), 2)
    assert len(written_runs(spark, f"{tmp_path}/s", 2)) == 8, "the closed and the new open run of four keys"
    late = [dict(k=k, seq=25, v="late", u=0, op="u", id=9) for k in range(100, 112)]
    store.apply(frame(spark, late), 3)
    assert {r["k"] for r in written_runs(spark, f"{tmp_path}/s", 3)} == set(range(100, 112))
    assert versions(store.read()) == expected(rows + four + late, ["v"], False)


def test_folding_and_cleaning(spark, tmp_path):
    rows = many_keys(20)
    changes = spec(track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, rows).schema, buckets=2, merge_after=2)
    taken = []
    for i in range(6):
        part = [r for j, r in enumerate(rows) if j % 6 == i]
        taken += part
        store.apply(frame(spark, part), i + 1)
        assert versions(store.read()) == expected(taken, ["v"], False)
        assert max(sum(k == 2 for k, b, *_ in store.manifest() if b == x) for x in (0, 1)) <= 2
    assert store.clean(keep=1) > 0
    assert versions(store.read()) == expected(rows, ["v"], False)
    named = {(p.kind, p.bucket, p.version) for p in store.manifest() if p.kind < 2}
    folders = {tuple(map(int, (p.parent.name[-1], p.name.split("=")[1], p.parent.parent.name.split("=")[1]))) for p in (tmp_path / "s/runs").glob("*/*/*=*")}
    assert folders == named
    assert store.clean(keep=1) == 0


@pytest.mark.parametrize("scd_type", [1, 2])
def test_snapshots_keep_what_they_no_longer_hold(spark, tmp_path, scd_type):
    first = [dict(k=1, seq=1, v="A", u=0, op="u", id=1), dict(k=2, seq=1, v="X", u=0, op="u", id=2)]
    second = [dict(k=1, seq=2, v="B", u=0, op="u", id=3)]
    changes = spec(scd_type=scd_type, track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, first).schema, buckets=2)
    for rows in (first, second, second, first):
        store.apply_snapshot(frame(spark, rows))
    assert same(store.read(), apply_changes(frame(spark, first + second), changes, WHOLE))


def test_empty_first_load(spark, tmp_path):
    changes = spec(track_history_column_list=["v"])
    refused = [dict(k=None, seq=1, v="A", u=0, op="u", id=1)]
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, refused).schema, buckets=2)
    view = f"spark_catalog.s{uuid.uuid4().hex[:6]}.cdc_empty"
    for i, rows in enumerate(([], refused)):
        store.apply(frame(spark, rows), i)
        store.publish(view)
        assert spark.table(view).count() == 0 and store.read().count() == 0
    assert store.refused == {0: 0, 1: 1}
    store.apply(frame(spark, [dict(k=1, seq=1, v="A", u=0, op="u", id=1)]), 2)
    store.publish(view)
    assert spark.table(view).count() == 1


def test_late_delete_and_emptied_key(spark, tmp_path):
    first = [dict(k=1, seq=1, v="A", u=0, op="u", id=1), dict(k=1, seq=5, v="B", u=0, op="u", id=2)]
    late = [dict(k=1, seq=3, v=None, u=None, op="d", id=3)]
    gone = [dict(k=1, seq=9, v=None, u=None, op="d", id=4)]
    changes = spec(track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, first).schema, buckets=1)
    for i, part in enumerate((first, late, gone)):
        store.apply(frame(spark, part), i)
    assert versions(store.read()) == expected(first + late + gone, ["v"], False)
    store.apply(frame(spark, [dict(k=1, seq=7, v="C", u=0, op="u", id=5)]), 3)
    assert [r[1] for r in versions(store.read())] == ["A", "B", "C"]


def test_stream_and_published_view(spark, sf, tmp_path):
    source = f"{tmp_path}/in"
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.orderBy(F.rand(3)).repartition(3).write.parquet(source)
    changes = ChangeSpec(
        keys=["user_id"], sequence_by="ts", apply_as_deletes="event_type = 'error'", track_history_column_list=["event_type"]
    )
    store = HistoryStore(spark, f"{tmp_path}/s", changes, events.schema, buckets=4)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        stream.writeStream.foreachBatch(store.apply)
        .option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    want = apply_changes(events, changes)
    assert same(store.read(), want)
    view = f"spark_catalog.s{uuid.uuid4().hex[:6]}.cdc_events"
    store.publish(view)
    assert same(spark.table(view), want)


@pytest.mark.parametrize("first", [0, 20_000])
def test_parts_grow_like_their_number(first):
    """One row a micro-batch: rows are written again a few times each, and parts stay few."""
    sizes, written, n = [first] if first else [], 0, 4_000
    for _ in range(n):
        taken = newest_to_merge(sizes, 16)
        new = 1 + sum(sizes[len(sizes) - taken :]) if taken else 1
        sizes = [*sizes[: len(sizes) - taken], new]
        written += new
        assert len(sizes) <= 17
    assert written < n * 12
    assert sum(sizes) == first + n


def test_many_small_batches_over_a_large_bucket(spark, tmp_path):
    """20,000 closed runs in one bucket; no micro-batch of one change writes them again."""
    base = spark.range(20_001).selectExpr("0 as k", "cast(id as int) as seq", "cast(id as string) as v", "0 as u", "'u' as op", "cast(id as int) as id")
    changes = spec(track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, base.schema, buckets=1, merge_after=4)
    store.apply(base, 1)
    written = 0
    for i in range(2, 26):
        store.apply(spark.createDataFrame([(i % 3, 30_000 + i, f"n{i}", 0, "u", i)], base.schema), i)
        now = [p for p in store.manifest() if p.version == i]
        written += sum(p.rows for p in now)
        assert len({p.version for p in store.manifest() if p.kind < 3}) <= 5
    assert written < 24 * 3 * 8
    assert store.read().count() == 20_001 + 24


def opened(monkeypatch):
    """The parts of changes that micro-batches read, and how many rows of them."""
    parts, rows = [], []
    plain, history = HistoryStore._change_rows, HistoryStore._history
    monkeypatch.setattr(HistoryStore, "_change_rows", lambda self, p, schema: (parts.append(set(p)), plain(self, parts[-1], schema))[1])

    def counted(self, *args):
        found = history(self, *args)
        rows.append(found.count())
        return found

    monkeypatch.setattr(HistoryStore, "_history", counted)
    return parts, rows


@pytest.mark.parametrize("carry", [False, True])
def test_late_changes_open_few_parts(spark, tmp_path, monkeypatch, carry):
    """Ten micro-batches in order; a late change near the end reads the last ones, and its key's last run, only."""
    rows = [dict(k=k, seq=10 * s + t, v=str(s), u=None if t else s, op="u", id=s) for k in range(6) for s in range(10) for t in range(3)]
    changes = spec(track_history_column_list=["v"], ignore_null_updates=carry)
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, rows).schema, buckets=2)
    for s in range(10):
        store.apply(frame(spark, [r for r in rows if r["id"] == s]), s + 1)
    parts, read = opened(monkeypatch)
    late = [dict(k=3, seq=85, v=None, u=None, op="u", id=99), dict(k=4, seq=83, v="late", u=7, op="u", id=99)]
    store.apply(frame(spark, late), 11)
    assert len(parts) == len(read) == 1
    assert {p.version for p in parts[0]} <= {9, 10, 11} and {p.kind for p in parts[0]} == {CHANGES}
    assert read[0] == 2 * 6 + 2, "the runs that start at 80 and 90, of two keys, and the late changes"
    if carry:
        assert versions(store.read()) == expected(rows + late, ["v"], True)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_late_changes_in_merged_parts(spark, tmp_path, scd_type):
    """Deletes, NULLs and late changes over many micro-batches whose changes and runs are merged."""
    rng = random.Random(5)
    rows = random_feed(11, keys=8, hot=30)
    changes = spec(scd_type=scd_type, ignore_null_updates=True, track_history_column_list=["v"])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, rows).schema, buckets=1, merge_after=3, skew=WHOLE)
    for i, part in enumerate(split(rows, 9, rng)):
        store.apply(frame(spark, part), i + 1)
    assert any(p.kind == MERGED for p in store.manifest())
    assert same(store.read(), apply_changes(frame(spark, rows), changes, WHOLE))
    assert store.clean(keep=1) > 0
    late = [dict(k=rows[0]["k"], seq=0, v="first", u=1, op="u", id=1)]
    store.apply(frame(spark, late), 20)
    assert same(store.read(), apply_changes(frame(spark, rows + late), changes, WHOLE))


def test_snapshots_read_changes_for_late_rows_only(spark, tmp_path, monkeypatch):
    first = [dict(k=k, seq=s, v=str(s), u=0, op="u", id=1) for k in range(4) for s in (1, 2)]
    changes = ChangeSpec(keys=["k"], sequence_by="seq", track_history_column_list=["v"])
    current = [r for r in first if r["seq"] == 2]
    store = HistoryStore(spark, f"{tmp_path}/s", changes, frame(spark, first).schema, buckets=2)
    store.apply_snapshot(frame(spark, first))
    parts, _ = opened(monkeypatch)
    newer = [dict(k=1, seq=3, v="3", u=0, op="u", id=1)]
    store.apply_snapshot(frame(spark, [*current, *newer]))
    assert parts == [], "each row is the state in force or newer"
    store.apply_snapshot(frame(spark, first))
    assert len(parts) == 1, "older rows are looked up"
    assert same(store.read(), apply_changes(frame(spark, first + newer), changes, WHOLE))


def test_an_older_layout_is_refused(spark, tmp_path):
    changes = spec(track_history_column_list=["v"])
    feed = frame(spark, [dict(k=1, seq=1, v="A", u=0, op="u", id=1)])
    store = HistoryStore(spark, f"{tmp_path}/s", changes, feed.schema, buckets=1)
    spark.createDataFrame([("1/0/1",)], "part string").write.parquet(f"{tmp_path}/s/manifest/__batch=1")
    with pytest.raises(ValueError, match="older layout"):
        store.apply(feed, 2)


def test_events_of_a_batch_are_not_counted_by_a_pass_of_their_own(spark, tmp_path, monkeypatch):
    """What is known of a micro-batch says how many changes and runs it reads: exactly in order, at most with late changes."""
    given = []

    def spy(df, keys, order, policy, total=None):
        given.append((total, df.count()))

    monkeypatch.setattr("strata.operators.cdc.find_long_keys", spy)
    rows = sorted(many_keys(40), key=lambda r: r["seq"])
    store = HistoryStore(spark, str(tmp_path / "s"), spec(track_history_column_list=["v"]), frame(spark, rows).schema, buckets=2)
    late, third = rows[::7], [r for i, r in enumerate(rows) if i % 7]
    third = [third[i * len(third) // 3 : (i + 1) * len(third) // 3] for i in range(3)]
    for i, part in enumerate([*third, late]):
        store.apply(frame(spark, part), i)
    assert all(total is not None and total >= there for total, there in given) and len(given) == 4
    assert given[0] == (len(third[0]), len(third[0]))
    assert same(store.read(), apply_changes(frame(spark, rows), store.spec))
