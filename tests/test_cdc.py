import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.cdc import ChangeSpec, apply_changes, refused_changes
from strata.operators.skew import SLICE, SkewPolicy, find_long_keys, split_long_keys

from .brute import scd2

SCHEMA = "k int, seq int, v string, u int, op string, id int"
TINY = SkewPolicy(min_rows=15, target_slices=60)
WHOLE = SkewPolicy(enabled=False)


def epoch(seq):
    return seq


def random_feed(seed, keys=60, hot=400, hot_ties=False):
    rng = random.Random(seed)
    rows = []

    def add(k, top):
        rows.append(
            dict(
                k=k,
                seq=rng.randint(1, top),
                v=rng.choice(["A", "B", None]) if rng.random() < 0.5 else "A",
                u=rng.choice([1, 2, None]),
                op="d" if rng.random() < 0.1 else "u",
                id=len(rows),
            )
        )

    for k in range(keys):
        for _ in range(rng.randint(1, 12)):
            add(k, 9)
    for _ in range(hot):
        add(1000, 3 if hot_ties else 300)
        add(1001, 2000)
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in ("k", "seq", "v", "u", "op", "id")) for r in rows], SCHEMA)


def spec(**more):
    base = dict(
        keys=["k"],
        sequence_by="seq",
        apply_as_deletes="op = 'd'",
        tie_breaker=["id"],
        except_column_list=["op", "id", "seq"],
    )
    return ChangeSpec(**{**base, **more})


def versions(df):
    return sorted(
        ((r["k"], r["v"], r["u"], r["__START_AT"], r["__END_AT"]) for r in df.collect()), key=lambda r: (r[0], r[3])
    )


def expected(rows, tracked, carry):
    out = [(r["k"], r["v"], r["u"], epoch(r["start"]), epoch(r["end"])) for r in scd2(rows, tracked, ["v", "u"], carry)]
    return sorted(out, key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("policy", [TINY, WHOLE], ids=["sliced", "whole"])
@pytest.mark.parametrize("carry", [False, True])
@pytest.mark.parametrize("tracked", [["v", "u"], ["v"]])
def test_random_feed_equals_brute_force(spark, tracked, carry, policy):
    for seed, hot_ties in ((1, False), (2, True)):
        rows = random_feed(seed, hot_ties=hot_ties)
        feed = frame(spark, rows)
        options = dict(ignore_null_updates=carry, track_history_column_list=tracked)
        got = versions(apply_changes(feed, spec(**options), policy))
        want = expected(rows, tracked, carry)
        assert got == want

        scd1 = apply_changes(feed, spec(scd_type=1, **options), policy)
        assert scd1.columns == ["k", "v", "u"]
        open_rows = sorted((r[0], r[1], r[2]) for r in want if r[4] is None)
        assert sorted(map(tuple, scd1.collect()), key=lambda r: r[0]) == sorted(open_rows, key=lambda r: r[0])


def test_long_keys_are_really_cut(spark):
    rows = random_feed(3)
    feed = frame(spark, rows).withColumn("at", F.col("seq").cast("timestamp"))
    slicing = find_long_keys(feed, ["k"], "at", TINY)
    short, sliced = split_long_keys(feed, ["k"], "at", slicing)
    assert short.count() + sliced.count() == len(rows)
    assert {r["k"] for r in sliced.select("k").distinct().collect()} == {1000, 1001}
    assert short.where("k >= 1000").count() == 0
    per_slice = sliced.where("k = 1001").groupBy(SLICE).count().collect()
    assert len(per_slice) > 10
    assert max(r["count"] for r in per_slice) < 60
    # Slices follow the sequence.
    spans = sorted(tuple(r) for r in sliced.where("k = 1001").groupBy(SLICE).agg(F.min("seq"), F.max("seq")).collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


FIXED = {
    "late change splits a run": ([("A", 1), ("A", 3), ("B", 2)], [("A", 1, 2), ("B", 2, 3), ("A", 3, None)], ["A"]),
    "delete then the same value": ([("A", 1), ("d", 2), ("A", 3)], [("A", 1, 2), ("A", 3, None)], ["A"]),
    "NULL is a value": ([("A", 1), (None, 2), (None, 3)], [("A", 1, 2), (None, 2, None)], [None]),
    "ends deleted": ([("A", 1), ("d", 2)], [("A", 1, 2)], []),
    "repeated value": ([("A", 1), ("A", 2)], [("A", 1, None)], ["A"]),
    "only a delete": ([("d", 1)], [], []),
}


@pytest.mark.parametrize("case", FIXED)
def test_fixed_feeds(spark, case):
    changes, history, latest = FIXED[case]
    rows = [
        dict(k=1, seq=s, v=None if v == "d" else v, u=0, op="d" if v == "d" else "u", id=i)
        for i, (v, s) in enumerate(changes)
    ]
    feed = frame(spark, rows)
    got = [(v, a, b) for _, v, _, a, b in versions(apply_changes(feed, spec(track_history_column_list=["v"])))]
    assert got == [(v, epoch(a), epoch(b)) for v, a, b in history]
    assert [r["v"] for r in apply_changes(feed, spec(scd_type=1)).collect()] == latest


def test_null_carry_in_scd1(spark):
    rows = [dict(k=1, seq=s, v=v, u=0, op="u", id=s) for s, v in ((1, "A"), (2, None), (3, None))]
    got = apply_changes(frame(spark, rows), spec(scd_type=1, ignore_null_updates=True)).collect()
    assert [r["v"] for r in got] == ["A"]


def test_refused_rows(spark):
    feed = spark.createDataFrame([(1, None, "A", 1, "u", 1), (None, 1, "A", 1, "u", 2), (2, 5, "A", 1, "u", 3)], SCHEMA)
    assert refused_changes(feed, spec()).count() == 2
    assert [r["k"] for r in apply_changes(feed, spec()).collect()] == [2]
    with pytest.raises(Exception, match="NULL key"):
        apply_changes(feed, spec(on_refused="fail", scd_type=1)).collect()


def test_audit_columns_do_not_open_versions(spark):
    feed = spark.sql(
        "select * from values (1, timestamp'2024-01-01', 'A'), (1, timestamp'2024-01-02', 'A') t(k, __source_updated_at, v)"
    )
    plain = ChangeSpec(keys=["k"], sequence_by="__source_updated_at")
    literal = ChangeSpec(keys=["k"], sequence_by="__source_updated_at", track_audit=True)
    got = apply_changes(feed, plain).collect()
    assert len(got) == 1 and got[0]["__source_updated_at"] == dt.datetime(2024, 1, 2)
    assert apply_changes(feed, literal).count() == 2


def test_map_columns_can_be_tracked(spark):
    feed = spark.sql("select 1 k, s seq, map('a', v) m from values (1, 1), (2, 1), (3, 2) t(s, v)")
    got = apply_changes(feed, ChangeSpec(keys=["k"], sequence_by="seq", except_column_list=["seq"])).collect()
    assert sorted(r["m"]["a"] for r in got) == [1, 2]


@pytest.mark.parametrize(
    "bad", [dict(keys=[]), dict(sequence_by=""), dict(sequence_by=None), dict(scd_type=3), dict(on_refused="skip")]
)
def test_config_errors(bad):
    with pytest.raises(ValueError):
        spec(**bad)


def test_one_shuffle_for_history(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    plan = apply_changes(
        events, ChangeSpec(keys=["user_id"], sequence_by="ts", track_history_column_list=["event_type"]), WHOLE
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


@pytest.mark.parametrize("base", [1_700_000_000_000_000, 1_700_000_000_000_000_000, 2**63 - 4])
def test_large_integer_sequences_keep_their_order(spark, base):
    feed = spark.createDataFrame([(1, base + i, v) for i, v in ((2, "C"), (0, "A"), (1, "B"))], "k int, seq long, v string")
    got = apply_changes(feed, ChangeSpec(keys=["k"], sequence_by="seq", except_column_list=["seq"])).collect()
    assert sorted((r["__START_AT"], r["__END_AT"], r["v"]) for r in got) == [
        (base, base + 1, "A"),
        (base + 1, base + 2, "B"),
        (base + 2, None, "C"),
    ]
