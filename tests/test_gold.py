import os
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.operators.expectations import Expectation, enforce, expectations_of, observe, violation_counts
from strata.operators.gold import Lookup, cons, dimension, fact, mapped, with_skey, with_skey_as_of
from strata.operators.processed import read_rules
from strata.operators.skew import SkewPolicy, find_long_keys

from .brute import as_of, last_started


def random_history(seed):
    rng = random.Random(seed)
    versions, facts = [], []
    for k in [*range(12), 99]:
        at = rng.randint(0, 5)
        for _ in range(300 if k == 99 else rng.randint(0, 5)):
            end = at + rng.randint(1, 4)
            versions.append((k, at, end, len(versions)))
            at = end + rng.choice([0, 0, 3])
    for i in range(900):
        k = 99 if i % 3 == 0 else rng.choice([*range(14), None])
        at = rng.choice([400, rng.randint(0, 1200)]) if k == 99 else rng.randint(0, 30)
        facts.append((i, k, at if rng.random() < 0.97 else None))
    return versions, facts


@pytest.mark.parametrize("way", ["broadcast", "ordered", "sliced"])
def test_as_of_lookup_equals_brute_force(spark, way):
    versions, facts = random_history(4)
    dim = spark.createDataFrame(versions, "k int, s int, e int, k_skey long").select(
        "k", "k_skey", *(F.timestamp_seconds(c).alias(n) for c, n in (("s", "__etl_effective_from"), ("e", "__etl_effective_to")))
    )
    frame = spark.createDataFrame(facts, "id int, k int, t int").withColumn("at", F.timestamp_seconds("t"))
    lookup = Lookup(dim, {"k": "k"}, "k_skey", event_time="at")
    # Without the bound on versions per key, so that "broadcast" really is.
    import strata.operators.gold as module

    limit, module.BROADCAST_VERSIONS = module.BROADCAST_VERSIONS, 10_000
    try:
        skew = SkewPolicy(min_rows=20, target_slices=100, enabled=way == "sliced")
        got = with_skey_as_of(frame, lookup, skew, broadcast_rows=10_000 if way == "broadcast" else 0)
    finally:
        module.BROADCAST_VERSIONS = limit
    want = as_of([(i, k, t) for i, k, t in facts if k is not None and t is not None], versions)
    rows = {r["id"]: r["k_skey"] for r in got.collect()}
    assert rows == {i: want.get(i) for i, _, _ in facts}
    assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) or way != "broadcast"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlapping_versions_have_one_answer(spark, monkeypatch, seed):
    rng = random.Random(seed)
    versions = []
    for i in range(400):
        start = rng.randint(0, 60)
        versions.append((rng.choice([1, 2, 99, 99, 99]), start, start + rng.randint(1, 25), rng.randint(0, 300)))
    facts = [(i, rng.choice([1, 2, 3, 99, 99]), rng.choice([30, rng.randint(0, 90)])) for i in range(700)]
    dim = spark.createDataFrame(versions, "k int, s int, e int, k_skey long").select(
        "k", "k_skey", *(F.timestamp_seconds(c).alias(n) for c, n in (("s", "__etl_effective_from"), ("e", "__etl_effective_to")))
    )
    frame = spark.createDataFrame(facts, "id int, k int, t int").withColumn("at", F.timestamp_seconds("t"))
    lookup = Lookup(dim, {"k": "k"}, "k_skey", event_time="at")
    monkeypatch.setattr("strata.operators.gold.BROADCAST_VERSIONS", 10_000)
    want = last_started(facts, versions)
    ways = {
        "broadcast": with_skey_as_of(frame, lookup),
        "ordered": with_skey_as_of(frame, lookup, SkewPolicy(enabled=False), broadcast_rows=0),
        "bytes": with_skey_as_of(frame, lookup, SkewPolicy(enabled=False), broadcast_bytes=10),
        "sliced": with_skey_as_of(frame, lookup, SkewPolicy(min_rows=20, target_slices=100), broadcast_rows=0),
    }
    for way, got in ways.items():
        rows = got.select("id", "k_skey").collect()
        assert len(rows) == len(facts), way
        assert {r["id"]: r["k_skey"] for r in rows} == want, way
        assert ("BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()) or way != "broadcast"


def test_custom_sql_leaves_views_alone(spark):
    from strata.operators.gold import custom_sql

    spark.range(3).createOrReplaceTempView("mine")
    got = custom_sql(spark, "SELECT count(*) AS n FROM mine JOIN other USING (id)", {"mine": spark.range(7), "other": spark.range(5)})
    assert spark.table("mine").count() == 3 and got.first()["n"] == 5
    assert not spark.catalog.tableExists("other")


def test_crowded_moments_are_found(spark):
    _, facts = random_history(4)
    frame = spark.createDataFrame(facts, "id int, k int, t int").dropna().withColumn("at", F.timestamp_seconds("t"))
    slicing = find_long_keys(frame, ["k"], "at", SkewPolicy(min_rows=20, target_slices=100))
    assert slicing.repeats.count() == 1


def test_many_versions_per_key_are_not_broadcast(spark):
    dim = spark.range(1000).select(
        F.lit(1).alias("k"),
        F.col("id").alias("s"),
        F.timestamp_seconds("id").alias("__etl_effective_from"),
        F.timestamp_seconds(F.col("id") + 1).alias("__etl_effective_to"),
    )
    facts = spark.range(100).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("at"), "id")
    got = with_skey_as_of(facts, Lookup(dim, {"k": "k"}, "s", event_time="at"))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("s = id").count() == 100


def test_current_and_type_1_lookup(spark):
    dim = spark.sql("select * from values (1, 10L, true), (1, 11L, false), (2, 20L, false) t(k, s, __etl_is_current)")
    facts = spark.sql("select * from values (1), (2), (null) t(fk)")
    got = with_skey(facts, Lookup(dim, {"fk": "k"}, "s", into="dim_s", unknown=-1))
    assert got.columns == ["fk", "dim_s"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 10), (2, -1), (None, -1)]
    flat = dim.where("s = 20").drop("__etl_is_current")
    assert {r["fk"]: r["s"] for r in with_skey(facts, Lookup(flat, {"fk": "k"}, "s")).collect()} == {1: None, 2: 20, None: None}


def test_fact_puts_keys_first_and_sheds_audit(spark):
    dim = spark.sql("select 1 k, 10L s")
    facts = spark.sql("select 1 fk, 5 v, current_timestamp() __etl_loaded_at, 1 __etl_processed_at, 1 __source_updated_at")
    assert fact(facts, [Lookup(dim, {"fk": "k"}, "s")]).columns == ["s", "fk", "v"]


def test_audit_matrix(spark):
    names = ["x_skey", "a", "__source_updated_at", "__etl_loaded_at", "__etl_processed_at", "__etl_effective_from",
             "__etl_effective_to", "__etl_is_current"]
    df = spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    kept = ["__etl_effective_from", "__etl_effective_to", "__etl_is_current"]
    assert cons(df).columns == ["x_skey", "a", "__etl_loaded_at", *kept]
    assert dimension(cons(df)).columns == ["x_skey", "a", *kept]


def test_mapped(spark):
    df = spark.sql("select * from values (1, 'x'), (2, 'y') t(a, b)")
    assert mapped(df, filter="a > 1").collect()[0]["b"] == "y"
    assert mapped(df, read_rules([{"source_col": "a", "target_col": "n"}])).columns == ["n"]


RULES = [Expectation("small", "v < 10"), Expectation("even", "v % 2 = 0", "drop")]


def values(spark):
    return spark.sql("select * from values (1), (2), (12), (null) t(v)")


def test_warn_counts_and_drop_in_one_pass(spark):
    checked, counts = observe(values(spark), RULES)
    assert sorted(r["v"] for r in checked.collect()) == [2, 12]
    assert counts.get == {"rows": 4, "small": 2, "even": 2}
    assert {tuple(r) for r in violation_counts(values(spark), RULES).collect()} == {("small", 2, 2), ("even", 2, 2)}


def test_fail_stops_even_if_the_column_is_not_read(spark):
    failing = enforce(values(spark).selectExpr("v", "1 as w"), [Expectation("known", "v is not null", "FAIL")])
    with pytest.raises(Exception, match="expectation known violated"):
        failing.select("w").collect()
    assert enforce(values(spark).dropna(), [Expectation("known", "v is not null", "FAIL")]).count() == 3


def test_fail_holds_under_a_later_filter(spark, tmp_path):
    """Each file alone would be skipped by the filter's statistics."""
    for i, (k, v) in enumerate(((1, 5), (None, -5))):
        spark.createDataFrame([(k, v)], "k int, v int").coalesce(1).write.parquet(f"{tmp_path}/x/part={i}")
    df = spark.read.parquet(f"{tmp_path}/x")
    rules = [Expectation("k_set", "k is not null", "FAIL")]
    with pytest.raises(Exception, match="k_set"):
        enforce(df, rules).where("v > 0").collect()
    assert enforce(df.where("v > 0"), rules).where("v > 0").count() == 1


def test_one_per_key(spark):
    from strata.operators.gold import one_per_key

    df = spark.sql("select * from values (1, 'a', 1), (1, 'b', 2), (1, 'c', 2), (2, 'z', null), (null, 'n', 1) t(k, v, __etl_loaded_at)")
    assert sorted((str(r["k"]), r["v"]) for r in one_per_key(df, ["k"]).collect()) == [("1", "c"), ("2", "z"), ("None", "n")]


def test_expectations_from_columns():
    rules = read_rules(
        [
            {"source_col": "a", "target_col": "a", "is_nullable": False},
            {"source_col": "b", "target_col": "b", "is_nullable": False, "constraint_on_violation": "DROP"},
            {"source_col": "c", "target_col": "c", "constraint_expression": "c > 0", "constraint_name": "pos"},
            {"source_col": "d", "target_col": "d"},
        ]
    )
    assert expectations_of(rules) == [
        Expectation("a_not_null", "`a` is not null", "FAIL"),
        Expectation("b_not_null", "`b` is not null", "DROP"),
        Expectation("pos", "c > 0", "WARN"),
    ]
    with pytest.raises(ValueError, match="on_violation"):
        Expectation("x", "true", "IGNORE")


def test_a_key_twice_in_a_dimension_never_doubles_facts(spark):
    dim = spark.sql("select * from values (1, 10L), (1, 11L), (2, 20L), (null, 30L), (null, 31L) t(k, s)")
    facts = spark.sql("select * from values (1, 'a'), (2, 'b'), (null, 'c') t(fk, v)")
    with pytest.raises(Exception, match="s: the dimension has more than one row of the key 1"):
        with_skey(facts, Lookup(dim, {"fk": "k"}, "s")).collect()
    got = with_skey(facts, Lookup(dim, {"fk": "k"}, "s", repeated="largest"))
    assert {r["v"]: r["s"] for r in got.collect()} == {"a": 11, "b": 20, "c": None} and got.count() == 3
    unique = dim.where("k = 2 or k is null")
    assert {r["v"]: r["s"] for r in with_skey(facts, Lookup(unique, {"fk": "k"}, "s", unknown=-1)).collect()} == {"a": -1, "b": 20, "c": -1}
    with pytest.raises(ValueError, match="repeated"):
        Lookup(dim, {"fk": "k"}, "s", repeated="first")


def periods(spark, key, name, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(6):
        at = rng.randint(0, 10)
        for _ in range(rng.randint(0, 6)):
            end = at + rng.randint(1, 9)
            rows.append((k, at, end, 100 * seed + len(rows)))
            at = end + rng.choice([0, 0, 4])
    dim = spark.createDataFrame(rows, f"{key} int, s int, e int, {name} long").select(
        key, name, *(F.timestamp_seconds(c).alias(n) for c, n in (("s", "__etl_effective_from"), ("e", "__etl_effective_to")))
    )
    return rows, dim


@pytest.mark.parametrize("sliced", [False, True])
def test_several_lookups_in_one_pass_equal_brute_force(spark, sliced):
    rng = random.Random(8)
    facts = [tuple(rng.choice([*range(7), None]) for _ in range(3)) + (rng.choice([None, 5, 5, *range(50)]), rng.choice([None, *range(50)])) for _ in range(600)]
    facts = [(i, *f) for i, f in enumerate(facts + facts[:100])]
    frame = spark.createDataFrame(facts, "id int, a int, b int, c int, t int, u int").withColumns(
        {"at": F.timestamp_seconds("t"), "until": F.timestamp_seconds("u")}
    )
    (rows_a, dim_a), (rows_b, dim_b) = periods(spark, "a", "a_skey", 1), periods(spark, "k", "b_skey", 2)
    flat = spark.createDataFrame([(k, k * 10) for k in range(5)], "c int, c_skey long")
    chained = spark.createDataFrame([(k * 10, k) for k in range(4)], "c_skey long, d_skey long")
    lookups = [
        Lookup(dim_a, {"a": "a"}, "a_skey", event_time="at"),
        Lookup(flat, {"c": "c"}, "c_skey"),
        Lookup(chained, {"c_skey": "c_skey"}, "d_skey", unknown=-1),
        Lookup(dim_b, {"b": "k"}, "b_skey", event_time="until", unknown=-1),
    ]
    skew = SkewPolicy(min_rows=20, target_slices=100, enabled=sliced)
    got = fact(frame, lookups, skew, broadcast_rows=0)
    assert got.columns == ["a_skey", "c_skey", "d_skey", "b_skey", *frame.columns]
    want_a = as_of([(f[0], f[1], f[4]) for f in facts if f[1] is not None and f[4] is not None], rows_a)
    want_b = as_of([(f[0], f[2], f[5]) for f in facts if f[2] is not None and f[5] is not None], rows_b)
    want = {}
    for i, _, _, c, _, _ in facts:
        c_skey = c * 10 if c is not None and c < 5 else None
        b_skey = want_b.get(i)
        want[i] = (want_a.get(i), c_skey, c_skey // 10 if c_skey is not None and c_skey < 40 else -1, -1 if b_skey is None else b_skey)
    for frame_of in (got, fact(frame, lookups, skew)):
        rows = frame_of.collect()
        assert len(rows) == len(facts)
        assert {r["id"]: (r["a_skey"], r["c_skey"], r["d_skey"], r["b_skey"]) for r in rows} == want


def test_facts_are_shuffled_once_for_all_large_dimensions(spark):
    dims = [periods(spark, "k", f"skey_{i}", i)[1] for i in range(3)]
    facts = spark.range(200).selectExpr("id", "id % 5 as a", "id % 6 as b", "id % 7 as c", "timestamp_seconds(id % 40) as at", "id * 2 as amount")
    lookups = [Lookup(dim, {ours: "k"}, f"skey_{i}", event_time="at") for i, (dim, ours) in enumerate(zip(dims, "abc"))]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = fact(facts, lookups, broadcast_rows=0)._jdf.queryExecution().explainString(formatted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    exchanges = [node for node in plan.split("\n\n") if ") Exchange" in node]
    assert len(exchanges) > 4
    assert len([node for node in exchanges if "amount#" in node]) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lookups_of_large_dimensions_shuffle_number_key_and_time_only(spark):
    dims = [periods(spark, "k", f"skey_{i}", i)[1] for i in range(3)]
    facts = spark.range(200).selectExpr("id", "id % 5 as a", "id % 6 as b", "id % 7 as c", "timestamp_seconds(id % 40) as at", "id * 2 as amount")
    lookups = [Lookup(dim, {ours: "k"}, f"skey_{i}", event_time="at") for i, (dim, ours) in enumerate(zip(dims, "abc"))]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = fact(facts, lookups, broadcast_rows=0)._jdf.queryExecution().explainString(formatted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    narrow = [node for node in plan.split("\n\n") if ") Exchange" in node and "amount#" not in node]
    widths = sorted(int(re.search(r"Input \[(\d+)\]", node).group(1)) for node in narrow)
    # By number: the number and the key found. By dimension key: key, time and number, or the version with its end and key.
    assert widths == [2, 2, 2, 5, 5, 5]


def test_the_written_facts_are_small(spark):
    """Their written copy counts as the shuffles do: a number and few values a fact."""
    dims = [periods(spark, "k", f"skey_{i}", i)[1] for i in range(2)]
    facts = spark.range(0, 50_000, 1, 1).selectExpr("id div 4 as a", "id div 3 as b", "timestamp_seconds(id div 4) as at")
    lookups = [Lookup(dim, {ours: "k"}, f"skey_{i}", event_time="at") for i, (dim, ours) in enumerate(zip(dims, "ab"))]
    copy = [f for f in fact(facts, lookups, broadcast_rows=0).inputFiles() if "/facts-" in f]
    size = sum(os.path.getsize(f.removeprefix("file:").replace("//", "/")) for f in copy)
    assert 0 < size < 9 * 50_000


def test_facts_of_several_lookups_are_computed_once(spark):
    """The keys of a fact are those of the time that it is given with, also where each run would give another time."""
    drawn = F.udf(lambda i: random.randrange(3000), "int").asNondeterministic()
    dims = [
        spark.range(3000).select(
            F.lit(k).alias("k"), (F.col("id") + k).alias(f"s{k}"),
            F.timestamp_seconds("id").alias("__etl_effective_from"), F.timestamp_seconds(F.col("id") + 1).alias("__etl_effective_to"),
        )
        for k in (1000, 5000)
    ]
    facts = spark.range(500).select("id", F.lit(1000).alias("a"), F.lit(5000).alias("b"), F.timestamp_seconds(drawn("id")).alias("at"))
    lookups = [Lookup(dims[0], {"a": "k"}, "s1000", event_time="at"), Lookup(dims[1], {"b": "k"}, "s5000", event_time="at")]
    rows = fact(facts, lookups, broadcast_rows=0).withColumn("second", F.unix_seconds("at")).collect()
    assert sorted(r["id"] for r in rows) == list(range(500))
    assert all((r["s1000"], r["s5000"]) == (r["second"] + 1000, r["second"] + 5000) for r in rows)


def test_several_lookups_keep_columns_and_odd_facts(spark):
    """Columns of any type stay, one named like the number too; facts that are alike stay as many as they are."""
    dims = [periods(spark, "k", f"skey_{i}", i)[1] for i in range(2)]
    facts = spark.sql("select null as nothing, map('x', id % 2) as m, id % 3 as __number, id % 5 as a, timestamp_seconds(id % 4) as at from range(300)")
    lookups = [Lookup(dim, {"a": "k"}, f"skey_{i}", event_time="at") for i, dim in enumerate(dims)]
    got = fact(facts, lookups, broadcast_rows=0)
    assert got.columns == ["skey_0", "skey_1", *facts.columns] and got.schema["nothing"].dataType == facts.schema["nothing"].dataType
    kept = ["m.x", "__number", "a", "at"]
    assert sorted(got.selectExpr(*kept).collect()) == sorted(facts.selectExpr(*kept).collect())
    assert fact(facts.limit(0), lookups, broadcast_rows=0).collect() == []


def test_repeated_instants_meet_versions_once(spark):
    """A key with many versions and many instants at which facts crowd: no version is paired with each instant."""
    versions, instants, each = 3000, 60, 40
    dim = spark.range(versions).select(
        F.lit(1).alias("k"), F.col("id").alias("s"),
        F.timestamp_seconds("id").alias("__etl_effective_from"), F.timestamp_seconds(F.col("id") + 1).alias("__etl_effective_to"),
    )
    facts = spark.range(instants * each).select(F.lit(1).alias("k"), "id", F.timestamp_seconds(F.col("id") % instants * 50).alias("at"))
    got = with_skey_as_of(facts, Lookup(dim, {"k": "k"}, "s", event_time="at"), SkewPolicy(min_rows=20, target_slices=1_000_000), broadcast_rows=0)
    assert got.where(F.col("s") == F.unix_seconds("at")).count() == instants * each
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ">= __from" not in plan
