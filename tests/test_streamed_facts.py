import pytest

from strata.operators.expectations import Expectation
from strata.operators.gold import Lookup, with_skey_as_of
from strata.plans import Medallion
from strata.streaming.facts import land_facts, landed_facts, narrowed, resolve_late

VERSIONS = "k int, s long, __etl_effective_from timestamp, __etl_effective_to timestamp"


def versions(spark, rows):
    return spark.createDataFrame(rows, "k int, s long, a string, b string").selectExpr(
        "k", "s", "cast(a as timestamp) as __etl_effective_from", "cast(b as timestamp) as __etl_effective_to"
    )


DIM = [(1, 10, "2024-01-01", "2024-02-01"), (1, 11, "2024-02-01", "9999-12-31"), (2, 20, "2024-01-15", "9999-12-31")]


def landed(spark, tmp_path, rows, part):
    df = spark.createDataFrame(rows, "id int, k int, at string").selectExpr("id", "k", "cast(at as timestamp) as at")
    df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/raw")


def lookups(path):
    return lambda spark: [Lookup(spark.read.schema(VERSIONS).parquet(path), {"k": "k"}, "s", event_time="at", unknown=-1)]


FACTS = [[(1, 1, "2024-01-10"), (2, 1, "2024-03-01")], [(3, 2, "2024-01-01"), (4, 2, "2024-02-01")], [(5, None, "2024-02-01"), (6, 1, None)]]
EXPECTED = {1: 10, 2: 11, 3: -1, 4: 20, 5: -1, 6: -1}


@pytest.mark.parametrize("bound", [500_000, 0])
def test_any_size_of_dimension(spark, tmp_path, bound):
    versions(spark, DIM).write.parquet(f"{tmp_path}/dim")
    for part, rows in enumerate(FACTS):
        stream = landed(spark, tmp_path, rows, part)
    land_facts(stream, lookups(f"{tmp_path}/dim"), f"{tmp_path}/c", f"{tmp_path}/facts", broadcast_rows=bound)
    assert {r["id"]: r["s"] for r in landed_facts(spark, f"{tmp_path}/facts").collect()} == EXPECTED
    assert landed_facts(spark, f"{tmp_path}/facts").count() == 6


def test_streams_are_refused_whatever_the_size(spark, tmp_path):
    stream = landed(spark, tmp_path, FACTS[0], 0)
    lookup = Lookup(versions(spark, DIM), {"k": "k"}, "s", event_time="at")
    for bound in (500_000, 0):
        with pytest.raises(ValueError, match="land_facts"):
            with_skey_as_of(stream, lookup, broadcast_rows=bound)


def test_a_failed_micro_batch_counts_once(spark, tmp_path):
    """The second micro-batch writes its rows and fails before the stream knows: it runs again."""
    versions(spark, DIM).write.parquet(f"{tmp_path}/dim")
    for part, rows in enumerate(FACTS):
        stream = landed(spark, tmp_path, rows, part)
    calls = []

    def breaking(spark):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return lookups(f"{tmp_path}/dim")(spark)

    with pytest.raises(Exception, match="lost"):
        land_facts(stream, breaking, f"{tmp_path}/c", f"{tmp_path}/facts")
    assert landed_facts(spark, f"{tmp_path}/facts").count() == 4
    # As if the second one had not been entered: its entry in the checkpoint goes.
    for name in ("2", ".2.crc", "1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    land_facts(stream, lookups(f"{tmp_path}/dim"), f"{tmp_path}/c", f"{tmp_path}/facts")
    rows = landed_facts(spark, f"{tmp_path}/facts").collect()
    assert sorted((r["id"], r["s"]) for r in rows) == sorted(EXPECTED.items())


def test_dimension_is_read_anew_and_counts_add_up(spark, tmp_path):
    versions(spark, DIM[:1]).write.parquet(f"{tmp_path}/dim")
    table = "spark_catalog.streamed_facts.fact"
    rules = [Expectation("known", "s <> -1")]
    stream = landed(spark, tmp_path, FACTS[0], 0)
    found = land_facts(stream, lookups(f"{tmp_path}/dim"), f"{tmp_path}/c", f"{tmp_path}/facts", table, expectations=rules)
    assert found == {"rows": 2, "known": 1}
    versions(spark, DIM[1:]).write.mode("append").parquet(f"{tmp_path}/dim")
    for part, rows in enumerate(FACTS[1:], 1):
        stream = landed(spark, tmp_path, rows, part)
    found = land_facts(stream, lookups(f"{tmp_path}/dim"), f"{tmp_path}/c", f"{tmp_path}/facts", table, expectations=rules)
    assert found == {"rows": 4, "known": 3}
    assert {r["id"]: r["s"] for r in spark.table(table).collect()} == {**EXPECTED, 2: -1}
    assert spark.table(table).columns == ["s", "id", "k", "at"]
    assert land_facts(stream, lookups(f"{tmp_path}/dim"), f"{tmp_path}/c", f"{tmp_path}/facts", table, expectations=rules) == {}
    assert spark.table(table).count() == 6


def test_a_small_batch_narrows_the_dimension(spark):
    facts = spark.createDataFrame([(1,), (1,), (None,)], "fk int")
    lookup = Lookup(versions(spark, DIM), {"fk": "k"}, "s", event_time="at")
    assert narrowed(lookup, facts).dimension.count() == 2
    assert narrowed(lookup, facts, most=0) is lookup
    assert narrowed(lookup, facts).dimension.columns == lookup.dimension.columns


def registry(**gold):
    hop = {"object_name": "fact_x", "source_object": "raw_x", "read_mode": "stream", "append_only_source": True, "write_mode": "streaming_table", **gold}
    return {"hops": {"gold": {"schema": "streamed_refusals"}, "l01": {"schema": "streamed_refusals"}}, "source_systems": {}, "gold": [hop]}


@pytest.mark.parametrize(
    ("more", "said"),
    [
        ({"primary_key_columns": ["id"]}, "primary_key_columns need read_mode 'snapshot'"),
        ({"write_mode": "materialized_view", "lookups": [{"dimension": "d", "on": "k", "skey": "s"}]}, "streaming_table"),
        ({"create_scd2_view": True, "lookups": [{"dimension": "d", "on": "k", "skey": "s"}]}, "create_scd2_view"),
    ],
)
def test_refusals(spark, tmp_path, more, said):
    spark.sql("create schema if not exists spark_catalog.streamed_refusals")
    spark.sql("create table if not exists spark_catalog.streamed_refusals.raw_x (id int, k int) using parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError, match=said):
        Medallion(spark, registry(**more), str(tmp_path)).run()


LATE = [[(1, 1, "2024-01-10"), (2, 7, "2024-03-01")], [(3, 2, "2024-02-01"), (4, 8, "2024-02-01"), (5, None, "2024-02-01")], [(6, 1, None), (7, 1, "2024-01-11")]]


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("bound", [500_000, 0])
def test_facts_of_late_versions_are_found_and_others_stay(spark, tmp_path, bound):
    versions(spark, DIM).write.parquet(f"{tmp_path}/dim")
    for part, rows in enumerate(LATE):
        stream = landed(spark, tmp_path, rows, part)
    where = (lookups(f"{tmp_path}/dim"), f"{tmp_path}/facts")
    land_facts(stream, where[0], f"{tmp_path}/c", where[1], broadcast_rows=bound, late=True)

    def answers():
        rows = landed_facts(spark, where[1]).collect()
        assert len(rows) == 7
        return {r["id"]: r["s"] for r in rows}

    before = {1: 10, 2: -1, 3: 20, 4: -1, 5: -1, 6: -1, 7: 10}
    assert answers() == before
    assert resolve_late(spark, *where, broadcast_rows=bound) == 0
    held = files_of(tmp_path / "facts")
    # User 7 comes, and a version of user 1 that facts found long ago do not take.
    late = [(7, 70, "2024-01-01", "2024-12-31"), (1, 99, "2024-01-05", "2024-01-20")]
    versions(spark, late).write.mode("append").parquet(f"{tmp_path}/dim")
    assert resolve_late(spark, *where, broadcast_rows=bound) == 1
    assert answers() == {**before, 2: 70}
    gone = {path for path in held if path not in files_of(tmp_path / "facts")}
    assert gone and all("/open/" in path or "/pending/" in path for path in gone)
    assert len({path.rsplit("/", 2)[1] for path in gone}) == 1
    assert resolve_late(spark, *where, broadcast_rows=bound) == 0
    versions(spark, [(8, 80, "2024-01-01", "2024-12-31")]).write.mode("append").parquet(f"{tmp_path}/dim")
    assert resolve_late(spark, *where, broadcast_rows=bound) == 1
    assert answers() == {**before, 2: 70, 4: 80}
    # Facts without key or time wait for nothing.
    assert spark.read.parquet(f"{where[1]}/pending").count() == 0


def test_resolving_goes_on_after_a_failure_between_its_writes(spark, tmp_path, monkeypatch):
    import strata.streaming.facts as module

    versions(spark, DIM).write.parquet(f"{tmp_path}/dim")
    stream = landed(spark, tmp_path, LATE[0], 0)
    where = (lookups(f"{tmp_path}/dim"), f"{tmp_path}/facts")
    land_facts(stream, where[0], f"{tmp_path}/c", where[1], late=True)
    versions(spark, [(7, 70, "2024-01-01", "2024-12-31")]).write.mode("append").parquet(f"{tmp_path}/dim")

    def broken(*_):
        raise RuntimeError("lost")

    whole = module._as_pending
    monkeypatch.setattr(module, "_as_pending", broken)
    with pytest.raises(RuntimeError, match="lost"):
        resolve_late(spark, *where)
    monkeypatch.setattr(module, "_as_pending", whole)
    assert resolve_late(spark, *where) == 1
    assert {r["id"]: r["s"] for r in landed_facts(spark, where[1]).collect()} == {1: 10, 2: 70}


def test_nothing_is_pending_where_nothing_landed(spark, tmp_path):
    assert resolve_late(spark, lookups(f"{tmp_path}/dim"), f"{tmp_path}/facts") == 0


def test_late_dimensions_need_a_stream(spark, tmp_path):
    spark.sql("create schema if not exists spark_catalog.streamed_refusals")
    spark.sql("create table if not exists spark_catalog.streamed_refusals.raw_x (id int, k int) using parquet")
    with pytest.raises(ValueError, match="late_dimensions"):
        Medallion(spark, registry(late_dimensions=True), str(tmp_path)).run()
