import uuid

import pytest

from strata.operators.tables import append_table, enter_load, load_once, stage_load
from strata.plans import Medallion


def name():
    return f"load_{uuid.uuid4().hex[:8]}"


def ids(spark, table):
    return sorted(r["id"] for r in spark.table(table).collect())


def test_a_load_counts_once_wherever_it_stopped(spark, tmp_path):
    table, place = name(), f"{tmp_path}/t"
    rows = lambda a, b: spark.range(a, b, 1, 3)
    assert load_once(rows(0, 5), table, place, "a")
    assert not load_once(rows(0, 5), table, place, "a")
    # Stopped while it was written: no seal, so the rows are written anew.
    rows(90, 95).write.parquet(f"{place}/_loads/b/rows")
    assert ids(spark, table) == [0, 1, 2, 3, 4]
    assert load_once(rows(5, 8), table, place, "b")
    assert ids(spark, table) == list(range(8))
    # Stopped between seal and entry: the sealed rows count, even if the source has others by now.
    assert stage_load(rows(8, 10), table, place, "c")
    assert ids(spark, table) == list(range(8))
    assert load_once(rows(8, 99), table, place, "c")
    assert ids(spark, table) == list(range(10))
    # Stopped half way through the files.
    stage_load(rows(10, 20), table, place, "d")
    part = sorted(tmp_path.glob("t/_loads/d/rows/part-*"))[0]
    part.rename(tmp_path / "t" / part.name)
    assert load_once(rows(10, 20), table, place, "d")
    assert ids(spark, table) == list(range(20))
    assert not load_once(rows(10, 20), table, place, "d")
    append_table(rows(20, 22), table, place)
    assert ids(spark, table) == list(range(22))


def test_loads_of_nothing_and_of_other_columns(spark, tmp_path):
    table, place = name(), f"{tmp_path}/t"
    assert load_once(spark.range(0), table, place, "none")
    assert not load_once(spark.range(0), table, place, "none")
    assert load_once(spark.range(1).selectExpr("'x' AS more", "id"), table, place, "wide")
    assert load_once(spark.range(1, 2).toDF("id"), table, place, "narrow")
    assert sorted(map(tuple, spark.table(table).collect())) == [(0, "x"), (1, None)]
    with pytest.raises(ValueError, match="types differ"):
        load_once(spark.range(1).selectExpr("'x' AS id"), table, place, "changed")
    with pytest.raises(ValueError, match="load id"):
        load_once(spark.range(1), table, place, "../a")
    with pytest.raises(ValueError, match="not written"):
        enter_load(spark, table, "never")


def test_a_stream_reads_entered_loads_only(spark, tmp_path):
    table, place = name(), f"{tmp_path}/t"

    def read():
        query = spark.readStream.table(table).writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
        query.format("parquet").start(f"{tmp_path}/out").awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    load_once(spark.range(3), table, place, "a")
    stage_load(spark.range(3, 5), table, place, "b")
    assert read() == [0, 1, 2]
    load_once(spark.range(3, 5), table, place, "b")
    load_once(spark.range(3), table, place, "a")
    assert read() == [0, 1, 2, 3, 4]


def test_registry_run_again_under_its_id(spark, tmp_path):
    hop = f"bronze_{uuid.uuid4().hex[:8]}"
    spark.range(4).selectExpr("id AS k", "timestamp'2024-01-01 00:00:00' AS at").write.parquet(f"{tmp_path}/in/thing")
    registry = {
        "hops": {"l01": {"schema": hop}},
        "source_systems": {
            "s": {
                "source_type": "cloud_storage",
                "connection": {"cloud_storage_path": f"{tmp_path}/in/{{object}}", "cloud_storage_type": "parquet"},
                "defaults": {"l01": {"enabled": True, "ingestion_mode": "snapshot", "merge_strategy": "append", "source_updated_at_col": "at"}},
                "dimensions": {"thing": "k"},
            }
        },
    }
    count = lambda: spark.table(f"{hop}.raw_thing").count()
    for load_id, rows in (("monday", 4), ("monday", 4), ("tuesday", 8)):
        Medallion(spark, registry, f"{tmp_path}/lake", load_id=load_id).run(("l01",))
        assert count() == rows
    Medallion(spark, registry, f"{tmp_path}/lake").run(("l01",))
    assert count() == 12, "without an id, each run is a load"
