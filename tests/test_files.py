import json
import uuid

import pytest

from strata.operators.raw import RawSpec, raw
from strata.streaming.files import land_files, lands_by_batch


@pytest.fixture(params=["parquet", "orc"])
def lake(spark, tmp_path, request):
    kind, table = request.param, f"files_{uuid.uuid4().hex[:8]}"

    class Lake:
        def put(self, rows, folder="in"):
            rows.coalesce(1).write.mode("append").format(kind).save(f"{tmp_path}/{folder}")

        def land(self, path="in", spec=RawSpec(), **more):
            connection = {"cloud_storage_type": kind, "cloud_storage_path": f"{tmp_path}/{path}", **more}
            land_files(spark, connection, lambda df: raw(df, spec), f"{tmp_path}/check", f"{tmp_path}/raw", table)

        def rows(self):
            found = [r.asDict(True) for r in spark.table(table).collect()]
            assert all(r["__source_updated_at"] and r["__etl_loaded_at"] for r in found)
            return sorted(({k: v for k, v in r.items() if not k.startswith("__") and v is not None} for r in found), key=lambda r: r["id"])

    return Lake()


def test_fields_and_types_of_every_file_land(spark, lake):
    lake.put(spark.sql("select 1 id, named_struct('a', 1) s"))
    lake.land()
    # One micro-batch with a new field, a new field within, a wider number, and a text that is none.
    lake.put(spark.sql("select 2 id, named_struct('a', 2, 'b', 'x') s, 'new' more"))
    lake.put(spark.sql("select 3L id, named_struct('a', 3) s"))
    lake.put(spark.sql("select 4 id, 'flat' s"))
    lake.land()
    lake.land()
    assert lake.rows() == [
        {"id": 1, "s": {"a": 1, "b": None}},
        {"id": 2, "s": {"a": 2, "b": "x"}, "more": "new"},
        {"id": 3, "s": {"a": 3, "b": None}},
        {"id": 4, "_rescued_data": '{"s":"flat"}'},
    ]


def test_what_a_cast_would_lose_is_rescued(spark, lake):
    lake.put(spark.sql("select 1 id, 1 n, 'x' t"))
    lake.land(max_files_per_trigger=1)
    lake.put(spark.sql("select 2 id, 5000000000L n, 7 t"))
    lake.put(spark.sql("select 3 id, 1.5D n, 'y' t"))
    lake.put(spark.sql("select 4 id, 2.0D n, cast(null as string) t"))
    lake.land(max_files_per_trigger=1)
    found = lake.rows()
    assert [(r["id"], r.get("n"), r.get("t")) for r in found] == [(1, 1, "x"), (2, None, "7"), (3, None, "y"), (4, 2, None)]
    assert [json.loads(r["_rescued_data"]) for r in found if "_rescued_data" in r] == [{"n": 5000000000}, {"n": 1.5}]


def test_folders_projection_and_patterns(spark, lake):
    lake.put(spark.sql("select 1 id, 'a' v, 0 w"), "in/day=5")
    lake.put(spark.sql("select 2 id, 'b' v, 0 w"), "in/day=6")
    lake.land("i*", RawSpec(data_items=["id", "upper(v) AS v", "day"], filter="id < 9"))
    lake.put(spark.sql("select 3 id, 'c' v, 'more' x"), "in/day=7")
    lake.put(spark.sql("select 9 id, 'c' v, 'more' x"), "in/day=7")
    lake.land("i*", RawSpec(data_items=["id", "upper(v) AS v", "day"], filter="id < 9"))
    assert lake.rows() == [{"id": 1, "v": "A", "day": 5}, {"id": 2, "v": "B", "day": 6}, {"id": 3, "v": "C", "day": 7}]


def test_tables_of_the_file_sink_stay_as_they_are(spark, tmp_path):
    connection = {"cloud_storage_type": "parquet", "cloud_storage_path": f"{tmp_path}/in"}
    assert lands_by_batch(spark, connection, f"{tmp_path}/raw")
    assert not lands_by_batch(spark, {**connection, "schema": "id int"}, f"{tmp_path}/raw")
    assert not lands_by_batch(spark, {**connection, "cloud_storage_type": "csv"}, f"{tmp_path}/raw")
    (tmp_path / "raw" / "_spark_metadata").mkdir(parents=True)
    assert not lands_by_batch(spark, connection, f"{tmp_path}/raw")
