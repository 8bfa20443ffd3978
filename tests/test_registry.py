import uuid

import pytest

from strata.operators.tables import append_table, create_current_view, ensure_table, replace_table
from strata.plans import Medallion, load_registry, plan_objects
from strata.plans.specs import ObjectEntry


def registry(**changes):
    source = {
        "source_type": "cloud_storage",
        "connection": {"cloud_storage_path": "/in/{object}/", "cloud_storage_type": "csv", "header": True},
        "defaults": {
            "l01": {"enabled": True, "ingestion_mode": "streaming", "merge_strategy": "append"},
            "l02": {"enabled": True, "sequence_by": "__source_updated_at", "ignore_null_updates": True},
            "l03": {"enabled": True, "write_mode": "materialized_view", "read_mode": "snapshot"},
        },
        "dimensions": {"material": "material_key", "component_bom": ["parent_material_key", "component_key"]},
        "facts": {"sales": {"primary_key_columns": ["plant_key", "material_key"], "comment": "sold", "l02": {"tie_breaker": ["id"]}}},
    }
    return {"catalog": "spark_catalog", "source_systems": {"erp": {**source, **changes}}}


def by_name(specs):
    return {s.table.rsplit(".", 1)[1]: s for s in specs}


def test_specs_of_a_registry():
    specs = plan_objects(registry())
    assert [s.layer for s in specs] == ["l01"] * 3 + ["l02"] * 3 + ["l03"] * 3
    assert [s.object_key for s in specs[:3]] == ["material", "component_bom", "sales"]
    found = by_name(specs)
    assert found["raw_sales"].table == "spark_catalog.01_bronze.raw_sales"
    assert found["raw_sales"].location == "bronze/raw_sales"
    assert found["raw_sales"].option("connection") == {
        "cloud_storage_path": "/in/sales/", "cloud_storage_type": "csv", "header": True, "null_value": "^^",
    }
    cdc = found["cdc_component_bom"]
    assert cdc.source_table == "spark_catalog.01_bronze.raw_component_bom"
    assert cdc.changes().keys == ("parent_material_key", "component_key")
    assert (cdc.changes().scd_type, found["cdc_sales"].changes().scd_type) == (2, 1)
    assert cdc.changes().ignore_null_updates is True
    assert found["cdc_sales"].changes().tie_breaker == ["id"]
    done = found["processed_sales"]
    assert done.source_table == "spark_catalog.02_silver.cdc_sales"
    assert (done.processed().skey_column, done.processed().business_key_columns) == ("sales_skey", ("plant_key", "material_key"))
    assert done.comment == "sold"


def test_enabled_and_layers():
    assert [s.layer for s in plan_objects(registry(), ("l02",))] == ["l02"] * 3
    off = registry(defaults={"l01": {"enabled": True}, "l02": {"sequence_by": "x"}, "l03": {"enabled": False}})
    assert {s.layer for s in plan_objects(off)} == {"l01"}
    one = registry(facts={"sales": {"primary_key_columns": "k", "enabled": False}}, dimensions=None)
    assert plan_objects(one) == []


def test_overrides_and_settings():
    one = registry(
        facts={"sales": {"primary_key_columns": "k", "l02": {"scd_type": 2, "schema": "other"}, "l01": {"object_name": "landing"}}}
    )
    one |= {"settings": {"end_date": "2999-01-01 00:00:00", "null_value": "NULL"}, "hops": {"l03": {"name": "done"}}}
    found = by_name(plan_objects(one))
    assert found["cdc_sales"].table == "spark_catalog.other.cdc_sales"
    assert found["cdc_sales"].source_table.endswith(".landing")
    assert found["cdc_sales"].changes().scd_type == 2
    assert found["done_sales"].source_table == "spark_catalog.other.cdc_sales"
    assert found["done_sales"].processed().end_of_time == "2999-01-01 00:00:00"
    assert found["landing"].option("connection")["null_value"] == "NULL"


def test_key_forms():
    read = lambda value: ObjectEntry.read("fact", "o", value)
    assert read("a").keys == ("a",) and read(["a", "b"]).keys == ("a", "b") and read(None).keys == ()
    entry = read({"primary_key_columns": "a", "comment": "x", "l01": {"filter": "f"}})
    assert (entry.keys, entry.section("l01"), entry.section("l02")) == (("a",), {"comment": "x", "filter": "f"}, {"comment": "x"})
    assert entry.placed({"p": "/{object}/x", "n": 3, "q": ["{object}"]}) == {"p": "/o/x", "n": 3, "q": ["o"]}
    for bad in (5, ["a", 1], {"primary_key_columns": 7}):
        with pytest.raises(ValueError, match="keys must be"):
            read(bad)


@pytest.mark.parametrize(
    "changes, text",
    [
        ({"defaults": {"l01": {"enabled": True, "ingestion_mode": "streaming", "merge_strategy": "overwrite"}}}, "overwritten"),
        ({"defaults": {"l01": {"enabled": True, "merge_strategy": "upsert"}}}, "upserts"),
        ({"defaults": {"l02": {"enabled": True}}}, "sequence_by"),
        ({"defaults": {"l02": {"enabled": True, "sequence_by": "s"}}, "facts": {"f": None}, "dimensions": {}}, "key"),
        ({"defaults": {"l03": {"enabled": True, "read_mode": "stream"}}}, "snapshot"),
        ({"source_type": "jdbc", "defaults": {"l01": {"enabled": True}}}, "source_updated_at_col"),
        ({"source_type": "lakehouse_federation", "defaults": {"l01": {"enabled": True}}}, "source_updated_at_col"),
        ({"defaults": {"l02": {"enabled": True, "sequence_by": "s", "apply_as_delete": "x"}}}, "apply_as_delete"),
        ({"facts": {"f": {"primary_key_columns": "k", "l03": {"lead_columns": ["k"]}}}}, "lead_columns"),
        ({"facts": {"f": 5}}, "keys must be"),
    ],
)
def test_refusals_before_any_job(changes, text):
    with pytest.raises(ValueError, match=text):
        plan_objects(registry(**changes))


def test_gold_entries():
    one = registry() | {
        "gold": [
            {"object_name": "cons_a", "source_object": "processed_material"},
            {"object_name": "dim_a", "source_object": "cons_a"},
            {"object_name": "off", "source_object": "cons_a", "enabled": False},
        ]
    }
    found = by_name(plan_objects(one))
    assert found["cons_a"].source_table == "spark_catalog.02_silver.processed_material"
    assert found["dim_a"].source_table == "spark_catalog.03_gold.cons_a"
    assert "off" not in found
    with pytest.raises(ValueError, match="custom_sql"):
        plan_objects(registry() | {"gold": [{"object_name": "x"}]})


@pytest.mark.parametrize(
    "entry, text",
    [
        ({"source_object": "cons_a", "filtr": "x"}, "filtr"),
        ({"source_object": "cons_a", "lookups": [{"dimension": "dim_a", "on": "k"}]}, "needs skey"),
        ({"source_object": "cons_a", "lookups": [{"dimension": "dim_a", "on": "k", "skey": "s", "event": "t"}]}, "event"),
        ({"custom_sql": "SELECT 1", "lookups": [{"dimension": "dim_a", "on": "k", "skey": "s"}]}, "custom_sql"),
        ({"custom_sql": "SELECT * FROM STREAM(spark_catalog.02_silver.processed_material)"}, "snapshot"),
        ({"custom_sql": "select * from stream( processed_sales )", "write_mode": "streaming_table"}, "snapshot"),
    ],
)
def test_gold_refusals(entry, text):
    with pytest.raises(ValueError, match=text):
        plan_objects(registry() | {"gold": [{"object_name": "x", **entry}]})


def test_gold_goes_by_sources():
    gold = [
        {"object_name": "fact_a", "source_object": "cons_b", "lookups": [{"dimension": "dim_a", "on": "k", "skey": "s"}]},
        {"object_name": "dim_a", "source_object": "cons_a"},
        {"object_name": "cons_b", "custom_sql": "SELECT * FROM spark_catalog.03_gold.cons_a"},
        {"object_name": "cons_a", "source_object": "processed_material"},
    ]
    order = [s.object_key for s in plan_objects(registry() | {"gold": gold}) if s.layer == "gold"]
    assert order == ["cons_a", "dim_a", "cons_b", "fact_a"]
    with pytest.raises(ValueError, match="circle"):
        plan_objects(registry() | {"gold": [{"object_name": "a", "source_object": "b"}, {"object_name": "b", "source_object": "a"}]})


def test_medallion_needs_utc(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Medallion(spark, registry(), str(tmp_path)).run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "objects.yml"
    path.write_text("source_systems:\n  erp:\n    defaults:\n      l01: {enabled: true}\n    dimensions:\n      a: k\n    facts:\n")
    assert [s.object_key for s in plan_objects(load_registry(str(path)))] == ["a"]


def test_object_files(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "objects.yml").write_text(
        "source_systems:\n  erp:\n    defaults:\n      l02: {enabled: true, metadata_driven: false, sequence_by: s}\n"
        "    dimensions:\n      a: k\n"
    )
    with pytest.raises(ValueError, match="own l02 section"):
        plan_objects(load_registry(f"{tmp_path}/objects.yml"))
    (tmp_path / "silver" / "cdc").mkdir(parents=True)
    (tmp_path / "silver" / "cdc" / "cdc_a.yml").write_text("object_name: cdc_a\nscd_type: 1\nkeys: [k, m]\nsequence_by:\n")
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "dim_a.yml").write_text("object_name: dim_a\nsource_object: cons_a\n")
    cdc, dim = plan_objects(load_registry(f"{tmp_path}/objects.yml", str(tmp_path)))
    assert (cdc.changes().keys, cdc.changes().scd_type, cdc.changes().sequence_by) == (("k", "m"), 1, "s")
    assert dim.table == "spark_catalog.03_gold.dim_a"


def test_streamed_gold(spark, sf, tmp_path):
    run = uuid.uuid4().hex[:6]
    stream = {"object_name": "cons_part", "custom_sql": f"SELECT p_partkey, upper(p_name) n FROM STREAM(spark_catalog.l01_{run}.raw_part)"}
    one = {
        "hops": {layer: {"schema": f"{layer}_{run}"} for layer in ("l01", "l02", "l03", "gold")},
        "source_systems": {
            "shop": {
                "connection": {"cloud_storage_path": f"{sf}/{{object}}*.parquet", "cloud_storage_type": "parquet"},
                "defaults": {"l01": {"enabled": True, "ingestion_mode": "streaming"}},
                "dimensions": {"part": "p_partkey"},
            }
        },
        "gold": [{**stream, "write_mode": "streaming_table"}],
    }
    for _ in range(2):  # the second refresh finds nothing new
        Medallion(spark, one, f"{tmp_path}/lake").run()
    checked = {
        "object_name": "cons_checked",
        "source_object": f"spark_catalog.l01_{run}.raw_part",
        "read_mode": "stream",
        "append_only_source": True,
        "write_mode": "streaming_table",
        "columns": [
            {"source_col": "p_partkey", "target_col": "k", "constraint_name": "small", "constraint_expression": "k < 10"},
        ],
    }
    medallion = Medallion(spark, {**one, "gold": [checked]}, f"{tmp_path}/lake")
    medallion.run()
    parts = spark.read.parquet(f"{sf}/part.parquet")
    counts = medallion.violations[f"spark_catalog.gold_{run}.cons_checked"]
    assert counts == {"rows": parts.count(), "small": parts.where("not p_partkey < 10").count()}
    assert spark.table(f"spark_catalog.gold_{run}.cons_part").count() == spark.read.parquet(f"{sf}/part.parquet").count()
    with pytest.raises(ValueError, match="streaming_table"):
        Medallion(spark, {**one, "gold": [stream]}, f"{tmp_path}/lake").run()


def test_replace_table_keeps_readers_and_comment(spark, tmp_path):
    name = f"spark_catalog.t{uuid.uuid4().hex[:6]}.thing"
    replace_table(spark.range(3).selectExpr("id", "true as __etl_is_current"), name, f"{tmp_path}/x", "it's a thing")
    before = spark.table(name)
    replace_table(spark.range(5).selectExpr("id", "id > 2 as __etl_is_current"), name, f"{tmp_path}/x")
    assert spark.table(name).count() == 5
    assert before.count() in (3, 5)
    assert spark.catalog.getTable(name).description == "it's a thing"
    assert spark.table(create_current_view(spark, name)).count() == 2
    replace_table(spark.range(2).selectExpr("cast(id as string) id"), name, f"{tmp_path}/x")
    assert spark.table(name).dtypes == [("id", "string")]
    assert len(list((tmp_path / "x").glob("version=*"))) == 3
    replace_table(spark.range(4).selectExpr("cast(id as string) id"), name, f"{tmp_path}/x", keep=2)
    assert len(list((tmp_path / "x").glob("version=*"))) == 2 and spark.table(name).count() == 4
    ensure_table(spark, spark.range(1), name, f"{tmp_path}/y")
    assert spark.table(name).dtypes == [("id", "string")]


def test_append_goes_by_name(spark, tmp_path):
    name = f"spark_catalog.t{uuid.uuid4().hex[:6]}.raw"
    append_table(spark.sql("select 1 a, 2 b"), name, f"{tmp_path}/x")
    append_table(spark.sql("select 4 b, 3 a"), name, f"{tmp_path}/x")
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 2), (3, 4)]
    append_table(spark.sql("select 6 b, 'new' c"), name, f"{tmp_path}/x")
    assert sorted(map(str, map(tuple, spark.table(name).collect()))) == ["(1, 2, None)", "(3, 4, None)", "(None, 6, 'new')"]
    with pytest.raises(ValueError, match="types differ"):
        append_table(spark.sql("select 'x' b"), name, f"{tmp_path}/x")


def test_refresh_takes_in_new_files(spark, tmp_path):
    """Two runs of one streamed dimension from csv, with a late file and a delete."""
    folder = tmp_path / "in" / "customer"
    folder.mkdir(parents=True)
    (folder / "1.csv").write_text("id,name,op,changed\n1,Ann,I,2024-01-01\n2,Bob,I,05-01-2024\n1,Anna,U,2024-01-10\n")
    run = uuid.uuid4().hex[:6]
    one = {
        "hops": {layer: {"schema": f"{layer}_{run}"} for layer in ("l01", "l02", "l03", "gold")},
        "source_systems": {
            "crm": {
                "connection": {"cloud_storage_path": f"{tmp_path}/in/{{object}}", "cloud_storage_type": "csv", "header": True},
                "defaults": {
                    "l01": {"enabled": True, "ingestion_mode": "streaming", "source_updated_at_col": "changed"},
                    "l02": {
                        "enabled": True,
                        "sequence_by": "__source_updated_at",
                        "apply_as_deletes": "op = 'D'",
                        "track_history_column_list": ["name"],
                    },
                    "l03": {"enabled": True, "columns": [{"source_col": "name", "target_col": "name", "expression": "upper(name)"}]},
                },
                "dimensions": {"customer": "id"},
            }
        },
        "gold": [{"object_name": "dim_customer", "source_object": "processed_customer", "create_scd2_view": True, "filter": "id <> '9'"}],
    }
    medallion = Medallion(spark, one, f"{tmp_path}/lake", buckets=2, keep_versions=1)

    def dim(name="dim_customer"):
        rows = spark.table(f"spark_catalog.gold_{run}.{name}").collect()
        return sorted((r["id"], r["name"], r["__etl_effective_from"].day, r["__etl_is_current"]) for r in rows)

    medallion.run()
    assert dim() == [("1", "ANN", 1, False), ("1", "ANNA", 10, True), ("2", "BOB", 5, True)]
    (folder / "2.csv").write_text("id,name,op,changed\n1,Anne,U,2024-01-04\n2,Bob,D,2024-01-20\n3,Cy,I,20240103\n")
    medallion.run()
    assert dim() == [
        ("1", "ANN", 1, False), ("1", "ANNA", 10, True), ("1", "ANNE", 4, False), ("2", "BOB", 5, False), ("3", "CY", 3, True),
    ]
    assert dim("vw_dim_customer_current") == [("1", "ANNA", 10, True), ("3", "CY", 3, True)]
    assert "_rescued_data" not in spark.table(f"spark_catalog.l02_{run}.cdc_customer").columns


def test_appended_snapshots_are_taken_in_once(spark, tmp_path):
    """The whole source lands again with each refresh; history does not change by that."""
    run = uuid.uuid4().hex[:6]
    source = f"{tmp_path}/in/part"
    one = {
        "hops": {layer: {"schema": f"{layer}_{run}"} for layer in ("l01", "l02", "l03", "gold")},
        "source_systems": {
            "shop": {
                "connection": {"cloud_storage_path": f"{tmp_path}/in/{{object}}", "cloud_storage_type": "json"},
                "defaults": {
                    "l01": {"enabled": True, "ingestion_mode": "snapshot", "merge_strategy": "append", "source_updated_at_col": "at"},
                    "l02": {"enabled": True, "sequence_by": "at", "track_history_column_list": ["v"]},
                },
                "dimensions": {"part": {"primary_key_columns": "k", "comment": "parts"}},
            }
        },
    }
    medallion = Medallion(spark, one, f"{tmp_path}/lake", buckets=2)
    table = f"spark_catalog.l02_{run}.cdc_part"

    def history():
        return sorted((r["k"], r["v"], str(r["__START_AT"])[:10], str(r["__END_AT"])[:10]) for r in spark.table(table).collect())

    rows = "select * from values (1, 'a', '2024-01-01'), (1, 'b', '2024-01-03') t(k, v, at)"
    spark.sql(rows).write.json(source)
    medallion.run()
    first = [(1, "a", "2024-01-01", "2024-01-03"), (1, "b", "2024-01-03", "None")]
    assert history() == first
    medallion.run()
    assert history() == first
    spark.sql("select 1 k, 'c' v, '2024-01-02' at").write.mode("append").json(source)
    medallion.run()
    assert history() == [
        (1, "a", "2024-01-01", "2024-01-02"), (1, "b", "2024-01-03", "None"), (1, "c", "2024-01-02", "2024-01-03"),
    ]
    assert spark.table(f"spark_catalog.l01_{run}.raw_part").count() == 7


def test_expectation_counts_of_a_run(spark, sf, tmp_path):
    run = uuid.uuid4().hex[:6]
    one = {
        "hops": {layer: {"schema": f"{layer}_{run}"} for layer in ("l01", "l02", "l03", "gold")},
        "source_systems": {
            "shop": {
                "connection": {"cloud_storage_path": f"{sf}/{{object}}.parquet", "cloud_storage_type": "parquet"},
                "defaults": {
                    "l01": {"enabled": True, "merge_strategy": "overwrite", "source_updated_at_col": "o_orderdate"},
                    "l02": {"enabled": True, "sequence_by": "o_orderdate"},
                    "l03": {
                        "enabled": True,
                        "columns": [
                            {
                                "source_col": "o_totalprice",
                                "target_col": "total",
                                "constraint_name": "big",
                                "constraint_expression": "total > 100000",
                                "constraint_on_violation": "DROP",
                            }
                        ],
                    },
                },
                "facts": {"orders": "o_orderkey"},
            }
        },
    }
    medallion = Medallion(spark, one, f"{tmp_path}/lake")
    medallion.run()
    table = f"spark_catalog.l03_{run}.processed_orders"
    counts = medallion.violations[table]
    assert counts["rows"] == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert spark.table(table).count() == counts["rows"] - counts["big"] > 0


@pytest.mark.parametrize(
    "gold, l03, text",
    [
        ({}, {"refresh": "sometimes"}, "must be 'full' or 'incremental'"),
        ({"refresh": "incremental"}, {}, "refreshed so too"),
        ({"refresh": "incremental", "primary_key_columns": ["k"]}, {"refresh": "incremental"}, "without primary_key_columns"),
        ({"refresh": "incremental", "write_mode": "permanent_table"}, {"refresh": "incremental"}, "materialized views of one table"),
        ({"refresh": "incremental", "lookups": [{"dimension": "dim_x", "on": "k", "skey": "s"}]}, {"refresh": "incremental"}, "without lookups"),
    ],
)
def test_refresh_that_does_not_fit_is_refused(gold, l03, text):
    one = registry(dimensions={"material": {"primary_key_columns": "k", "l03": l03}}, facts={})
    with pytest.raises(ValueError, match=text):
        plan_objects({**one, "gold": [{"object_name": "dim_material", "source_object": "processed_material", **gold}]})


def test_incremental_refresh_of_a_registry_is_planned():
    one = registry(dimensions={"material": {"primary_key_columns": "k", "l03": {"refresh": "incremental"}}}, facts={})
    specs = plan_objects({**one, "gold": [{"object_name": "dim_material", "source_object": "processed_material", "refresh": "incremental"}]})
    assert [s.incremental for s in specs] == [False, False, True, True]
