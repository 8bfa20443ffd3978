import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.processed import ColumnRule, ProcessedSpec, processed, read_rules

FOREVER = dt.datetime(9999, 12, 31, 23, 59, 59)


@pytest.fixture
def history(spark):
    return spark.sql(
        "select * from values"
        " (1, ' a ', '5', timestamp'2024-01-01', timestamp'2024-01-02', timestamp'2024-01-01', timestamp'2024-02-01'),"
        " (1, 'b', 'x', timestamp'2024-01-02', null, timestamp'2024-01-02', timestamp'2024-02-01')"
        " t(k, name, amount, __START_AT, __END_AT, __source_updated_at, __etl_loaded_at)"
    )


def test_versions_get_validity_columns(history):
    built = processed(history, ProcessedSpec(business_key_columns=["k"], skey_column="k_skey"))
    assert built.columns == [
        "k_skey", "k", "name", "amount", "__source_updated_at", "__etl_loaded_at", "__etl_processed_at",
        "__etl_effective_from", "__etl_effective_to", "__etl_is_current",
    ]
    rows = sorted(built.collect(), key=lambda r: r["__etl_effective_from"])
    assert [r["__etl_effective_to"] for r in rows] == [dt.datetime(2024, 1, 2), FOREVER]
    assert [r["__etl_is_current"] for r in rows] == [False, True]
    assert rows[0]["k_skey"] != rows[1]["k_skey"]


def test_type_1_has_no_validity(history):
    flat = history.drop("__START_AT", "__END_AT")
    built = processed(flat, ProcessedSpec(business_key_columns=["k"], skey_column="k_skey"))
    assert not {"__etl_effective_from", "__etl_effective_to", "__etl_is_current"} & set(built.columns)
    assert built.select("k_skey").distinct().count() == 1


def test_no_skey_unless_both_are_given(history):
    assert "s" not in processed(history, ProcessedSpec(skey_column="s")).columns
    assert processed(history, ProcessedSpec(business_key_columns=["k"])).columns[0] == "k"


def test_rules(history):
    rules = read_rules(
        [
            {"source_col": "name", "target_col": "name", "expression": "nullif(trim(upper(name)), '')"},
            {"source_col": "amount", "target_col": "amount", "data_type": "INT"},
            {"source_col": "k", "target_col": "key"},
            {"target_col": "high", "expression": "try_cast(amount as int) > 1", "data_type": "BOOLEAN"},
            {"target_col": "nothing"},
            {"expression": "1"},
        ]
    )
    built = processed(history, ProcessedSpec(columns=rules))
    assert built.columns[:4] == ["name", "amount", "key", "high"]
    assert sorted(map(tuple, built.select("name", "amount", "key", "high").collect()), key=str) == [
        ("A", 5, 1, True),
        ("B", None, 1, None),
    ]


def test_strict_cast_fails(history):
    rules = read_rules([{"source_col": "amount", "target_col": "amount", "data_type": "INT", "strict": True}])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        processed(history, ProcessedSpec(columns=rules)).collect()


def test_user_column_replaces_passthrough(history):
    rules = read_rules([{"source_col": "amount", "target_col": "name", "data_type": "STRING"}])
    built = processed(history, ProcessedSpec(columns=rules))
    assert built.columns.count("name") == 1 and "amount" not in built.columns


def test_leading_and_dropped(history):
    source = history.withColumn("_rescued_data", F.lit("x"))
    built = processed(source, ProcessedSpec(leading_columns=["amount", "absent", "__etl_is_current"]))
    assert built.columns[:3] == ["amount", "__etl_is_current", "k"]
    assert "_rescued_data" not in built.columns


def test_entry_without_target_is_an_error():
    with pytest.raises(ValueError, match="no target_col"):
        ColumnRule.read({"source_col": "a"})
    with pytest.raises(ValueError, match="unknown"):
        ColumnRule.read({"target_col": "a", "sourcecol": "b"})


def test_one_narrow_projection(spark, sf):
    built = processed(spark.read.parquet(f"{sf}/orders.parquet"), ProcessedSpec(business_key_columns=["o_orderkey"], skey_column="s"))
    assert "Exchange" not in built._jdf.queryExecution().executedPlan().toString()
