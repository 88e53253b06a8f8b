"""Table names by database and by whole-name regex."""

from relayout.operators.names import all_tables, tables_matching


def _names(spark):
    rows = [("Sales", "orders"), ("sales", "orders_2017"), ("SALES", "Orders"), ("sales", "orders\n"),
            ("other", "orders")]
    return spark.createDataFrame(rows, "db string, table string")


def test_database_is_case_insensitive(spark):
    assert all_tables(_names(spark), "SaLeS").count() == 4


def test_pattern_must_match_whole_name(spark):
    got = sorted(r.table for r in tables_matching(_names(spark), "sales", "orders").collect())
    assert got == ["orders"]                        # not orders_2017, not Orders, not "orders\n"


def test_pattern_alternatives_and_classes(spark):
    got = sorted(r.table for r in tables_matching(_names(spark), "sales", "orders(_[0-9]+)?").collect())
    assert got == ["orders", "orders_2017"]


def test_catalog_listing_and_comments(spark):
    from relayout import layout_of
    from relayout.operators.names import catalog_names

    spark.sql("CREATE DATABASE IF NOT EXISTS names_db")
    spark.sql("CREATE TABLE IF NOT EXISTS names_db.orders_a (a INT COMMENT 'first', p STRING) USING parquet PARTITIONED BY (p)")
    spark.sql("CREATE TABLE IF NOT EXISTS names_db.other (a INT) USING parquet")
    assert sorted(r.table for r in catalog_names(spark, "names_db", "ORDERS*").collect()) == ["orders_a"]
    layout = layout_of(spark, "names_db.orders_a")
    assert layout.partition_names == ["p"] and layout.data.fields[0].metadata.get("comment") == "first"
