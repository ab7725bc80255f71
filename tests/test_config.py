import json

import pytest

from snapdelta.config import DeltaLoad, FullLoad, enabled_loads, read_loads, select_loads
from snapdelta.sinks.layout import Layout, snapshot_date
from snapdelta.sources.jdbc import Connection, postgres_tables, source_query

YAML = """
tables:
  - schema: public
    table: orders
    output_table_name: all_orders
    select_sql: |
    columns: [id, total]
  - schema: public
    table: hidden
    enabled: false
  - schema: public
    table: Mixed
    select_sql: |
      "createTime" AS createtime
    output_columns: [createtime]
    extract_chunk_size: 28000
"""


def test_yaml_configs(tmp_path):
    (tmp_path / "shop-eu.yaml").write_text(YAML)
    first, second = read_loads(str(tmp_path))
    assert (first.database, first.output_name, first.projection) == ("shop-eu", "all_orders", "columns")
    assert (second.output_name, second.projection, second.extract_chunk_size) == ("Mixed", "select_sql", 28000)
    assert second.output_columns == ("createtime",)


def test_json_delta_configs(tmp_path):
    entry = {"schema": "public", "table": "t", "columns": ["a", "b"], "cursor": "c", "cursor_expression": "GREATEST(a, b)"}
    (tmp_path / "db.json").write_text(json.dumps({"tables": [entry]}))
    (load,) = read_loads(str(tmp_path), delta=True)
    assert load == DeltaLoad("db", "public", "t", columns=("a", "b"), cursor_column="c", cursor_expression="GREATEST(a, b)")
    (tmp_path / "db.json").write_text(json.dumps({"tables": [{"schema": "public", "table": "t"}]}))
    with pytest.raises(ValueError, match="must set cursor_column"):
        read_loads(str(tmp_path), delta=True)


def test_cursor_expression_needs_a_projection():
    with pytest.raises(ValueError, match="needs select_sql or columns"):
        DeltaLoad("d", "s", "t", cursor_column="c", cursor_expression="GREATEST(a, b)")


def test_selection():
    loads = [FullLoad("a", "s", "x", "y"), FullLoad("b", "s", "x"), FullLoad("b", "s", "z", enabled=False)]
    assert select_loads(loads, table="x") == loads[:2]
    assert select_loads(loads, database="b") == loads[1:2]
    with pytest.raises(ValueError, match="no tables selected"):
        select_loads(loads, table="y")  # an output name is not a source name


def test_selection_of_config_rows(spark):
    rows = [("a", "x", True, None), ("a", "y", None, ""), ("b", "x", True, "out"), ("a", "z", False, None)]
    configs = spark.createDataFrame(rows, "database string, table string, enabled boolean, output_table_name string")
    found = enabled_loads(configs).select("database", "table", "output_name").collect()
    assert sorted(map(tuple, found)) == [("a", "x", "x"), ("a", "y", "y"), ("b", "x", "out")]
    assert enabled_loads(configs, database="a", table="x").count() == 1


def test_layout():
    place = Layout("s3://bucket/base/", "data")
    assert place.snapshot("t", "2024/01/02") == "s3://bucket/base/data/full_load/t/2024/01/02"
    assert place.delta("t", "2024/01/02") == "s3://bucket/base/data/delta_load/t/2024/01/02"
    assert place.delta_log("t") == "s3://bucket/base/data/delta_load/t"
    with pytest.raises(ValueError, match="unsupported snapshot mode"):
        snapshot_date("fixed")
    assert len(snapshot_date().split("/")) == 3


def test_connection_options():
    connection = Connection("db.host", "me", "secret", "shop", sslmode="require", statement_timeout_ms=5000)
    options = connection.options(28000)
    assert options["url"] == "jdbc:postgresql://db.host:5432/shop?sslmode=require"
    assert (options["fetchsize"], options["sessionInitStatement"]) == ("28000", "SET statement_timeout = 5000")
    with pytest.raises(ValueError, match="host, user, password, database"):
        Connection().options()


def test_source_query_leaves_the_projection_to_the_database():
    delta = DeltaLoad("d", "public", 'od"d', columns=("a", "B"), cursor_column="c", cursor_expression="GREATEST(a, \"B\")")
    inner = 'SELECT "a", "B" FROM "public"."od""d"'
    assert source_query(delta) == f'(SELECT src.*, (GREATEST(a, "B")) AS "c" FROM ({inner}) AS src) AS extract'
    text = FullLoad("d", "public", "t", select_sql="id::text AS id\n")
    assert source_query(text) == '(SELECT id::text AS id FROM "public"."t") AS extract'
    assert source_query(FullLoad("d", "s", "t")) == '(SELECT * FROM "s"."t") AS extract'


@pytest.mark.parametrize("parts", [None, 4])
def test_jdbc_reads_go_through_sparks_own_reader(spark, parts):
    # No database here: the read gets as far as the driver class, which this image does not have.
    source = postgres_tables(spark, {"d": Connection("host", "me", "secret", "shop")})
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        source(FullLoad("d", "s", "t", columns=("id",), read_slices=parts, slice_columns=("id",)))
