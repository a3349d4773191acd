"""Every query against its SQL oracle over the given tables."""

import duckdb
import pytest

import __spark_entry__
from tillroll.checks import views
from tillroll.checks.oracles import ORACLES
from tillroll.checks.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("null" if row[i] is None else str(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLES.keys() <= __spark_entry__.oracle_sql().keys()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, database, name):
    frame = QUERIES[name](spark, sf_dir)
    expected = database.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    got = canonical(frame.collect(), frame.columns)
    assert got == canonical(expected.fetchall(), expected.columns)
    assert got


def test_the_run_view_keeps_every_action(spark, sf_dir):
    """Each event is one action, and only the few repeated labels overwrite a document."""
    documents = views.run_documents(spark, sf_dir).cache()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert documents.selectExpr("sum(size(actions))").first()[0] == events.count()
    repeated = documents.groupBy("run_label").count().filter("count > 1").collect()
    assert {r.run_label for r in repeated} <= {str(u) for u in views.REPEATED_USERS}
    assert QUERIES["run_summary"](spark, sf_dir).count() == documents.count() - sum(r["count"] - 1 for r in repeated)


def test_every_cell_of_the_view_is_in_a_row(spark, sf_dir):
    cells = views.workbook_tables(spark, sf_dir).cells
    rows = QUERIES["cells_to_rows"](spark, sf_dir)
    texts = " + ".join(f"int(c{i} != '')" for i in range(27))
    assert rows.selectExpr(f"sum({texts})").first()[0] == cells.count()
