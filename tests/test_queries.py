"""Every registered query against its SQL on an independent engine."""

from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewatch.plans.oracle import ORACLE
from tidewatch.plans.queries import REGISTRY
from tidewatch.session import ensure_utc

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = REGISTRY, ORACLE


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, (datetime, date, str, bool)) or value is None:
        return repr(value)
    return repr(float(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    frame = QUERIES[name](spark, FOLDER)
    got = table(frame.columns, frame.collect())
    if name not in SQL:
        assert name == "forecast_mstl" and got[1]
        return
    result = engine.execute(SQL[name])
    assert got == table([c[0] for c in result.description], result.fetchall())


def test_outbox_before_the_first_message(spark, tmp_path):
    """Steady events raise nothing, so no run has written a message; then the outbox is empty, with its columns."""
    engine = duckdb.connect()
    engine.sql(f"""
        COPY (SELECT row_number() OVER () AS event_id, ts, 1 AS user_id, event_type, 2.5::DOUBLE AS value, '' AS props
              FROM range(TIMESTAMP '2024-01-01 00:30', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR) h(ts),
                   (VALUES ('view'), ('error')) k(event_type)) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    engine.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    assert QUERIES["deltas_classified"](spark, str(tmp_path)).count() > 0
    frame = QUERIES["outbox_stored"](spark, str(tmp_path))
    result = engine.execute(SQL["outbox_stored"])
    assert table(frame.columns, frame.collect()) == table([c[0] for c in result.description], result.fetchall())
    assert frame.isEmpty() and frame.dtypes == QUERIES["outbox_stored"](spark, FOLDER).dtypes


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    ensure_utc(spark)
    assert entry(spark).count() > 0
