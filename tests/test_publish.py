"""Staged publication: tasks that run twice, tasks that are lost, and failures half way, against a recording store.

The store takes the place of a database server: what Spark would insert goes, partition by
partition, into in-memory tables, and the statements of the publication run there as they are.
"""

import datetime as dt
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from ratesmith.plans import jobs
from ratesmith.sources import publish as P
from ratesmith.sources import sinks as SK


class RecordingStore:
    """``repeated`` partitions are inserted twice, ``lost`` ones not at all; ``fails`` names a statement that fails."""

    def __init__(self, repeated=(), lost=(), fails=None):
        self.con, self.repeated, self.lost, self.fails, self.log = duckdb.connect(), set(repeated), set(lost), fails, []

    def append(self, df, table):
        kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
        self.con.execute(f"CREATE TABLE IF NOT EXISTS {table} (" + ", ".join(f"{self.quoted(c)} {kinds[t]}" for c, t in df.dtypes) + ")")
        parts = {}
        for r in df.collect():
            parts.setdefault(r[P.PART] if P.PART in df.columns else 0, []).append(tuple(r))
        self.log.append((table, len(parts)))
        for part, rows in parts.items():
            for _ in range(0 if part in self.lost else 2 if part in self.repeated else 1):
                self.con.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(rows[0]))})", rows)

    def transaction(self, statements):
        self.con.execute("BEGIN")
        try:
            for sql in statements:
                if self.fails and self.fails in sql:
                    raise RuntimeError("connection lost")
                self.con.execute(sql)
                self.log.append(sql)
            self.con.execute("COMMIT")
        except Exception:
            self.con.execute("ROLLBACK")
            raise

    def query(self, sql):
        return self.con.execute(sql).fetchall()

    def quoted(self, name):
        return '"' + name.replace('"', '""') + '"'

    def rows(self, table):
        return Counter(self.query(f"SELECT * FROM {table}"))

    def tables(self):
        return {t for (t,) in self.query("SELECT table_name FROM information_schema.tables")}


def result(spark, n=60, extra=0.0):
    """Rows that repeat and hold NULLs: a repeat within the result is no replay and must stay."""
    rows = [(dt.date(2024, 1, 1 + i % 5), f"A{i % 7}" if i % 11 else None, 'quo"te', (i % 13) + extra if i % 3 else None) for i in range(n)]
    return spark.createDataFrame(rows + rows[:10], 'date date, asset string, `quo"te` string, rate double').repartition(6)


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_a_replayed_task_repeats_nothing(spark):
    store = RecordingStore(repeated={0, 2, 5})
    df = result(spark)
    assert P.publish(df, "rates", store) == 70
    assert store.rows("rates") == as_rows(df)
    assert store.tables() == {"rates"}  # the staging table is gone
    assert P.publish(df, "rates", store) == 70  # and the whole publication may be run again
    assert store.rows("rates") == as_rows(df)


def test_plain_append_would_repeat(spark):
    """What the staging is for: the same replay, written directly."""
    store = RecordingStore(repeated={0, 2, 5})
    store.append(P.placed(result(spark)), "direct")
    assert store.query("SELECT count(*) FROM direct")[0][0] > 70


def test_a_lost_partition_stops_before_the_swap(spark):
    store = RecordingStore()
    old = result(spark, 20)
    P.publish(old, "rates", store)
    store.lost = {3}
    with pytest.raises(P.PublicationError, match="partitions \\[3\\] of 6"):
        P.publish(result(spark, 60), "rates", store)
    assert store.rows("rates") == as_rows(old) and store.tables() == {"rates"}


def test_a_failed_swap_leaves_the_old_rows(spark):
    store = RecordingStore()
    old = result(spark, 20)
    P.publish(old, "rates", store)
    store.fails = "INSERT INTO rates"
    with pytest.raises(RuntimeError, match="connection lost"):
        P.publish(result(spark, 60), "rates", store)
    assert store.rows("rates") == as_rows(old) and store.tables() == {"rates"}


def test_part_of_a_table_is_replaced(spark):
    store = RecordingStore(repeated={1})
    first, second = result(spark, 30), result(spark, 30, extra=100.0).where("date > '2024-01-03'")
    P.publish(first, "rates", store)
    P.publish(second, "rates", store, replaced="date > DATE '2024-01-03'")
    assert store.rows("rates") == as_rows(first.where("date <= '2024-01-03'")) + as_rows(second)


def test_empty_result_and_kept_names(spark):
    store = RecordingStore()
    P.publish(result(spark, 20), "rates", store)
    assert P.publish(result(spark).where("false"), "rates", store) == 0
    assert not store.rows("rates")
    with pytest.raises(ValueError, match="publish_row"):
        P.publish(result(spark).withColumn(P.ROW, F.lit(1)), "rates", store)


def test_places_do_not_change_when_a_task_runs_again(spark):
    """The places are read from the computed table, so an attempt on another day sees the same ones."""
    rows = P.placed(spark.range(1000).withColumn("x", F.rand()).repartition(7))
    once, again = as_rows(rows.repartition(3)), as_rows(rows.coalesce(1))
    assert once == again and max(once.values()) == 1
    assert rows.select(P.PART, P.ROW).distinct().count() == 1000


def test_jobs_publish_through_the_store(spark, scratch):
    store = RecordingStore(repeated={0, 1})
    (spark.createDataFrame([(dt.date(2024, 1, 1), "USD", "UAH", 40.0, "USD", "UAH"), (dt.date(2024, 1, 2), "USD", "UAH", 41.0, "USD", "UAH")],
                           "date date, ast string, qout string, rate double, asset string, quote string")
     .write.partitionBy("asset", "quote").csv(f"{scratch}/cl"))
    store.con.execute("CREATE SCHEMA expenses")
    jobs.publish_closed_rates(spark, f"{scratch}/cl", jobs.store_sink(store))
    assert len(store.rows(jobs.CLOSED_RATES_TABLE)) == 8  # 2 days x (rate, inverse, two identities)


def test_jdbc_store_quotes_as_its_database(spark):
    store = P.JdbcStore(spark, "jdbc:postgresql://host/db", SK.jdbc_properties("org.postgresql.Driver", "u", "p"))
    assert store.quoted("rate") == '"rate"'
    assert P.JdbcStore(spark, "jdbc:mysql://host/db", {}).quoted("rate") == "`rate`"
    [gone, put] = P.swap_statements(store, "expenses.rates", "expenses.rates_staging_1", ["date", "rate"], "date > '2024-01-01'")
    assert gone == "DELETE FROM expenses.rates WHERE date > '2024-01-01'"
    assert put.startswith('INSERT INTO expenses.rates ("date", "rate") SELECT "date", "rate" FROM (SELECT')
