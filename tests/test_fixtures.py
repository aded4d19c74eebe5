"""The derived input views keep the row counts documented in FIXTURES.md, in Spark and in DuckDB."""

import duckdb
import pytest

from ratesmith.plans import fixtures as FX

# Documented row counts (FIXTURES.md sections 3 and 5).
COUNTS = {
    "/root/testdata/sf0.001": {"fx": 319, "mkt": 355, "trades_a": 6000, "trades_b": 1500, "crypto": 467},
    "/root/testdata/sf0.01": {"fx": 397, "mkt": 422, "trades_a": 60000, "trades_b": 15000, "crypto": 793},
}


@pytest.mark.parametrize("sf_dir", sorted(COUNTS))
def test_view_counts(spark, sf_dir):
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for view, n in COUNTS[sf_dir].items():
        assert getattr(FX, view)(spark, sf_dir).count() == n, view
        assert con.execute(FX.sql_with(view) + f"SELECT count(*) FROM {view}").fetchone()[0] == n, view
