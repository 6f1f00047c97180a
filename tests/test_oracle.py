"""Every query with SQL gives the same rows in Spark and in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from roadflow.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame: pd.DataFrame) -> list[str]:
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) or hasattr(v, "dtype") and v.dtype.kind == "f" else v

    frame = frame[sorted(frame.columns)]
    return sorted(str([plain(v) for v in r]) for r in frame.astype(object).itertuples(index=False, name=None))


def compare(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    ours, theirs = query(spark, sf_dir).toPandas(), con.execute(sql).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_same_rows(spark, sf_dir, name):
    compare(spark, sf_dir, plans.QUERIES[name], plans.SQL[name])


#: Queries that round what doubles add up to, over a table large enough for ties.
ROUNDED = ("hourly_flow_sink", "hourly_section_flow", "segment_status", "vehicle_minute_segment", "completion_on_roads")


@pytest.mark.parametrize("name", ROUNDED)
def test_same_rows_of_a_larger_table(spark, name):
    compare(spark, "/root/testdata/sf0.01", plans.QUERIES[name], plans.SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
