"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest

from panelkit import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _fingerprints(table, columns):
    """A sorted hash per row: numbers to six digits, everything else as text, nulls alike."""
    plain = {}
    for c in columns:
        values = table[c]
        if pd.api.types.is_numeric_dtype(values):
            plain[c] = values.astype("Float64").round(6).astype(float) + 0.0
        else:
            text = values.astype(object).where(values.notna(), "")
            dates = pd.api.types.is_datetime64_any_dtype(values)
            plain[c] = text.map(lambda v, d=dates: str(v)[:10] if d else str(v)).astype(object)
    return np.sort(pd.util.hash_pandas_object(pd.DataFrame(plain), index=False).to_numpy())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    wanted = duck.execute(ORACLES[name]).df()
    got = df.toPandas()
    columns = sorted(wanted.columns)
    assert sorted(got.columns) == columns
    assert len(got) == len(wanted)
    assert (_fingerprints(got, columns) == _fingerprints(wanted, columns)).all()


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_answers(spark, folder):
    rows = QUERIES["question_answers"](spark, folder).toPandas()
    assert set(rows["intent"]) == {
        "restock", "underperforming", "explanation", "kpi", "store_comparison",
        "inventory_knowledge", "top", "general",
    }
    assert rows["answer"].notna().all() and (rows["answer"].str.len() > 0).all() and (rows["retrieval_count"] <= 8).all()
