"""Registered queries against their reference SQL.

All queries with SQL run; MEDIAMIX_PART=1 runs a representative part.
"""

import os

import duckdb
import pytest

from mediamix.queries.registered import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
PART = (
    "catalog_violations flag_violations parse_mixed_dates date_continuity off_grid_report winsorize_rows iqr_mask "
    "outlier_treatment forward_fill_rows interpolate_linear rate_fill weekly_panel merge_metric_frames resolve_weights "
    "funnel_pairs channel_priority keyword_rank channel_candidates_sparse adstock_geometric pareto_fronts mm_fit model_scores"
)
NAMES = PART.split() if os.environ.get("MEDIAMIX_PART") else sorted(SQL)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*columns).collect()]
    found = duck.execute(SQL[name])
    places = [c[0] for c in found.description]
    assert sorted(places) == columns
    theirs = [tuple(r[places.index(c)] for c in columns) for r in found.fetchall()]

    def order(rows):
        return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])

    ours, theirs = order(ours), order(theirs)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert a == b or a == tuple(pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for v in b)
