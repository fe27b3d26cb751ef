"""Registered queries against their DuckDB oracles on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans import catalog
from quarry.sources.tables import TABLES
from tests.conftest import SF_SMALL

FAST = [
    "link_parse", "link_dedup", "out_degree", "adjacency_lists", "rank_init", "rank_contribs", "rank_step",
    "pagerank_10", "export_sort", "export_sort_strings", "csv_scan_strings", "train_test_split",
    "one_hot_labels", "reshape_grid", "argmax_class", "assign_batches", "linear_scores", "cross_entropy",
    "accuracy_counts", "softmax_sgd_sync", "sweep_best_setting", "pagerank_one_way", "link_stream_ingest",
    "export_sort_job", "pagerank_mixed", "sweep_two_sheets", "train_then_evaluate",
    "softmax_adam_resumed", "training_metrics_resumed", "relu_network_adam", "shuffle_blocks", "shuffle_buffer",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(
            round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _norm([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = _norm(res.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_every_query_has_oracle_or_is_estimator():
    missing = set(catalog.QUERIES) - set(entry.oracle_sql())
    assert missing == {"softmax_regression_ml", "mlp_classifier"}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
