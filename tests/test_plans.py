"""Plans of queries that once read their tables over and over."""

from __future__ import annotations

import pytest

from shelfcast.catalog.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("name", "scans"),
    [
        ("b8_holdout", 4),
        ("b13_encode_categories", 9),
        ("d5_model_summary", 1),
        ("d12_mape", 1),
        ("e5_carry_over", 4),
        ("e14_pair_bounds", 2),
        ("g1_union_all", 2),
        ("j1_metrics_per_pair", 1),
        ("l5_impact_report", 4),
        ("l8_metrics_report", 5),
    ],
)
def test_number_of_scans(spark, name, scans):
    plan = QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("FileScan") <= scans, plan
