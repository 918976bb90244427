"""Registered queries against their SQL counterparts on the smallest tables.

A cross-section by default; set ALL_QUERIES=1 for every registered query.
"""

import os

import pytest
from conftest import SMALL
from tools.compare import compare, database

import __spark_entry__ as entry

CORE = (
    "f1_amount_cube f2_count_cube f10_sequence f12_burst f13_interval f16_co_applicant "
    "f17_relative f20_default_lifecycle f23_cross_product f26_anomaly f33_payment_behavior "
    "x6_periods s3_value_list s8_partitioned_write j7_bin_lookup a1_qcut a8_woe_bins "
    "a9_merged_bins a12_psi a13_psi_monitor q5_date_rules q13_pre_model_checks e3_iv_filter "
    "e5_temporal_filter e11_stratified_split m2_ks_by_feature m3_lift_table m16_cutoffs "
    "l6_scored_rows"
).split()

NAMES = list(entry.queries()) if os.environ.get("ALL_QUERIES") else CORE


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    text, ok = compare(
        spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert ok, text


def test_every_counterpart_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 150
