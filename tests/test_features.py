"""Hand-computed applicants and column contracts of the feature frame."""

import datetime as dt

import pytest
from bureauflow.operators.cube import cube_columns
from bureauflow.operators.families import FAMILIES, family_columns, family_frame
from bureauflow.operators.naming import cube_name
from bureauflow.plans import features as ft
from bureauflow.schema import APPLICATIONS

D = dt.date
LINES = (
    "application_id string, customer_id string, product_type string, total_amount double, "
    "monthly_payment double, duration_months int, opening_date date, closure_date date, "
    "default_date date, recovery_date date"
)


@pytest.fixture(scope="module")
def people(spark):
    rows = [("A", f"C{i}", "PRIMARY", D(2024, 1, 1), 0) for i in (1, 2, 3)]
    return spark.createDataFrame(rows, APPLICATIONS)


@pytest.fixture(scope="module")
def lines(spark):
    def line(who, product, amount, pay, months, opened, default=None, recovery=None):
        return ("A", who, product, amount, pay, months, opened, None, default, recovery)

    rows = [
        line("C1", "INSTALLMENT_LOAN", 10000.0, 500.0, 24, D(2023, 6, 1)),
        line("C1", "MORTGAGE", 200000.0, 1500.0, 240, D(2020, 1, 1)),
        line("C1", "CASH_FACILITY", 5000.0, 200.0, 12, D(2023, 11, 1)),
        line("C2", "CASH_FACILITY", 1000.0, None, None, D(2022, 1, 1), D(2022, 3, 2), D(2022, 6, 10)),
        line("C2", "INSTALLMENT_LOAN", 3000.0, 100.0, 30, D(2022, 7, 1), D(2022, 9, 29)),
        line("C2", "NON_AUTH_OVERDRAFT", 70.0, None, None, D(2023, 5, 1)),
    ]
    return spark.createDataFrame(rows, LINES)


@pytest.fixture(scope="module")
def wide(people, lines):
    return {r["customer_id"]: r for r in ft.wide_frame(people, lines).collect()}


def test_known_applicant(wide):
    r = wide["C1"]
    assert r["total_credit_count"] == 3
    assert r["total_credit_amount"] == 215000
    assert r["distinct_product_count"] == 3
    assert r["installment_loan_count"] == r["mortgage_count"] == r["cash_facility_count"] == 1
    assert r["count_last_6m"] == 1 and r["count_last_12m"] == 2
    assert r["default_count_ever"] == 0 and r["all_products_clean"] == 1
    assert r["days_since_last_default"] is None
    assert r["total_monthly_payment"] == 2200
    assert r["top_credit_concentration"] == pytest.approx(200 / 215)
    assert r["first_product_mortgage"] == 1 and r["last_product_cash_facility"] == 1
    assert r["product_transition_count"] == 2


def test_defaulted_applicant(wide):
    r = wide["C2"]
    assert r["default_count_ever"] == 2 and r["has_multiple_defaults"] == 1
    assert r["recovered_ratio"] == 0.5 and r["defaulted_ratio"] == 1
    assert r["cf_default_then_il_default"] == 1 and r["il_default_then_cf_default"] == 0
    assert r["credits_after_first_recovery"] == 1 and r["defaulted_again_after_recovery"] == 1
    assert r["recovery_to_new_credit_days"] == 21
    assert r["overdraft_count"] == 1 and r["overdraft_amount"] == 70
    assert r["has_current_default"] == 1
    assert r["fastest_default_days"] == 60 and r["has_early_default_90d"] == 1
    assert r["application_has_co_applicant"] == 1 and r["co_applicant_credit_count"] == 3


def test_applicant_without_credit(wide):
    r = wide["C3"]
    assert r["total_credit_count"] == 0 and r["total_credit_amount"] == 0
    assert r["defaulted_ratio"] is None and r["oldest_credit_age_months"] is None
    assert r["all_products_clean"] == 1 and r["stale_portfolio_flag"] == 1


def test_zero_option_reproduces_zeros(people, lines):
    rows = family_frame(people, lines, ["temporal", "default_lifecycle"], undefined="zero")
    got = {r["customer_id"]: r for r in rows.collect()}
    assert got["C1"]["days_since_last_default"] == 0
    assert got["C1"]["time_since_last_recovery_days"] == 0
    assert got["C3"]["time_since_last_recovery_days"] is None


def test_column_counts(wide):
    assert len(cube_columns("amount")) == 496 and len(cube_columns("count")) == 98
    names = ft.feature_names()
    assert len(names) == len(set(names)) == 950
    assert len(family_columns(list(FAMILIES))) == 356
    assert set(names) < set(wide["C1"].asDict())


def test_missing_optional_columns(people, lines):
    few = lines.drop("closure_date", "duration_months", "monthly_payment")
    r = {x["customer_id"]: x for x in ft.wide_frame(people, few).collect()}["C1"]
    assert r["total_credit_count"] == 3 and r["payment_count"] == 0 and r["weighted_avg_term"] == 0


def test_names():
    assert cube_name("all", "all", "all", "sum") == "total_credit_amount"
    assert cube_name("il", "all", "all", "cnt") == "installment_loan_count"
    assert cube_name("all", "3m", "defaulted", "sum") == "defaulted_total_amount_last_3m"
    assert cube_name("mg", "12m", "active", "avg") == "mortgage_active_average_amount_last_12m"
