"""Table schemas and fixed value lists of the credit-risk data model."""

from pyspark.sql import types as T

KEY = ["application_id", "customer_id"]
CORE = ["uid", "application_id", "customer_id", "applicant_type", "application_date", "target"]

# Product types, their short codes and readable prefixes.
PRODUCTS = {
    "il": "INSTALLMENT_LOAN",
    "is": "INSTALLMENT_SALE",
    "cf": "CASH_FACILITY",
    "mg": "MORTGAGE",
}
PRODUCT_NAMES = {
    "all": "",
    "il": "installment_loan",
    "is": "installment_sale",
    "cf": "cash_facility",
    "mg": "mortgage",
}
CREDIT_PRODUCTS = list(PRODUCTS.values())
NON_CREDIT_PRODUCTS = ["NON_AUTH_OVERDRAFT", "OVERLIMIT"]

# Look-back windows in months and tradeline statuses.
WINDOWS = {"all": None, "3m": 3, "6m": 6, "12m": 12, "24m": 24}
STATUSES = ["all", "active", "defaulted", "recovered"]

DAYS_PER_MONTH = 30.44

APPLICATIONS = T.StructType(
    [
        T.StructField("application_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("applicant_type", T.StringType(), False),
        T.StructField("application_date", T.DateType(), False),
        T.StructField("target", T.IntegerType(), False),
    ]
)

CREDIT_BUREAU = T.StructType(
    [
        T.StructField("application_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("product_type", T.StringType(), False),
        T.StructField("total_amount", T.DoubleType(), False),
        T.StructField("opening_date", T.DateType(), False),
        T.StructField("default_date", T.DateType(), True),
        T.StructField("recovery_date", T.DateType(), True),
    ]
)

# Columns some bureaus deliver and some do not; absent ones are read as typed NULLs.
OPTIONAL_TRADELINE = {
    "default_date": "date",
    "recovery_date": "date",
    "closure_date": "date",
    "duration_months": "int",
    "monthly_payment": "double",
    "tradeline_id": "bigint",
}

SCHEMAS = {"applications": APPLICATIONS, "credit_bureau": CREDIT_BUREAU}
