"""The churn table: its declared schema and a derived stand-in built from the driver's ``customer`` table.

The raw churn CSV is never shipped, so ``churn_raw`` derives a table of the same shape from ``customer`` by one SQL
statement with planted defects for every cleaning rule. The statement is plain ANSI SQL so that the DuckDB oracle
runs the very same text (see ``CHURN_RAW_SQL``); its work grows with ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The 21 columns of the raw churn CSV, in file order, with their declared types.
CHURN_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType(), nullable=False),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.FloatType()),
        T.StructField("TotalCharges", T.FloatType()),
        T.StructField("Churn", T.StringType()),
    ]
)

CHURN_COLUMNS = [f.name for f in CHURN_SCHEMA.fields]

# Derived stand-in for the raw CSV; identical text runs in Spark and DuckDB. ``{customer}`` is the customer table.
CHURN_RAW_SQL = """
WITH b0 AS (SELECT c_custkey AS k, 0 AS copy FROM {customer} UNION ALL SELECT c_custkey, 1 FROM {customer} WHERE c_custkey % 50 = 3 UNION ALL SELECT c_custkey, 2 FROM {customer} WHERE c_custkey % 75 = 7),
b AS (SELECT k, copy,
CASE WHEN k % 61 = 1 THEN -1 ELSE k % 73 END + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS t FROM b0)
SELECT CASE WHEN b.k % 97 = 1 THEN NULL ELSE concat('C', CAST(b.k AS VARCHAR(20))) END AS customerID,
CASE WHEN b.k % 31 = 1 THEN 'Femal' WHEN b.k % 37 = 1 THEN 'Mle' WHEN b.k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
CAST(CASE WHEN b.k % 53 = 1 THEN 2 WHEN b.k % 5 = 0 THEN 1 ELSE 0 END AS INT) AS SeniorCitizen,
CASE WHEN b.k % 43 = 1 THEN 'Yess' WHEN b.k % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
CASE WHEN b.k % 47 = 1 THEN NULL WHEN b.k % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
CAST(b.t AS INT) AS tenure,
CASE WHEN b.k % 10 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
CASE WHEN b.k % 10 = 0 THEN (CASE WHEN b.k % 70 = 0 THEN 'Yes' WHEN b.k % 110 = 0 THEN NULL ELSE 'No phone service' END) WHEN b.k % 41 = 1 THEN NULL WHEN b.k % 4 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines,
CASE WHEN b.k % 29 = 0 THEN 'Yes' WHEN b.k % 3 = 0 THEN 'DSL' WHEN b.k % 3 = 1 THEN 'Fiber optic' ELSE 'No' END AS InternetService,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 34 = 0 THEN 'Yes' WHEN b.k % 22 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 26 = 0 THEN NULL WHEN b.k % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 51 = 0 THEN 'Yes' WHEN b.k % 33 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 39 = 0 THEN NULL WHEN b.k % 3 = 0 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 68 = 0 THEN 'Yes' WHEN b.k % 44 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 52 = 0 THEN NULL WHEN b.k % 4 = 0 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 85 = 0 THEN 'Yes' WHEN b.k % 55 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 65 = 0 THEN NULL WHEN b.k % 5 = 0 THEN 'Yes' ELSE 'No' END AS TechSupport,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 102 = 0 THEN 'Yes' WHEN b.k % 66 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 78 = 0 THEN NULL WHEN b.k % 6 = 0 THEN 'Yes' ELSE 'No' END AS StreamingTV,
CASE WHEN b.k % 3 = 2 AND b.k % 29 <> 0 THEN (CASE WHEN b.k % 119 = 0 THEN 'Yes' WHEN b.k % 77 = 0 THEN NULL ELSE 'No internet service' END) WHEN b.k % 91 = 0 THEN NULL WHEN b.k % 7 = 0 THEN 'Yes' ELSE 'No' END AS StreamingMovies,
CASE WHEN b.k % 9 < 5 THEN 'Month-to-month' WHEN b.k % 9 < 7 THEN 'One year' ELSE 'Two year' END AS Contract,
CASE WHEN b.k % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
CASE WHEN b.k % 7 < 3 THEN 'Electronic check' WHEN b.k % 7 = 3 THEN 'Mailed check' WHEN b.k % 7 < 6 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
CASE WHEN b.k % 89 = 1 THEN CAST('NaN' AS FLOAT) WHEN b.k % 83 = 1 THEN CAST(-5.0 AS FLOAT) ELSE CAST(((b.k * 37) % 10000) / 100.0 AS FLOAT) END AS MonthlyCharges,
CASE WHEN b.t = 0 THEN CAST(NULL AS FLOAT) ELSE CAST((((b.k * 37) % 10000) * b.t) / 100.0 AS FLOAT) END AS TotalCharges,
CASE WHEN b.k % 4 = 0 THEN 'Yes' ELSE 'No' END AS Churn
FROM b
"""


def churn_raw_sql(customer: str = "customer") -> str:
    """The stand-in SQL with the customer table name filled in (used by the oracle)."""
    return CHURN_RAW_SQL.format(customer=customer)


def churn_raw(spark: SparkSession, customer: DataFrame) -> DataFrame:
    """Raw churn rows derived from ``customer``; only ``c_custkey`` is read (column pruning reaches the scan)."""
    return spark.sql(CHURN_RAW_SQL, customer=customer.select("c_custkey"))
