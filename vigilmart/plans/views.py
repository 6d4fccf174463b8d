"""The mart as named views of a SQL session, masked and scoped by the role of the session.

``register`` declares the session variable ``app_role``, the functions ``mask_ssn``,
``sees_all_branches`` and ``visible_branches``, and views over the written tables. A view looks
up the variable when a query is analysed; without a role it shows no row. The plain tables stay
readable by whoever may read their files: access to files is the storage's matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilmart import settings
from vigilmart.operators import governance
from vigilmart.plans.build import Mart

ROLE = "app_role"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


FUNCTIONS = (
    f"""mask_ssn(ssn STRING, role STRING) RETURNS STRING
    RETURN CASE WHEN upper(trim(role)) IN ({_listed(settings.UNMASKED_ROLES)}) THEN ssn
      ELSE concat('{settings.SSN_MASK_PREFIX}', right(ssn, 4)) END""",
    f"""sees_all_branches(role STRING) RETURNS BOOLEAN
    RETURN coalesce(upper(trim(role)) IN ({_listed(settings.ALL_BRANCH_ROLES)}), false)""",
    """visible_branches(role STRING) RETURNS TABLE (branch_id INT)
    RETURN SELECT branch_id FROM role_branches WHERE role_name = upper(trim(role))""",
)

_CASH = "txn_type = 'CASH' AND direction = 'CREDIT'"
_LIMIT = settings.CASH_LIMIT


def _customer_days(rows: str) -> str:
    """Sums per account and day, then per customer and day, before the customers come in."""
    return f"""
    WITH daily AS (
        SELECT account_sk, txn_date, count(*) AS n, sum(amount) AS total
        FROM fact_transaction WHERE {rows} GROUP BY account_sk, txn_date),
    owned AS (
        SELECT customer_id, txn_date, sum(n) AS n, sum(total) AS total
        FROM daily JOIN dim_account USING (account_sk) GROUP BY customer_id, txn_date),
    days AS (
        SELECT customer_id, full_name, txn_date, sum(n) AS n, CAST(sum(total) AS DECIMAL(38, 2)) AS total
        FROM owned JOIN dim_customer USING (customer_id) WHERE is_current GROUP BY customer_id, full_name, txn_date)"""


VIEWS = {
    "dim_customer": f"""
    SELECT customer_sk, customer_id, full_name, mask_ssn(ssn, session.{ROLE}) AS ssn, country, branch_id, kyc_status,
        valid_from, valid_to, is_current
    FROM plain_dim_customer
    WHERE sees_all_branches(session.{ROLE}) OR branch_id IN (SELECT branch_id FROM visible_branches(session.{ROLE}))""",
    "dim_account": f"""
    SELECT * FROM plain_dim_account
    WHERE sees_all_branches(session.{ROLE}) OR customer_id IN (SELECT customer_id FROM dim_customer WHERE is_current)""",
    "fact_transaction": f"""
    SELECT * FROM plain_fact_transaction
    WHERE sees_all_branches(session.{ROLE}) OR account_sk IN (SELECT account_sk FROM dim_account)""",
    "dim_branch": "SELECT * FROM plain_dim_branch",
    "dim_date": "SELECT * FROM plain_dim_date",
    "dim_transaction_type": "SELECT * FROM plain_dim_transaction_type",
    "watchlist": "SELECT * FROM plain_watchlist",
    "reporting_ctr_candidates": f"""{_customer_days(_CASH)}
    SELECT customer_id, full_name, txn_date, n AS cash_txn_count, total AS total_cash FROM days WHERE total > {_LIMIT}""",
    "reporting_structuring_flags": f"""{_customer_days(f"{_CASH} AND amount < {_LIMIT}")}
    SELECT customer_id, full_name, txn_date, n AS deposit_count, total AS total_cash
    FROM days WHERE n >= {settings.MIN_SPLIT_DEPOSITS} AND total > {_LIMIT}""",
    "reporting_sanctions_hits": """
    SELECT DISTINCT customer_id, full_name, list_source
    FROM dim_customer JOIN watchlist ON upper(trim(full_name)) = upper(trim(name)) WHERE is_current""",
}


def register(mart: Mart, mapping: DataFrame | None = None) -> SparkSession:
    """Give the session the functions and views of a mart, under no role yet."""
    spark = mart.spark
    plain = {
        "dim_customer": mart.dim_customer,
        "dim_account": mart.dim_account,
        "fact_transaction": mart.fact,
        "dim_branch": mart.dim_branch,
        "dim_date": mart.dim_date,
        "dim_transaction_type": mart.dim_transaction_type,
        "watchlist": mart.watchlist,
    }
    for name, table in plain.items():
        table.createOrReplaceTempView(f"plain_{name}")
    (governance.branch_access(spark) if mapping is None else mapping).createOrReplaceTempView("role_branches")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT NULL")
    for function in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}")
    for name, query in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")
    return spark


def as_role(spark: SparkSession, role: str | None) -> SparkSession:
    """Queries of the session see the views as this role from now on."""
    spark.sql(f"SET VARIABLE {ROLE} = :role", args={"role": role})
    return spark
