"""The catalog's queries in plain SQL over the source tables, for an independent engine."""

from __future__ import annotations

import re

from vigilmart.plans.catalog import EXPECTED_ROWS, LOOKED_UP_NAME
from vigilmart.sources.adapters import FIRST_SNAPSHOT, NEW_CUSTOMER_OFFSET, SECOND_SNAPSHOT

FIRST = f"TIMESTAMP '{FIRST_SNAPSHOT}'"
SECOND = f"TIMESTAMP '{SECOND_SNAPSHOT}'"
MID = "TIMESTAMP '2024-01-15 00:00:00'"
ATTRS = "full_name, ssn, country, branch_id, kyc_status"
ATTR_ORDER = ", ".join(f"{c} NULLS LAST" for c in ATTRS.split(", "))

# Common table expressions by name; each may use those listed in its own tuple.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": (
        ("customer_rows",),
        """
        SELECT * FROM customer_rows
        UNION ALL SELECT * REPLACE ('ZZ' AS country, 'PENDING' AS kyc_status, last_modified - INTERVAL 1 DAY AS last_modified)
          FROM customer_rows WHERE customer_id%25=5
        UNION ALL SELECT * FROM customer_rows WHERE customer_id%25=6""",
    ),
    "customer_rows": (
        (),
        f"""
        SELECT c_custkey AS customer_id, c_name AS full_name,
          lpad(CAST((c_custkey*7919)%1000 AS VARCHAR),3,'0') || '-' ||
          lpad(CAST((c_custkey*31)%100 AS VARCHAR),2,'0') || '-' ||
          lpad(CAST((c_custkey*6101)%10000 AS VARCHAR),4,'0') AS ssn,
          n_name AS country, CAST(c_custkey%12+1 AS INTEGER) AS branch_id,
          CASE WHEN c_mktsegment='FURNITURE' THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status,
          {FIRST} AS last_modified
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "src": (
        ("customers",),
        f"""
        SELECT customer_id, {ATTRS} FROM customers
        QUALIFY row_number() OVER (PARTITION BY customer_id
          ORDER BY last_modified DESC NULLS FIRST, {ATTR_ORDER}) = 1""",
    ),
    "second": (
        ("second_rows",),
        f"""
        SELECT customer_id, {ATTRS} FROM second_rows
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {ATTR_ORDER}) = 1""",
    ),
    "second_rows": (
        ("customers",),
        f"""
        SELECT customer_id, full_name, ssn,
          CASE WHEN customer_id%25=1 THEN 'XX' ELSE country END AS country,
          CAST(CASE WHEN customer_id%10=5 THEN branch_id%12+1 ELSE branch_id END AS INTEGER)
            AS branch_id,
          CASE WHEN customer_id%10<>0 THEN kyc_status
               WHEN kyc_status='VERIFIED' THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status
        FROM customers WHERE customer_id%100<>7 AND last_modified = {FIRST}
        UNION ALL
        SELECT customer_id+{NEW_CUSTOMER_OFFSET}, {ATTRS} FROM customers
        WHERE customer_id%100=3 AND last_modified = {FIRST}""",
    ),
    "accounts": (
        ("account_rows",),
        """
        SELECT * FROM account_rows
        UNION ALL SELECT * REPLACE ('CLOSED' AS account_type, last_modified - INTERVAL 1 DAY AS last_modified)
          FROM account_rows WHERE account_id%25=5
        UNION ALL SELECT * FROM account_rows WHERE account_id%25=6""",
    ),
    "account_rows": (
        (),
        f"""
        SELECT c_custkey*2+k AS account_id, c_custkey AS customer_id,
          CASE WHEN k=0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type,
          DATE '2020-01-01' + CAST(c_custkey%1000 AS INTEGER) AS open_date,
          {FIRST} AS last_modified
        FROM customer, (VALUES (0),(1)) AS v(k) WHERE k=0 OR c_custkey%2=0""",
    ),
    "transactions": (
        ("txn_rows",),
        """
        SELECT * FROM txn_rows
        UNION ALL SELECT * REPLACE (CAST(amount*2 AS DECIMAL(12,2)) AS amount, last_modified - INTERVAL 1 DAY AS last_modified)
          FROM txn_rows WHERE txn_id%25=5
        UNION ALL SELECT * FROM txn_rows WHERE txn_id%25=6""",
    ),
    "txn_rows": (
        (),
        """
        SELECT event_id AS txn_id,
          user_id*2 + CASE WHEN user_id%2=0 THEN event_id%2 ELSE 0 END AS account_id,
          CAST(ts AS DATE) AS txn_date, CAST(round(value*100,2) AS DECIMAL(12,2)) AS amount,
          CASE event_type WHEN 'purchase' THEN 'CASH' WHEN 'click' THEN 'CASH'
            WHEN 'view' THEN 'CARD' WHEN 'signup' THEN 'ACH' ELSE 'WIRE' END AS txn_type,
          CASE WHEN event_id%4=3 THEN 'DEBIT' ELSE 'CREDIT' END AS direction,
          ts AS last_modified
        FROM events""",
    ),
    "silver_accounts": (
        ("accounts",),
        """
        SELECT * FROM accounts
        QUALIFY row_number() OVER (PARTITION BY account_id
          ORDER BY last_modified DESC NULLS FIRST, customer_id NULLS LAST,
            account_type NULLS LAST, open_date NULLS LAST) = 1""",
    ),
    "silver_txn": (
        ("transactions",),
        """
        SELECT * FROM transactions
        QUALIFY row_number() OVER (PARTITION BY txn_id
          ORDER BY last_modified DESC NULLS FIRST, account_id NULLS LAST, txn_date NULLS LAST,
            amount NULLS LAST, txn_type NULLS LAST, direction NULLS LAST) = 1""",
    ),
    "watch": (
        (),
        """
        SELECT '  ' || lower(c_name) || ' ' AS name, 'OFAC SDN' AS list_source
        FROM customer WHERE c_custkey%50=1
        UNION ALL SELECT s_name, 'OFAC SDN' FROM supplier
        UNION ALL SELECT '  ' || lower(c_name) || ' ', 'EU LIST' FROM customer WHERE c_custkey%100=1""",
    ),
    "watchlist": (("watch",), "SELECT * FROM watch"),
    "silver_watch": (
        ("watch",),
        """
        SELECT name, list_source FROM watch
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY list_source NULLS LAST) = 1""",
    ),
    "dim_customer": (
        ("src",),
        f"""
        SELECT row_number() OVER (ORDER BY customer_id NULLS LAST) AS customer_sk, customer_id,
          {ATTRS}, {FIRST} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
        FROM src""",
    ),
    "closed": (
        ("dim_customer", "second"),
        f"""
        SELECT d.customer_sk, d.customer_id, d.full_name, d.ssn, d.country, d.branch_id,
          d.kyc_status, d.valid_from,
          CASE WHEN s.kyc_status<>d.kyc_status OR s.country<>d.country OR s.full_name<>d.full_name
            THEN {SECOND} END AS valid_to,
          NOT coalesce(s.kyc_status<>d.kyc_status OR s.country<>d.country
            OR s.full_name<>d.full_name, FALSE) AS is_current
        FROM dim_customer d LEFT JOIN second s ON s.customer_id = d.customer_id""",
    ),
    "applied": (
        ("closed", "second"),
        f"""
        SELECT * FROM closed
        UNION ALL
        SELECT (SELECT max(customer_sk) FROM closed)
            + row_number() OVER (ORDER BY s.customer_id NULLS LAST),
          s.customer_id, s.full_name, s.ssn, s.country, s.branch_id, s.kyc_status, {SECOND}, NULL, TRUE
        FROM second s
        WHERE NOT EXISTS (
          SELECT 1 FROM closed c WHERE c.is_current AND c.customer_id = s.customer_id)""",
    ),
    "dim_date": (
        (),
        """
        SELECT CAST(year(d)*10000+month(d)*100+day(d) AS BIGINT) AS date_sk, d AS date,
          CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
          CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
          CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
          strftime(d, '%a') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT DATE '2020-01-01' + CAST(i AS INTEGER) AS d FROM range(2922) AS r(i))""",
    ),
    "dim_branch": (
        ("dim_customer",),
        """
        SELECT row_number() OVER (ORDER BY branch_id) AS branch_sk, branch_id,
          'Branch ' || branch_id AS branch_name
        FROM (SELECT DISTINCT branch_id FROM dim_customer WHERE branch_id IS NOT NULL)""",
    ),
    "dim_type": (
        ("silver_txn",),
        """
        SELECT row_number() OVER (ORDER BY txn_type NULLS LAST) AS txn_type_sk, txn_type,
          CASE txn_type WHEN 'CASH' THEN 'Cash' WHEN 'WIRE' THEN 'Wire Transfer'
            WHEN 'ACH' THEN 'ACH Transfer' WHEN 'CARD' THEN 'Card' ELSE txn_type END
            AS txn_type_desc
        FROM (SELECT DISTINCT txn_type FROM silver_txn)""",
    ),
    "dim_account": (
        ("silver_accounts",),
        """
        SELECT row_number() OVER (ORDER BY account_id NULLS LAST) AS account_sk, account_id,
          customer_id, account_type, open_date FROM silver_accounts""",
    ),
    "fact": (
        ("silver_txn", "dim_account", "dim_type", "dim_customer", "dim_branch", "dim_date"),
        """
        SELECT t.txn_id, a.account_sk, y.txn_type_sk, b.branch_sk, d.date_sk, t.txn_date,
          t.txn_type, t.direction, t.amount, c.customer_sk
        FROM silver_txn t
        JOIN dim_account a ON a.account_id = t.account_id
        JOIN dim_type y ON y.txn_type = t.txn_type
        LEFT JOIN dim_customer c ON c.customer_id = a.customer_id AND c.is_current
        LEFT JOIN dim_branch b ON b.branch_id = c.branch_id
        LEFT JOIN dim_date d ON d.date = t.txn_date""",
    ),
    "analyst_customer": (
        ("dim_customer",),
        "SELECT * FROM dim_customer WHERE branch_id IN (1, 2, 3, 4, 5, 6)",
    ),
    "line_ranked": (
        (),
        """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
          row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS FIRST, l_partkey NULLS LAST, l_suppkey NULLS LAST,
              l_extendedprice DESC NULLS FIRST) AS rn
        FROM lineitem""",
    ),
}


def _with(*names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n"


def _cash(customer: str, rows: str, having: str, count: str) -> str:
    return f"""
        SELECT c.customer_id, c.full_name, f.txn_date, count(*) AS {count},
          CAST(sum(f.amount) AS DECIMAL(38,2)) AS total_cash
        FROM fact f JOIN dim_account a ON a.account_sk = f.account_sk
        JOIN {customer} c ON c.customer_id = a.customer_id AND c.is_current
        WHERE f.txn_type='CASH' AND f.direction='CREDIT' {rows}
        GROUP BY 1, 2, 3 HAVING {having}"""


_CTR_BODY = _cash("dim_customer", "", "sum(f.amount) > 10000", "cash_txn_count")
_CTR = _with("fact") + _CTR_BODY
_STRUCTURING = _with("fact") + _cash(
    "dim_customer",
    "AND f.amount < 10000",
    "count(*) >= 3 AND sum(f.amount) > 10000",
    "deposit_count",
)


def _delivered(sql: str) -> str:
    """The same over transactions some of which have no date, as the streams deliver them."""
    day = "CAST(ts AS DATE) AS txn_date"
    return sql.replace(day, "CASE WHEN event_id%50<>7 THEN CAST(ts AS DATE) END AS txn_date")


def _hits(customer: str) -> str:
    return f"""
        SELECT DISTINCT c.customer_id, c.full_name, w.list_source
        FROM {customer} c JOIN silver_watch w ON upper(trim(c.full_name)) = upper(trim(w.name))
        WHERE c.is_current"""


_LATEST_LINES = (
    _with("line_ranked")
    + """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice
         FROM line_ranked WHERE rn = 1"""
)

_BRONZE = f"{FIRST} AS load_ts, TRUE AS from_entity_folder"

# check name -> (category, metric text, what is counted)
_ZERO = {
    "pk_dim_customer_unique": (
        "uniqueness",
        "duplicate current customer_id",
        "(SELECT customer_id FROM dim_customer WHERE is_current GROUP BY 1 HAVING count(*) > 1)",
    ),
    "pk_dim_account_unique": (
        "uniqueness",
        "duplicate account_id",
        "(SELECT account_id FROM dim_account GROUP BY 1 HAVING count(*) > 1)",
    ),
    "pk_fact_txn_unique": (
        "uniqueness",
        "duplicate txn_id",
        "(SELECT txn_id FROM fact GROUP BY 1 HAVING count(*) > 1)",
    ),
    "null_customer_id": (
        "completeness",
        "null customer_id",
        "(SELECT 1 FROM dim_customer WHERE customer_id IS NULL)",
    ),
    "null_ssn": (
        "completeness",
        "null ssn (current rows)",
        "(SELECT 1 FROM dim_customer WHERE is_current AND ssn IS NULL)",
    ),
    "fk_account_to_customer": (
        "integrity",
        "orphan accounts (no current customer)",
        """(SELECT 1 FROM silver_accounts a LEFT JOIN dim_customer c
            ON c.customer_id = a.customer_id AND c.is_current WHERE c.customer_id IS NULL)""",
    ),
    "fk_fact_to_account": (
        "integrity",
        "fact rows with no dim_account",
        """(SELECT 1 FROM fact f LEFT JOIN dim_account d ON d.account_sk = f.account_sk
            WHERE d.account_sk IS NULL)""",
    ),
    "scd2_one_current_per_customer": (
        "scd2",
        "customers with != 1 current row",
        "(SELECT customer_id FROM dim_customer WHERE is_current GROUP BY 1 HAVING count(*) <> 1)",
    ),
    "scd2_one_current_strict": (
        "scd2",
        "customers with != 1 current row",
        """(SELECT customer_id FROM dim_customer GROUP BY 1
            HAVING count(*) FILTER (WHERE is_current) <> 1)""",
    ),
    "accepted_txn_type": (
        "validity",
        "rows with unexpected txn_type",
        "(SELECT 1 FROM silver_txn WHERE txn_type NOT IN ('CASH','WIRE','ACH','CARD'))",
    ),
    "accepted_direction": (
        "validity",
        "rows with unexpected direction",
        "(SELECT 1 FROM silver_txn WHERE direction NOT IN ('CREDIT','DEBIT'))",
    ),
    "amount_positive": (
        "validity",
        "rows with amount <= 0",
        "(SELECT 1 FROM silver_txn WHERE amount <= 0)",
    ),
}
_FIFTEEN = [name for name in _ZERO if name != "scd2_one_current_strict"]


def _zero_body(name: str) -> str:
    category, text, counted = _ZERO[name]
    return f"""
        SELECT '{name}' AS check_name, '{category}' AS category,
          CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
          count(*) || ' {text}' AS metric
        FROM {counted} AS counted"""


def _zero(name: str) -> str:
    return _with("fact", "accounts") + _zero_body(name)


_ROWCOUNT_BODY = " UNION ALL ".join(
    f"""
        SELECT 'bronze_{e}_count' AS check_name, 'rowcount' AS category,
          CASE WHEN count(*) = {n} THEN 'PASS' ELSE 'FAIL' END AS status,
          'expected={n} actual=' || count(*) AS metric
        FROM {e}"""
    for e, n in EXPECTED_ROWS.items()
)
_RECONCILED_BODY = """
        SELECT 'fact_vs_silver_txns' AS check_name, 'reconciliation' AS category,
          CASE WHEN f = s THEN 'PASS' ELSE 'FAIL' END AS status,
          'fact=' || f || ' silver=' || s AS metric
        FROM (SELECT (SELECT count(*) FROM fact) AS f, (SELECT count(*) FROM silver_txn) AS s)"""
_CARD_BODY = " UNION ALL ".join(
    [_ROWCOUNT_BODY, _RECONCILED_BODY, *[_zero_body(name) for name in _FIFTEEN]]
)
_CARD = _with("fact", "accounts", "customers") + _CARD_BODY
_CLEAN_BODY = " UNION ALL ".join(
    [
        *[
            f"""SELECT 'bronze_{e}_count' AS check_name, 'rowcount' AS category, 'PASS' AS status,
                  'expected=' || count(*) || ' actual=' || count(*) AS metric FROM {e}"""
            for e in EXPECTED_ROWS
        ],
        _RECONCILED_BODY,
        *[_zero_body(name) for name in _FIFTEEN],
    ]
)
_DIRTY_TABLES = """, bad_customer AS (
          SELECT * REPLACE (CASE WHEN customer_id%11<>0 THEN ssn END AS ssn) FROM dim_customer),
        dirty_dim_customer AS (
          SELECT * FROM bad_customer
          UNION ALL SELECT * REPLACE (NULL AS customer_id) FROM bad_customer WHERE customer_id%17=0
          UNION ALL SELECT * FROM bad_customer WHERE customer_id%13=0),
        dirty_silver_accounts AS (
          SELECT * REPLACE (CASE WHEN account_id%7=0 THEN customer_id+1000000000000 ELSE customer_id END
            AS customer_id) FROM silver_accounts),
        dirty_dim_account AS (
          SELECT * FROM dim_account UNION ALL SELECT * FROM dim_account WHERE account_id%5=0),
        dirty_silver_txn AS (
          SELECT * REPLACE (
            CASE WHEN txn_id%9=0 THEN 'CRYPTO' ELSE txn_type END AS txn_type,
            CASE WHEN txn_id%8=0 THEN 'SIDEWAYS' ELSE direction END AS direction,
            CASE WHEN txn_id%6=0 THEN -amount ELSE amount END AS amount) FROM silver_txn),
        bad_fact AS (
          SELECT * REPLACE (CASE WHEN txn_id%10=3 THEN -account_sk ELSE account_sk END AS account_sk)
          FROM fact),
        dirty_fact AS (SELECT * FROM bad_fact UNION ALL SELECT * FROM bad_fact WHERE txn_id%4=0)
"""
_DIRTY_BODY = re.sub(
    r"\b(FROM|JOIN) (fact|dim_customer|dim_account|silver_accounts|silver_txn)\b", r"\1 dirty_\2", _CARD_BODY
)


# The fact after deliveries that leave some transactions without a day.
_UNDATED = """, undated AS (SELECT * REPLACE (
           CASE WHEN txn_id % 50 <> 7 THEN txn_date END AS txn_date, CASE WHEN txn_id % 50 <> 7 THEN date_sk END AS date_sk)
         FROM fact) """


def _summary(fact: str) -> str:
    ctr = _CTR_BODY.replace("FROM fact", f"FROM {fact}")
    return f"""SELECT CAST(sum(amount) FILTER (WHERE txn_type='CASH' AND direction='CREDIT')
             AS DECIMAL(38,2)) AS total_cash_credits,
           count(*) AS txn_count,
           round(CAST(sum(amount) AS DOUBLE) / count(amount), 6) AS avg_txn_value,
           round(CAST(100 * sum(amount) FILTER (WHERE txn_type='CASH') AS DOUBLE)
             / CAST(sum(amount) AS DOUBLE), 6) AS cash_pct_of_volume,
           (SELECT count(DISTINCT customer_id) FROM ({ctr})) AS ctr_customers
         FROM {fact}"""


def _branches(fact: str) -> str:
    return f"""SELECT b.branch_name, count(*) AS txn_count,
           CAST(sum(f.amount) AS DECIMAL(38,2)) AS total_amount
         FROM {fact} f LEFT JOIN dim_branch b ON b.branch_sk = f.branch_sk GROUP BY 1"""


def _trend(fact: str) -> str:
    return f"""SELECT txn_date, count(*) AS txn_count,
           CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount
         FROM {fact} GROUP BY 1"""


def _gate(tables: str, body: str) -> str:
    return (
        _with("fact", "accounts", "customers")
        + tables
        + f""", checks AS ({body})
         SELECT CASE WHEN count(*) FILTER (WHERE status='FAIL') = 0 THEN 'ALL CHECKS PASSED'
           ELSE count(*) FILTER (WHERE status='FAIL') || ' CHECK(S) FAILED' END AS overall_result
         FROM checks"""
    )


def _ranked(sql: str) -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY total_cash DESC, customer_id NULLS LAST,
           txn_date NULLS LAST) AS rank FROM ({sql})"""


def _fields(entity: str, kinds: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{f}' AS field, '{k}' AS kind, count({f}) AS filled FROM {entity} HAVING count({f}) > 0"
        for f, k in kinds.items()
    )



_DIM = (
    "customer_sk, customer_id, full_name, ssn, country, branch_id, kyc_status, valid_from, "
    "valid_to, is_current"
)

# Kinds of the fields in bronze, by entity.
_KINDS = {
    "customers": {
        "customer_id": "BIGINT",
        "full_name": "STRING",
        "ssn": "STRING",
        "country": "STRING",
        "branch_id": "BIGINT",
        "kyc_status": "STRING",
        "last_modified": "TIMESTAMP_NTZ",
    },
    "accounts": {
        "account_id": "BIGINT",
        "customer_id": "BIGINT",
        "account_type": "STRING",
        "open_date": "DATE",
        "last_modified": "TIMESTAMP_NTZ",
    },
    "transactions": {
        "txn_id": "BIGINT",
        "account_id": "BIGINT",
        "txn_date": "DATE",
        "amount": "DECIMAL",
        "txn_type": "STRING",
        "direction": "STRING",
        "last_modified": "TIMESTAMP_NTZ",
    },
    "watchlist": {"name": "STRING", "list_source": "STRING"},
}

def _by_role(query: str) -> str:
    """A query over ``{customer}``, as the open roles and as the analyst see it; ``{role}`` names the role."""
    seen = (("ACCOUNTADMIN", "dim_customer"), ("AUDITOR", "dim_customer"), ("COMPLIANCE_ANALYST", "analyst_customer"))
    return " UNION ALL ".join(f"SELECT '{role}' AS role_name, * FROM ({query.format(customer=c, role=role)})" for role, c in seen)


_ANALYST_ACCOUNTS = "(SELECT account_id FROM silver_accounts WHERE customer_id IN (SELECT customer_id FROM analyst_customer))"

ORACLES: dict[str, str] = {
    "scan_parquet": _with("transactions") + "SELECT * FROM transactions",
    "scan_customers": _with("customers") + "SELECT * FROM customers",
    "scan_accounts": _with("accounts") + "SELECT * FROM accounts",
    "scan_watchlist": _with("watch") + "SELECT * FROM watch",
    "bronze_land": _with("transactions") + f"SELECT *, {_BRONZE} FROM transactions",
    "bronze_land_customers": _with("customers") + f"SELECT *, {_BRONZE} FROM customers",
    "bronze_land_accounts": _with("accounts") + f"SELECT *, {_BRONZE} FROM accounts",
    "bronze_land_watchlist": _with("watch") + f"SELECT *, {_BRONZE} FROM watch",
    "silver_accounts": _with("silver_accounts") + "SELECT * FROM silver_accounts",
    "silver_transactions": _with("silver_txn") + "SELECT * FROM silver_txn",
    "rejected_transactions": _with("transactions")
    + """SELECT txn_id, CASE WHEN txn_id % 100 = 9 THEN 'txn_date,amount' ELSE 'txn_date' END AS fields
         FROM transactions WHERE txn_id % 50 = 9""",
    "accepted_transactions": _with("transactions") + "SELECT * FROM transactions WHERE txn_id % 50 <> 9",
    "silver_watchlist": _with("silver_watch") + "SELECT * FROM silver_watch",
    "customer_src": _with("src") + "SELECT * FROM src",
    "customer_lookup": _with("dim_customer")
    + f"SELECT {_DIM} FROM dim_customer WHERE full_name = '{LOOKED_UP_NAME}'",
    "dedup_latest": _LATEST_LINES,
    "layer_counts": _with("customers", "silver_accounts", "silver_txn", "silver_watch")
    + " UNION ALL ".join(
        f"SELECT '{label}' AS tbl, count(*) AS row_count FROM {cte}"
        for label, cte in (
            ("raw.customers", "customers"),
            ("raw.accounts", "accounts"),
            ("raw.transactions", "transactions"),
            ("raw.watchlist", "watch"),
            ("silver.accounts", "silver_accounts"),
            ("silver.transactions", "silver_txn"),
            ("silver.watchlist", "silver_watch"),
        )
    ),
    "distinct_values": _with("silver_txn")
    + """SELECT DISTINCT 'txn_type' AS column_name, txn_type AS value FROM silver_txn
         UNION ALL SELECT DISTINCT 'direction', direction FROM silver_txn""",
    "scd2_first_load": _with("dim_customer") + f"SELECT {_DIM} FROM dim_customer",
    "scd2_close_out": _with("closed") + f"SELECT {_DIM} FROM closed",
    "scd2_insert": _with("applied") + f"SELECT {_DIM} FROM applied",
    "scd2_apply": _with("applied") + f"SELECT {_DIM} FROM applied",
    "scd2_verify": _with("applied")
    + """SELECT count(*) AS total_rows,
           CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_rows
         FROM applied""",
    "scd2_history": _with("applied")
    + f"""SELECT customer_id,
            row_number() OVER (PARTITION BY customer_id ORDER BY valid_from, customer_sk) AS version_no,
            {ATTRS}, valid_from, valid_to, is_current
          FROM applied""",
    "bronze_schema": _with("customers", "accounts", "transactions", "watchlist")
    + " UNION ALL ".join(_fields(e, kinds) for e, kinds in _KINDS.items()),
    "bronze_peek": _with("customers")
    + f"""SELECT customer_id, {ATTRS}, last_modified FROM customers
          ORDER BY customer_id NULLS LAST, last_modified NULLS LAST LIMIT 1""",
    "file_manifest": _with("customers", "accounts", "transactions", "watchlist")
    + " UNION ALL ".join(
        f"SELECT '{e}' AS entity, CAST(count(*) AS BIGINT) AS row_count, TRUE AS all_listed FROM {e}" for e in _KINDS
    ),
    "dim_date": _with("fact", "dim_date")
    + """, days AS (SELECT txn_date, count(*) AS n, sum(amount) AS total FROM fact GROUP BY 1)
         SELECT d.* EXCLUDE (date), coalesce(d.date, days.txn_date) AS date, coalesce(n, 0) AS txn_count,
           CAST(coalesce(total, 0) AS DECIMAL(38,2)) AS total_amount
         FROM dim_date d FULL JOIN days ON days.txn_date = d.date""",
    "dim_branch": _with("dim_branch") + "SELECT * FROM dim_branch",
    "dim_transaction_type": _with("dim_type") + "SELECT * FROM dim_type",
    "dim_account": _with("dim_account") + "SELECT * FROM dim_account",
    "fact_transaction": _with("fact") + "SELECT * EXCLUDE (customer_sk) FROM fact",
    "fact_with_customer_sk": _with("fact") + "SELECT * FROM fact",
    "fact_incremental": _with("fact") + _UNDATED + "SELECT * EXCLUDE (customer_sk) FROM undated",
    "fact_reconciliation": _with("fact")
    + """SELECT (SELECT count(*) FROM fact) AS fact_rows,
           (SELECT count(*) FROM silver_txn) AS silver_rows""",
    "fact_point_in_time": _with(
        "silver_txn", "dim_account", "dim_type", "dim_customer", "second", "dim_date"
    )
    + f""", moved AS (
           SELECT d.customer_id FROM dim_customer d JOIN second s ON s.customer_id = d.customer_id
           WHERE s.kyc_status<>d.kyc_status OR s.country<>d.country OR s.full_name<>d.full_name
             OR s.branch_id<>d.branch_id),
         added AS (
           SELECT (SELECT max(customer_sk) FROM dim_customer)
               + row_number() OVER (ORDER BY s.customer_id) AS customer_sk,
             s.customer_id, s.branch_id
           FROM second s
           WHERE s.customer_id IN (SELECT customer_id FROM moved)
             OR s.customer_id NOT IN (SELECT customer_id FROM dim_customer)),
         versions AS (
           SELECT d.customer_sk, d.customer_id, d.branch_id, CAST(NULL AS TIMESTAMP) AS lo,
             CASE WHEN d.customer_id IN (SELECT customer_id FROM moved) THEN {MID} END AS hi
           FROM dim_customer d
           UNION ALL
           SELECT customer_sk, customer_id, branch_id, {MID}, NULL FROM added),
         branches AS (
           SELECT row_number() OVER (ORDER BY branch_id) AS branch_sk, branch_id
           FROM (SELECT DISTINCT branch_id FROM versions WHERE branch_id IS NOT NULL))
         SELECT t.txn_id, a.account_sk, y.txn_type_sk, b.branch_sk, d.date_sk, t.txn_date,
           t.txn_type, t.direction, t.amount, v.customer_sk
         FROM silver_txn t
         JOIN dim_account a ON a.account_id = t.account_id
         JOIN dim_type y ON y.txn_type = t.txn_type
         LEFT JOIN versions v ON v.customer_id = a.customer_id
           AND (v.lo IS NULL OR t.txn_date >= v.lo) AND (v.hi IS NULL OR t.txn_date < v.hi)
         LEFT JOIN branches b ON b.branch_id = v.branch_id
         LEFT JOIN dim_date d ON d.date = t.txn_date""",
    "ctr_candidates": _CTR,
    "ctr_ranked": _ranked(_CTR),
    "ctr_by_customer_key": _CTR,
    "structuring_flags": _STRUCTURING,
    "structuring_ranked": _ranked(_STRUCTURING),
    "structuring_by_customer_key": _STRUCTURING,
    "sanctions_hits": _with("dim_customer", "silver_watch") + _hits("dim_customer"),
    "sanctions_fuzzy": _with("dim_customer", "silver_watch")
    + """SELECT c.customer_id, c.full_name, w.list_source,
           CAST(min(levenshtein(upper(trim(c.full_name)), upper(trim(w.name)))) AS INTEGER) AS distance
         FROM dim_customer c, silver_watch w
         WHERE c.is_current AND levenshtein(upper(trim(c.full_name)), upper(trim(w.name))) <= 2
         GROUP BY 1, 2, 3""",
    "mask_ssn": _with("dim_customer")
    + """SELECT customer_id, ssn AS ssn_analyst, 'XXX-XX-' || right(ssn, 4) AS ssn_auditor,
           'XXX-XX-' || right(ssn, 4) AS ssn_sysadmin
         FROM dim_customer""",
    "row_access": _with("analyst_customer") + f"SELECT {_DIM} FROM analyst_customer",
    "bronze_as_auditor": _with("customers")
    + "SELECT * REPLACE ('XXX-XX-' || right(ssn, 4) AS ssn) FROM customers",
    "bronze_customers_as_analyst": _with("customers") + "SELECT * FROM customers WHERE branch_id <= 6",
    "bronze_transactions_as_analyst": _with("transactions", "silver_accounts", "analyst_customer")
    + f"SELECT * FROM transactions WHERE account_id IN {_ANALYST_ACCOUNTS}",
    "accounts_region_scoped": _with("silver_accounts", "analyst_customer")
    + "SELECT * FROM silver_accounts WHERE customer_id IN (SELECT customer_id FROM analyst_customer)",
    "sql_customers_by_role": _with("dim_customer", "analyst_customer")
    + _by_role(
        "SELECT customer_id, full_name, CASE WHEN '{role}' = 'AUDITOR' THEN 'XXX-XX-' || right(ssn, 4) ELSE ssn END AS ssn, branch_id FROM {customer}"
    ),
    "sql_ctr_by_role": _with("fact", "analyst_customer")
    + _by_role(_cash("{customer}", "", "sum(f.amount) > 10000", "cash_txn_count")),
    "sql_structuring_by_role": _with("fact", "analyst_customer")
    + _by_role(_cash("{customer}", "AND f.amount < 10000", "count(*) >= 3 AND sum(f.amount) > 10000", "deposit_count")),
    "sql_sanctions_by_role": _with("dim_customer", "analyst_customer", "silver_watch") + _by_role(_hits("{customer}")),
    "ctr_region_scoped": _with("fact", "analyst_customer")
    + _cash("analyst_customer", "", "sum(f.amount) > 10000", "cash_txn_count"),
    "sanctions_region_scoped": _with("analyst_customer", "silver_watch") + _hits("analyst_customer"),
    "masked_sample": _with("analyst_customer")
    + """SELECT * FROM (SELECT 'COMPLIANCE_ANALYST' AS role_name, customer_id, full_name, ssn, branch_id
           FROM analyst_customer ORDER BY customer_id LIMIT 5)
         UNION ALL
         SELECT * FROM (SELECT 'AUDITOR', customer_id, full_name, 'XXX-XX-' || right(ssn, 4), branch_id
           FROM analyst_customer ORDER BY customer_id LIMIT 5)""",
    "rows_visible_by_role": _with("dim_customer", "analyst_customer")
    + """SELECT 'ACCOUNTADMIN' AS role_name, count(*) AS rows_visible FROM dim_customer
         UNION ALL SELECT 'AUDITOR', count(*) FROM dim_customer
         UNION ALL SELECT 'COMPLIANCE_ANALYST', count(*) FROM analyst_customer""",
    "visible_branches": _with("analyst_customer") + "SELECT DISTINCT branch_id FROM analyst_customer",
    "classified_columns": _with("dim_customer")
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{tag}' AS classification, count(*) AS row_count,
              count({c}) AS filled_count, count(DISTINCT {c}) AS distinct_count FROM dim_customer"""
        for c, tag in (("ssn", "PII_RESTRICTED"), ("full_name", "PII"), ("country", "INTERNAL"))
    ),
    "dq_rowcount": _with("customers", "accounts", "transactions") + _ROWCOUNT_BODY,
    "dq_fact_vs_silver": _with("fact") + _RECONCILED_BODY,
    "dq_pk_dim_customer": _zero("pk_dim_customer_unique"),
    "dq_pk_dim_account": _zero("pk_dim_account_unique"),
    "dq_pk_fact_txn": _zero("pk_fact_txn_unique"),
    "dq_null_customer_id": _zero("null_customer_id"),
    "dq_null_ssn": _zero("null_ssn"),
    "dq_fk_account_to_customer": _zero("fk_account_to_customer"),
    "dq_fk_fact_to_account": _zero("fk_fact_to_account"),
    "dq_scd2_one_current": _zero("scd2_one_current_per_customer"),
    "dq_scd2_one_current_strict": _zero("scd2_one_current_strict"),
    "dq_accepted_txn_type": _zero("accepted_txn_type"),
    "dq_accepted_direction": _zero("accepted_direction"),
    "dq_amount_positive": _zero("amount_positive"),
    "dq_scorecard": _CARD,
    "dq_scorecard_display": f"""SELECT *,
           CAST(row_number() OVER (ORDER BY status, category, check_name) AS INTEGER) AS place FROM ({_CARD})""",
    "dq_scorecard_dirty": _with("fact", "accounts", "customers") + _DIRTY_TABLES + _DIRTY_BODY,
    "dq_gate_dirty": _gate(_DIRTY_TABLES, _DIRTY_BODY),
    "dq_scorecard_clean": _with("fact", "accounts", "customers") + _CLEAN_BODY,
    "dq_gate_clean": _gate("", _CLEAN_BODY),
    "dq_gate": _with("fact", "accounts", "customers")
    + f""", checks AS ({_CARD_BODY})
         SELECT CASE WHEN count(*) FILTER (WHERE status='FAIL') = 0 THEN 'ALL CHECKS PASSED'
           ELSE count(*) FILTER (WHERE status='FAIL') || ' CHECK(S) FAILED' END AS overall_result
         FROM checks""",
    "kpi_summary": _with("fact") + _summary("fact"),
    "kpi_branch_breakdown": _with("fact") + _branches("fact"),
    "kpi_volume_trend": _with("fact") + _trend("fact"),
    "kpi_summary_rollup": _with("fact") + _UNDATED + _summary("undated"),
    "kpi_summary_months": _with("fact")
    + _UNDATED
    + """, summed AS (SELECT * FROM undated WHERE txn_date >= DATE '2024-01-01' AND txn_date < DATE '2024-04-01') """
    + _summary("summed"),
    "kpi_branch_breakdown_rollup": _with("fact") + _UNDATED + _branches("undated"),
    "kpi_volume_trend_rollup": _with("fact") + _UNDATED + _trend("undated"),
    "dq_scorecard_rollup": _CARD,
    "stream_bronze": _with("transactions") + "SELECT * FROM transactions",
    "stream_dedup": _LATEST_LINES,
    "stream_first_seen": _delivered(
        _with("silver_txn")
        + """SELECT * EXCLUDE (amount, last_modified),
               CASE WHEN txn_id%10=0 THEN CAST(amount*2 AS DECIMAL(12,2)) ELSE amount END AS amount,
               CASE WHEN txn_id%10=0 THEN last_modified - INTERVAL 1 DAY ELSE last_modified END
                 AS last_modified
             FROM silver_txn"""
    ),
    "stream_scd2": _with("applied") + f"SELECT {_DIM} FROM applied",
    "stream_ctr": _delivered(_CTR),
    "stream_ctr_windowed": _delivered(_CTR),
    "stream_structuring": _delivered(_STRUCTURING),
}
