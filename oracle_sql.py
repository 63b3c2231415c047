"""Independent DuckDB SQL for every checkable query in ``__spark_entry__``.

The whole pipeline is rebuilt in SQL from the driver's test views: the bridge
to the five raw banking sources, the cleaners, the enriched fact, the risk
mart, the DQ profile, and then each question. Every query is ``WITH <chain>
SELECT ...``. Rounding and money follow the same rules as the Spark side:
``round2`` rounds the decimal value; money is summed exactly (``money``).
"""

from __future__ import annotations

SHIFT = 9131
ACCOUNT_TYPES = "('Savings', 'Current', 'Salary', 'NRI', 'Fixed Deposit')"
TXN_TYPES = ("('Deposit', 'Withdrawal', 'Transfer', 'Bill Payment', 'POS Purchase', "
             "'ATM Withdrawal', 'Loan EMI')")
RUN_AT = "2026-01-01T00:00:00"


def _rounded(x: str, places: int) -> str:
    return (f"CASE WHEN abs({x}) < 1e15 THEN CAST(round(CAST(CASE WHEN abs({x}) < 1e15 THEN {x} END "
            f"AS DECIMAL(38,6)), {places}) AS DOUBLE) ELSE {x} END")


def r2(x: str) -> str:
    return _rounded(x, 2)


def r0(x: str) -> str:
    return _rounded(x, 0)


def money(x: str) -> str:
    """The exact sum of doubles as the nearest double: whole parts add up as big numbers, the
    rest (a multiple of 2^-80 down to 4e-7) as 128-bit integers; the text of the result, with
    all that decides the rounding, is read as a double."""
    one = 2 ** 80
    sums = (f"{{'h': sum(CAST(trunc({x}) AS BIGNUM)), "
            f"'f': sum(CAST(({x} - trunc({x})) * {float(one)!r} AS HUGEINT))}}")
    carried = (f"list_transform([{sums}], lambda s: {{'h': s.h + CAST(s.f // {one} AS BIGNUM), "
               f"'f': s.f % {one}::HUGEINT}})")
    small = f"CAST(CAST(CAST(CAST(t.h AS VARCHAR) AS HUGEINT) * {one} + t.f AS VARCHAR) AS DOUBLE) / {float(one)!r}"
    # 20 bits of the rest as 20 decimals, then a 1 if anything stands below
    digits = f"lpad(CAST((t.f // {2 ** 60}) * {5 ** 20} AS VARCHAR), 20, '0')"
    large = (f"CAST(CAST(t.h AS VARCHAR) || '.' || {digits} || "
             f"CASE WHEN t.f % {2 ** 60} > 0 THEN '1' ELSE '0' END AS DOUBLE)")
    return (f"list_transform({carried}, lambda t: CASE WHEN length(CAST(t.h AS VARCHAR)) < 14 "
            f"THEN {small} ELSE {large} END)[1]")


def number(x: str) -> str:
    """Only finite numbers count."""
    v = f"TRY_CAST({x} AS DOUBLE)"
    return f"CASE WHEN isfinite({v}) THEN {v} END"


def avg_money(x: str) -> str:
    return f"({money(x)} / count({x}))"


def pct(part: str, whole: str) -> str:
    return r2(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF({whole}, 0)")


def parse(x: str) -> str:
    return (f"CAST(try_strptime(CAST({x} AS VARCHAR), "
            f"['%Y-%m-%d', '%d-%m-%Y', '%m/%d/%Y', '%Y/%m/%d']) AS DATE)")


def iso(ts: str) -> str:
    return f"CAST(CAST({ts} AS DATE) + {SHIFT} AS VARCHAR)"


def mixed(iso_text: str, sel: str) -> str:
    y, m, d = (f"substr({iso_text}, 1, 4)", f"substr({iso_text}, 6, 2)",
               f"substr({iso_text}, 9, 2)")
    return (f"CASE {sel} % 4 WHEN 0 THEN {iso_text} "
            f"WHEN 1 THEN {d} || '-' || {m} || '-' || {y} "
            f"WHEN 2 THEN {m} || '/' || {d} || '/' || {y} "
            f"ELSE {y} || '/' || {m} || '/' || {d} END")


def other_shape(source: str, date: str, key: str, every: int) -> str:
    """Rows sent again with an ISO date written day first."""
    return (f"SELECT * REPLACE (substr({date}, 9, 2) || '-' || substr({date}, 6, 2) || '-' || "
            f"substr({date}, 1, 4) AS {date}) FROM {source} "
            f"WHERE regexp_matches({date}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND {key} % {every} < 4")


def rank_one(source: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1")


def asc(*cols: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


PRIORITY_ACCOUNT = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Savings' WHEN '2-HIGH' THEN 'Current' "
                    "WHEN '3-MEDIUM' THEN 'Salary' WHEN '4-NOT SPECIFIED' THEN 'NRI' "
                    "WHEN '5-LOW' THEN 'Fixed Deposit' END")
PRIORITY_LOAN = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Home Loan' WHEN '2-HIGH' THEN 'Personal Loan' "
                 "WHEN '3-MEDIUM' THEN 'Auto Loan' WHEN '4-NOT SPECIFIED' THEN 'Education Loan' "
                 "WHEN '5-LOW' THEN 'Business Loan' END")
PART_TYPE = ("CASE p_type WHEN 'STANDARD' THEN 'Deposit' WHEN 'ECONOMY' THEN 'Withdrawal' "
             "WHEN 'MEDIUM' THEN 'Transfer' WHEN 'PROMO' THEN 'Bill Payment' "
             "WHEN 'SMALL' THEN 'POS Purchase' WHEN 'LARGE' THEN 'Wire Transfer' END")
LOAN_STATUS = ("CASE WHEN o_orderkey % 500 < 275 THEN 'Active' WHEN o_orderkey % 500 < 400 THEN 'Closed' "
               "WHEN o_orderkey % 500 < 440 THEN 'Defaulted' ELSE 'Overdue' END")

CHAIN = f"""
raw_customers_base AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
         CAST(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS VARCHAR) AS dob,
         CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' END AS gender,
         ' User' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' AS email,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
         ' ' || lower(c_mktsegment) || ' ' AS city,
         'Nation ' || CAST(c_nationkey AS VARCHAR) AS country,
         CASE WHEN c_custkey % 101 = 3 THEN NULL ELSE c_acctbal * 150 END AS customer_income,
         CASE WHEN c_custkey % 100 = 7 THEN NULL
              ELSE CAST(300 + (c_custkey * 37) % 601 AS INTEGER) END AS credit_score,
         {mixed("CAST(DATE '2015-01-01' + CAST((c_custkey * 13) % 4000 AS INTEGER) AS VARCHAR)",
                "c_custkey")} AS customer_since
  FROM customer),
raw_customers AS (
  SELECT * FROM raw_customers_base
  UNION ALL SELECT * REPLACE (upper(trim(email)) AS email, trim(upper(city)) AS city)
            FROM raw_customers_base WHERE customer_id % 97 = 11
  UNION ALL SELECT * FROM raw_customers_base WHERE customer_id % 199 = 0
  UNION ALL SELECT * REPLACE (' relocated ' AS city, customer_income + 1000 AS customer_income)
            FROM raw_customers_base WHERE customer_id % 211 = 5),
raw_branches AS (
  SELECT CAST(n_nationkey AS BIGINT) AS branch_id, n_name AS branch_name, r_name AS city,
         r_name AS country
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
raw_accounts_base AS (
  SELECT o_orderkey AS account_id, o_custkey AS customer_id,
         CASE WHEN o_orderkey % 307 = 5 THEN NULL ELSE {PRIORITY_ACCOUNT} END AS account_type,
         CAST(c_nationkey AS BIGINT) AS branch_id,
         {mixed(iso("o_orderdate"), "o_orderkey")} AS account_opened_date,
         CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active'
              WHEN 'P' THEN 'Dormant' END AS account_status
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
raw_accounts AS (
  SELECT * FROM raw_accounts_base
  UNION ALL {other_shape("raw_accounts_base", "account_opened_date", "account_id", 131)}),
raw_txn_base AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
         CASE WHEN l_partkey % 211 = 0 THEN NULL WHEN l_partkey % 223 = 1 THEN -l_orderkey - 1
              ELSE l_orderkey END AS account_id,
         CASE WHEN l_partkey % 50 = 1 THEN 'not_a_date' WHEN l_partkey % 50 = 2 THEN '2025-02-30'
              WHEN l_partkey % 50 = 3 THEN ''
              ELSE {mixed(iso("l_shipdate"), "l_partkey")} END AS transaction_date,
         CASE WHEN l_partkey % 97 = 0 THEN -l_extendedprice WHEN l_partkey % 89 = 0 THEN NULL
              WHEN l_partkey % 83 = 5 THEN 'NaN'::DOUBLE WHEN l_partkey % 83 = 6 THEN 'Infinity'::DOUBLE
              WHEN l_partkey % 83 = 7 THEN 4e-7
              WHEN l_partkey % 83 = 8 AND p_type = 'PROMO' AND {iso("l_shipdate")} LIKE '2021%' THEN 1e300
              WHEN l_partkey % 83 = 9 AND p_type = 'SMALL' AND {iso("l_shipdate")} LIKE '2022%' THEN 1e22
              ELSE l_extendedprice END AS transaction_amount,
         CASE WHEN l_suppkey = 13 THEN NULL ELSE {PART_TYPE} END AS transaction_type,
         CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'Failed' WHEN 'NF' THEN 'Pending'
              WHEN 'AF' THEN 'Reversed' ELSE 'Success' END AS payment_status,
         CASE l_suppkey % 5 WHEN 0 THEN 'Mobile App' WHEN 1 THEN 'Internet Banking'
              WHEN 2 THEN 'Branch' WHEN 3 THEN 'ATM' WHEN 4 THEN 'POS' END AS channel,
         l_orderkey AS _order
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
raw_transactions AS (
  SELECT * EXCLUDE (_order) FROM raw_txn_base
  UNION ALL SELECT * EXCLUDE (_order) FROM raw_txn_base WHERE _order % 151 = 0),
raw_loans_base AS (
  SELECT o_orderkey AS loan_id, o_custkey AS customer_id, {PRIORITY_LOAN} AS loan_type,
         CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE o_totalprice END AS loan_amount,
         CAST(6.5 AS DOUBLE) + CAST(o_orderkey % 1001 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS interest_rate,
         CAST(12 * (1 + o_orderkey % 20) AS INTEGER) AS tenure_months,
         {mixed(iso("o_orderdate"), "o_orderkey")} AS loan_start_date,
         {LOAN_STATUS} AS loan_status,
         CASE WHEN {LOAN_STATUS} = 'Closed' THEN 'Success'
              ELSE CASE o_orderkey % 4 WHEN 0 THEN 'Success' WHEN 1 THEN 'Failed'
                   WHEN 2 THEN 'Pending' WHEN 3 THEN 'Reversed' END END AS emi_payment_status
  FROM orders),
raw_loans AS (
  SELECT * FROM raw_loans_base
  UNION ALL {other_shape("raw_loans_base", "loan_start_date", "loan_id", 173)}),
-- customers
cust_std AS (
  SELECT customer_id, first_name, last_name, TRY_CAST(dob AS DATE) AS dob, gender,
         lower(trim(email)) AS email, phone,
         upper(substr(trim(city), 1, 1)) || lower(substr(trim(city), 2)) AS city, country,
         {number("customer_income")} AS customer_income,
         TRY_CAST(trunc({number("credit_score")}) AS INTEGER) AS credit_score,
         {parse("customer_since")} AS customer_since
  FROM (SELECT DISTINCT * FROM raw_customers)),
inc_sorted AS (
  SELECT customer_income AS v, row_number() OVER (ORDER BY customer_income) - 1 AS r,
         count(*) OVER () AS n
  FROM cust_std WHERE customer_income IS NOT NULL),
inc_median AS (
  SELECT (max(CASE WHEN r = (n - 1) // 2 THEN v END) + max(CASE WHEN r = n // 2 THEN v END)) / 2
         AS m FROM inc_sorted),
cs_sorted AS (
  SELECT CAST(credit_score AS DOUBLE) AS v, row_number() OVER (ORDER BY credit_score) - 1 AS r,
         count(*) OVER () AS n
  FROM cust_std WHERE credit_score IS NOT NULL),
cs_median AS (
  SELECT COALESCE(CAST(trunc((max(CASE WHEN r = (n - 1) // 2 THEN v END)
                              + max(CASE WHEN r = n // 2 THEN v END)) / 2) AS INTEGER), 650) AS m
  FROM cs_sorted),
cust_imputed AS (
  SELECT * REPLACE (COALESCE(customer_income, (SELECT m FROM inc_median)) AS customer_income,
                    COALESCE(credit_score, (SELECT m FROM cs_median)) AS credit_score)
  FROM cust_std),
clean_customers AS (
  {rank_one("(SELECT * FROM cust_imputed WHERE customer_id IS NOT NULL)", "customer_id",
            asc("first_name", "last_name", "dob", "gender", "email", "phone", "city", "country",
                "customer_income", "credit_score", "customer_since"))}),
clean_branches AS (
  {rank_one("(SELECT DISTINCT * FROM raw_branches)", "branch_id",
            asc("branch_name", "city", "country"))}),
-- accounts
acc_std AS (
  SELECT * REPLACE ({parse("account_opened_date")} AS account_opened_date)
  FROM (SELECT DISTINCT * FROM raw_accounts)),
clean_accounts AS (
  {rank_one(f"(SELECT * FROM acc_std WHERE account_id IS NOT NULL AND customer_id IS NOT NULL "
            f"AND COALESCE(account_type IN {ACCOUNT_TYPES}, false))", "account_id",
            asc("customer_id", "account_type", "branch_id", "account_opened_date",
                "account_status"))}),
-- transactions
txn_std AS (
  SELECT DISTINCT transaction_id, account_id, {parse("transaction_date")} AS transaction_date,
         {number("transaction_amount")} AS transaction_amount,
         trim(transaction_type) AS transaction_type, payment_status, trim(channel) AS channel
  FROM raw_transactions),
txn_tagged AS (
  SELECT *, CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id'
                 WHEN account_id IS NULL THEN 'missing_account_id'
                 WHEN transaction_amount IS NULL THEN 'missing_amount'
                 WHEN NOT COALESCE(transaction_amount > 0, false) THEN 'non_positive_amount'
                 WHEN transaction_date IS NULL THEN 'invalid_date'
                 WHEN NOT COALESCE(transaction_type IN {TXN_TYPES}, false)
                   THEN 'invalid_transaction_type' END AS reject_reason
  FROM txn_std),
txn_ranked AS (
  SELECT * EXCLUDE (reject_reason), row_number() OVER (PARTITION BY transaction_id ORDER BY
           transaction_amount DESC NULLS LAST,
           {asc("account_id", "transaction_date", "transaction_type", "payment_status", "channel")}
         ) AS rn
  FROM txn_tagged WHERE reject_reason IS NULL),
txn_best AS (SELECT * EXCLUDE (rn) FROM txn_ranked WHERE rn = 1),
clean_txns AS (
  SELECT t.* FROM txn_best t WHERE EXISTS (
    SELECT 1 FROM clean_accounts a WHERE a.account_id = t.account_id)),
orphan_txns AS (
  SELECT t.*, 'orphan_account' AS reject_reason FROM txn_best t WHERE NOT EXISTS (
    SELECT 1 FROM clean_accounts a WHERE a.account_id = t.account_id)),
rejected_txns AS (
  SELECT * FROM txn_tagged WHERE reject_reason IS NOT NULL
  UNION ALL SELECT * EXCLUDE (rn), 'duplicate_id_conflict' AS reject_reason
            FROM txn_ranked WHERE rn > 1
  UNION ALL SELECT * FROM orphan_txns),
-- loans
loan_std AS (
  SELECT loan_id, customer_id, loan_type, {number("loan_amount")} AS loan_amount,
         {number("interest_rate")} AS interest_rate,
         TRY_CAST(trunc({number("tenure_months")}) AS INTEGER) AS tenure_months,
         {parse("loan_start_date")} AS loan_start_date, loan_status, emi_payment_status
  FROM (SELECT DISTINCT * FROM raw_loans)),
clean_loans AS (
  {rank_one("(SELECT * FROM loan_std WHERE loan_id IS NOT NULL AND customer_id IS NOT NULL "
            "AND COALESCE(loan_amount > 0, false))", "loan_id",
            asc("customer_id", "loan_type", "loan_amount", "interest_rate", "tenure_months",
                "loan_start_date", "loan_status", "emi_payment_status"))}),
-- enriched fact
acct_dim AS (
  SELECT a.account_id, a.customer_id, a.account_type, a.branch_id, a.account_status,
         c.customer_income, c.credit_score, c.city, c.customer_since,
         b.branch_name, b.city AS branch_city
  FROM clean_accounts a LEFT JOIN clean_customers c ON a.customer_id = c.customer_id
       LEFT JOIN clean_branches b ON a.branch_id = b.branch_id),
enriched AS (
  SELECT d.branch_id, d.customer_id, t.account_id, t.transaction_id, t.transaction_date,
         t.transaction_amount, t.transaction_type, t.payment_status, t.channel, d.account_type,
         d.account_status, d.customer_income, d.credit_score, d.city, d.customer_since,
         d.branch_name, d.branch_city,
         CAST(year(t.transaction_date) AS INTEGER) AS txn_year,
         CAST(month(t.transaction_date) AS INTEGER) AS txn_month,
         strftime(t.transaction_date, '%Y-%m') AS txn_year_month,
         CAST(t.transaction_amount > 100000 AS INTEGER) AS is_high_value,
         CAST(t.payment_status = 'Failed' AS INTEGER) AS is_failed,
         CASE WHEN d.customer_income < 300000 THEN 'Low'
              WHEN d.customer_income < 1000000 THEN 'Medium' ELSE 'High' END AS income_bracket
  FROM clean_txns t LEFT JOIN acct_dim d ON t.account_id = d.account_id),
fact_transaction AS (
  SELECT transaction_id, account_id, customer_id, branch_id, transaction_date,
         transaction_amount, transaction_type, payment_status, channel, account_type,
         income_bracket, is_high_value, is_failed, txn_year, txn_month, txn_year_month
  FROM enriched),
-- risk mart
txn_by_customer AS (
  SELECT a.customer_id, count(t.transaction_id) AS total_transactions,
         {money("t.transaction_amount")} AS value, count(t.transaction_amount) AS n_amount,
         CAST(sum(CAST(t.payment_status = 'Failed' AS INTEGER)) AS BIGINT) AS failed_transactions,
         CAST(sum(CAST(t.transaction_amount > 100000 AS INTEGER)) AS BIGINT)
           AS high_value_transactions
  FROM clean_txns t JOIN clean_accounts a ON t.account_id = a.account_id
  WHERE a.customer_id IS NOT NULL GROUP BY a.customer_id),
loans_by_customer AS (
  SELECT customer_id, count(loan_id) AS total_loans, {money("loan_amount")} AS total_loan_amount,
         count_if(loan_status = 'Defaulted') AS defaulted_loans,
         count_if(loan_status = 'Overdue') AS overdue_loans
  FROM clean_loans WHERE customer_id IS NOT NULL GROUP BY customer_id),
risk_base AS (
  SELECT c.customer_id, c.customer_income, c.credit_score,
         COALESCE(t.total_transactions, 0) AS total_transactions,
         COALESCE(t.value, 0.0) AS total_transaction_value,
         COALESCE(t.value / t.n_amount, 0.0) AS avg_transaction_value,
         COALESCE(t.failed_transactions, 0) AS failed_transactions,
         COALESCE(t.high_value_transactions, 0) AS high_value_transactions,
         COALESCE(l.total_loans, 0) AS total_loans,
         COALESCE(l.total_loan_amount, 0.0) AS total_loan_amount,
         COALESCE(l.defaulted_loans, 0) AS defaulted_loans,
         COALESCE(l.overdue_loans, 0) AS overdue_loans
  FROM clean_customers c LEFT JOIN txn_by_customer t ON c.customer_id = t.customer_id
       LEFT JOIN loans_by_customer l ON c.customer_id = l.customer_id),
risk_rate AS (
  SELECT *, CASE WHEN total_transactions > 0
                 THEN CAST(failed_transactions AS DOUBLE) / total_transactions
                 ELSE 0.0 END AS failed_txn_rate
  FROM risk_base),
risk_scored AS (
  SELECT *, {r2("least(CAST(100.0 AS DOUBLE), (900 - credit_score) / 600 * 28 "
                "+ failed_txn_rate * 12 + defaulted_loans * 32 + overdue_loans * 16)")}
         AS risk_score
  FROM risk_rate),
customer_risk_metrics AS (
  SELECT customer_id, customer_income, credit_score, total_transactions,
         total_transaction_value, avg_transaction_value, failed_transactions,
         high_value_transactions, total_loans, total_loan_amount, defaulted_loans,
         overdue_loans, failed_txn_rate, risk_score,
         CASE WHEN risk_score >= 60 THEN 'High' WHEN risk_score >= 30 THEN 'Medium'
              ELSE 'Low' END AS risk_tier
  FROM risk_scored),
-- entity rejects: failed checks first, then ranking losers
cust_rejected AS (
  SELECT *, 'missing_customer_id' AS reject_reason FROM cust_imputed WHERE customer_id IS NULL
  UNION ALL
  SELECT * EXCLUDE (rn), 'duplicate_customer_id' AS reject_reason FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY
      {asc("first_name", "last_name", "dob", "gender", "email", "phone", "city", "country",
           "customer_income", "credit_score", "customer_since")}) AS rn
    FROM cust_imputed WHERE customer_id IS NOT NULL) WHERE rn > 1),
acc_rejected AS (
  SELECT * FROM (
    SELECT *, CASE WHEN account_id IS NULL THEN 'missing_account_id'
                   WHEN customer_id IS NULL THEN 'missing_customer_id'
                   WHEN NOT COALESCE(account_type IN {ACCOUNT_TYPES}, false)
                     THEN 'invalid_account_type' END AS reject_reason
    FROM acc_std) WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT * EXCLUDE (rn), 'duplicate_account_id' AS reject_reason FROM (
    SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY
      {asc("customer_id", "account_type", "branch_id", "account_opened_date", "account_status")}
    ) AS rn
    FROM acc_std WHERE account_id IS NOT NULL AND customer_id IS NOT NULL
                   AND COALESCE(account_type IN {ACCOUNT_TYPES}, false)) WHERE rn > 1),
loan_rejected AS (
  SELECT * FROM (
    SELECT *, CASE WHEN loan_id IS NULL THEN 'missing_loan_id'
                   WHEN customer_id IS NULL THEN 'missing_customer_id'
                   WHEN loan_amount IS NULL THEN 'missing_amount'
                   WHEN NOT COALESCE(loan_amount > 0, false) THEN 'non_positive_amount'
              END AS reject_reason
    FROM loan_std) WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT * EXCLUDE (rn), 'duplicate_loan_id' AS reject_reason FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY
      {asc("customer_id", "loan_type", "loan_amount", "interest_rate", "tenure_months",
           "loan_start_date", "loan_status", "emi_payment_status")}) AS rn
    FROM loan_std WHERE loan_id IS NOT NULL AND customer_id IS NOT NULL
                    AND COALESCE(loan_amount > 0, false)) WHERE rn > 1),
-- calendar
dim_date AS (
  SELECT CAST(d AS DATE) AS date_key, CAST(day(d) AS INTEGER) AS day,
         CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         strftime(d, '%Y-%m') AS year_month, strftime(d, '%A') AS day_of_week,
         CAST(isodow(d) IN (6, 7) AS INTEGER) AS is_weekend
  FROM range(TIMESTAMP '2015-01-01', TIMESTAMP '2028-01-01', INTERVAL 1 DAY) AS t(d)),
-- data quality
master_accounts AS (
  SELECT DISTINCT account_id FROM raw_accounts WHERE account_id IS NOT NULL),
txn_flagged AS (
  SELECT t.*, m.account_id IS NOT NULL AS in_master
  FROM raw_transactions t LEFT JOIN master_accounts m ON t.account_id = m.account_id),
dq_txn AS (
  SELECT count(*) AS total,
         count_if(transaction_id IS NULL) AS missing_txn_id,
         count_if(account_id IS NULL) AS missing_account_id,
         count_if(transaction_amount IS NULL) AS missing_amount,
         count_if(transaction_type IS NULL) AS missing_type,
         count_if(NOT COALESCE(({number("transaction_amount")}) > 0, false)) AS invalid_amount,
         count_if({parse("transaction_date")} IS NULL) AS invalid_date,
         count_if(NOT COALESCE(transaction_type IN {TXN_TYPES}, false)) AS invalid_txn_type,
         count_if(NOT in_master) AS orphan_txn_account,
         count(DISTINCT CASE WHEN transaction_id IS NOT NULL AND account_id IS NOT NULL
                  AND COALESCE(({number("transaction_amount")}) > 0, false)
                  AND {parse("transaction_date")} IS NOT NULL
                  AND COALESCE(transaction_type IN {TXN_TYPES}, false) AND in_master
                  THEN transaction_id END) AS valid_ids
  FROM txn_flagged),
master_customers AS (
  SELECT DISTINCT customer_id FROM raw_customers WHERE customer_id IS NOT NULL),
dq_acc AS (
  SELECT count(*) AS total,
         count_if(NOT COALESCE(a.account_type IN {ACCOUNT_TYPES}, false)) AS invalid_account_type,
         count_if(m.customer_id IS NULL) AS orphan_account_customer
  FROM raw_accounts a LEFT JOIN master_customers m ON a.customer_id = m.customer_id),
dq_dup_txn AS (
  SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS total,
         CAST(COALESCE(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS failed
  FROM (SELECT transaction_id, count(*) AS n FROM raw_transactions GROUP BY transaction_id)),
dq_dup_cust AS (
  SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS total,
         CAST(COALESCE(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS failed
  FROM (SELECT customer_id, count(*) AS n FROM raw_customers GROUP BY customer_id)),
dq_scorecard AS (
  SELECT CAST(total AS BIGINT) AS total_records, CAST(valid_ids AS BIGINT) AS valid_records,
         CAST(total - valid_ids AS BIGINT) AS rejected_records,
         CASE WHEN total > 0 THEN {r2("CAST(valid_ids AS DOUBLE) / total * 100")}
              ELSE 0.0 END AS data_quality_score_pct,
         CAST(90.0 AS DOUBLE) AS quality_gate_threshold_pct
  FROM dq_txn),
monthly_flagged AS (
  SELECT strftime({parse("transaction_date")}, '%Y-%m') AS month, transaction_id,
         transaction_id IS NOT NULL AND account_id IS NOT NULL
           AND COALESCE(({number("transaction_amount")}) > 0, false)
           AND COALESCE(transaction_type IN {TXN_TYPES}, false) AND in_master AS valid
  FROM txn_flagged WHERE {parse("transaction_date")} IS NOT NULL),
monthly_counts AS (
  SELECT month, count(*) AS total, count(DISTINCT CASE WHEN valid THEN transaction_id END) AS good
  FROM monthly_flagged GROUP BY month),
monthly_log AS (
  SELECT month || '-01T00:00:00' AS run_at, CAST(total AS BIGINT) AS total_records,
         CAST(good AS BIGINT) AS valid_records, CAST(total - good AS BIGINT) AS rejected_records,
         {r2("CAST(good AS DOUBLE) / total * 100")} AS data_quality_score_pct,
         CAST({r2("CAST(good AS DOUBLE) / total * 100")} >= 90.0 AS INTEGER) AS passed_quality_gate
  FROM monthly_counts),
data_quality_log AS (
  SELECT CAST(1 AS BIGINT) AS run_id, '{RUN_AT}' AS run_at, total_records, valid_records,
         rejected_records, data_quality_score_pct,
         CAST(data_quality_score_pct >= 90.0 AS INTEGER) AS passed_quality_gate
  FROM dq_scorecard)
"""


def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if is HUGEINT, and NULL over no rows; make each call a BIGINT
    that is 0 there, like Spark's count_if."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            return "".join(out) + sql[i:]
        depth, k = 0, j + len("count_if")
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "CAST(COALESCE(" + sql[j:k] + ", 0) AS BIGINT)")
        i = k


def _q(select: str) -> str:
    return _bigint_count_if(f"WITH {CHAIN}\n{select}")


def _check(category: str, name: str, total: str, failed: str, src: str) -> str:
    rate = (f"CASE WHEN {total} = 0 THEN 100.0 ELSE "
            f"{r2(f'CAST({total} - {failed} AS DOUBLE) / {total} * 100')} END")
    return (f"SELECT '{category}' AS category, '{name}' AS check_name, "
            f"CAST({total} AS BIGINT) AS total_records, CAST({failed} AS BIGINT) AS failed_records, "
            f"{rate} AS pass_rate_pct FROM {src}")


DQ_CHECKS = " UNION ALL ".join([
    _check("Completeness", "Missing Transaction ID", "total", "missing_txn_id", "dq_txn"),
    _check("Completeness", "Missing Account ID (proxy for Customer linkage)", "total",
           "missing_account_id", "dq_txn"),
    _check("Completeness", "Missing Transaction Amount", "total", "missing_amount", "dq_txn"),
    _check("Completeness", "Missing Transaction Type", "total", "missing_type", "dq_txn"),
    _check("Validity", "Negative/Invalid/Zero Transaction Amount", "total", "invalid_amount",
           "dq_txn"),
    _check("Validity", "Invalid Transaction Date", "total", "invalid_date", "dq_txn"),
    _check("Validity", "Invalid Transaction Type", "total", "invalid_txn_type", "dq_txn"),
    _check("Validity", "Invalid Account Type", "total", "invalid_account_type", "dq_acc"),
    _check("Uniqueness", "Duplicate Transaction IDs", "total", "failed", "dq_dup_txn"),
    _check("Uniqueness", "Duplicate Customer IDs", "total", "failed", "dq_dup_cust"),
    _check("Consistency", "Transaction Account ID not found in Account master", "total",
           "orphan_txn_account", "dq_txn"),
    _check("Consistency", "Account Customer ID not found in Customer master", "total",
           "orphan_account_customer", "dq_acc"),
])

CONSTRAINTS = [
    ("dim_date", "PK", "date_key", None, None),
    ("dim_branch", "PK", "branch_id", None, None),
    ("dim_branch", "NOT NULL", "branch_name", None, None),
    ("dim_customer", "PK", "customer_id", None, None),
    ("dim_account", "PK", "account_id", None, None),
    ("dim_account", "NOT NULL", "customer_id", None, None),
    ("dim_account", "FK", "customer_id", "dim_customer", "customer_id"),
    ("dim_account", "FK", "branch_id", "dim_branch", "branch_id"),
    ("fact_transaction", "PK", "transaction_id", None, None),
    ("fact_transaction", "NOT NULL", "account_id", None, None),
    ("fact_transaction", "NOT NULL", "transaction_date", None, None),
    ("fact_transaction", "NOT NULL", "transaction_amount", None, None),
    ("fact_transaction", "FK", "account_id", "dim_account", "account_id"),
    ("fact_transaction", "FK", "customer_id", "dim_customer", "customer_id"),
    ("fact_transaction", "FK", "branch_id", "dim_branch", "branch_id"),
    ("fact_transaction", "FK", "transaction_date", "dim_date", "date_key"),
    ("fact_loan", "PK", "loan_id", None, None),
    ("fact_loan", "NOT NULL", "customer_id", None, None),
    ("fact_loan", "FK", "customer_id", "dim_customer", "customer_id"),
    ("fact_loan", "FK", "loan_start_date", "dim_date", "date_key"),
    ("customer_risk_metrics", "PK", "customer_id", None, None),
    ("customer_risk_metrics", "FK", "customer_id", "dim_customer", "customer_id"),
    ("data_quality_log", "PK", "run_id", None, None),
    ("data_quality_log", "NOT NULL", "run_at", None, None),
]
WAREHOUSE_SOURCES = {
    "dim_date": "dim_date", "dim_branch": "clean_branches", "dim_customer": "clean_customers",
    "dim_account": "clean_accounts", "fact_transaction": "fact_transaction",
    "fact_loan": "clean_loans", "customer_risk_metrics": "customer_risk_metrics",
    "data_quality_log": "data_quality_log",
}


def _constraint(table, kind, col, parent, parent_col) -> str:
    src = WAREHOUSE_SOURCES[table]
    if kind == "PK":
        v = (f"(SELECT CAST(COALESCE(sum(CASE WHEN k IS NULL OR n > 1 THEN n END), 0) AS BIGINT) "
             f"FROM (SELECT {col} AS k, count(*) AS n FROM {src} GROUP BY {col}))")
    elif kind == "NOT NULL":
        v = f"(SELECT CAST(count_if({col} IS NULL) AS BIGINT) FROM {src})"
    else:
        psrc = WAREHOUSE_SOURCES[parent]
        v = (f"(SELECT CAST(count(*) AS BIGINT) FROM {src} s WHERE s.{col} IS NOT NULL AND "
             f"NOT EXISTS (SELECT 1 FROM {psrc} p WHERE p.{parent_col} = s.{col}))")
    return (f"SELECT '{table}' AS table_name, '{kind}' AS constraint_kind, "
            f"'{col}' AS column_name, {v} AS violations")


CONSTRAINT_SQL = " UNION ALL ".join(_constraint(*c) for c in CONSTRAINTS)


def _measure(label: str, expr: str) -> str:
    return f"SELECT '{label}' AS measure, CAST({expr} AS DOUBLE) AS value"


BI_MEASURES = " UNION ALL ".join([
    _measure("Total Transactions", "(SELECT count(*) FROM fact_transaction)"),
    _measure("Total Transaction Value",
             f"(SELECT {money('transaction_amount')} FROM fact_transaction)"),
    _measure("Avg Transaction Value",
             f"(SELECT {avg_money('transaction_amount')} FROM fact_transaction)"),
    _measure("Active Customers", "(SELECT count(DISTINCT customer_id) FROM fact_transaction)"),
    _measure("Failed Transactions",
             "(SELECT count_if(payment_status = 'Failed') FROM fact_transaction)"),
    _measure("Failed Transaction Rate %",
             "(SELECT COALESCE(CAST(count_if(payment_status = 'Failed') AS DOUBLE) "
             "/ NULLIF(count(*), 0), 0.0) * 100 FROM fact_transaction)"),
    _measure("High Value Transactions",
             "(SELECT count_if(is_high_value = 1) FROM fact_transaction)"),
    _measure("High Risk Customers", "(SELECT count(DISTINCT CASE WHEN risk_tier = 'High' "
                                    "THEN customer_id END) FROM customer_risk_metrics)"),
    _measure("Medium Risk Customers", "(SELECT count(DISTINCT CASE WHEN risk_tier = 'Medium' "
                                      "THEN customer_id END) FROM customer_risk_metrics)"),
    _measure("Low Risk Customers", "(SELECT count(DISTINCT CASE WHEN risk_tier = 'Low' "
                                   "THEN customer_id END) FROM customer_risk_metrics)"),
    _measure("Avg Risk Score", f"(SELECT {avg_money('risk_score')} FROM customer_risk_metrics)"),
    _measure("Total Loans", "(SELECT count(*) FROM clean_loans)"),
    _measure("Defaulted Loans", "(SELECT count_if(loan_status = 'Defaulted') FROM clean_loans)"),
    _measure("Loan Default Rate %",
             "(SELECT COALESCE(CAST(count_if(loan_status = 'Defaulted') AS DOUBLE) "
             "/ NULLIF(count(*), 0), 0.0) * 100 FROM clean_loans)"),
    _measure("Total Loan Book", f"(SELECT {money('loan_amount')} FROM clean_loans)"),
])

BI_MEASURES_SLICED = BI_MEASURES.replace("FROM fact_transaction)", (
    "FROM fact_transaction JOIN clean_branches USING (branch_id) WHERE txn_year = 2022 "
    "AND branch_name = 'FRANCE' AND channel = 'ATM')"))

SOURCE_COLUMNS = {
    "customers": "customer_id, first_name, last_name, dob, gender, email, phone, city, country, "
                 "customer_income, credit_score, customer_since",
    "branches": "branch_id, branch_name, city, country",
    "accounts": "account_id, customer_id, account_type, branch_id, account_opened_date, account_status",
    "transactions": "transaction_id, account_id, transaction_date, transaction_amount, transaction_type, "
                    "payment_status, channel",
    "loans": "loan_id, customer_id, loan_type, loan_amount, interest_rate, tenure_months, "
             "loan_start_date, loan_status, emi_payment_status",
}


def _landed(source: str) -> str:
    """What a good drop leaves: empty texts and NaN are missing values. Customers have a note
    beside their columns; the branches in force are those of the second drop."""
    cells = " + ".join([f"count(CASE WHEN CAST({c} AS VARCHAR) NOT IN ('', 'nan') THEN 1 END)"
                        for c in SOURCE_COLUMNS[source].split(", ")]
                       + ["count_if(customer_id % 5 = 0)"] * (source == "customers"))
    first = SOURCE_COLUMNS[source].split(", ")[0]
    rows = f"raw_{source}" + " WHERE branch_id % 2 = 0" * (source == "branches")
    return (f"SELECT 'good' AS drop_kind, '{source}' AS source_name, 'SUCCESS' AS status, "
            f"(SELECT count(*) FROM raw_{source}) AS row_count, CAST(0 AS BIGINT) AS malformed_rows, "
            f"'' AS missing_columns, count(*) AS landed_rows, CAST({cells} AS BIGINT) AS cells, "
            f"CAST(sum(length(CAST({first} AS VARCHAR))) AS BIGINT) AS id_characters FROM {rows}")


def _not_landed(kind: str, source: str, status: str, rows: str = "CAST(0 AS BIGINT)",
                malformed: str = "CAST(0 AS BIGINT)", missing: str = "") -> str:
    return (f"SELECT '{kind}', '{source}', '{status}', {rows}, {malformed}, '{missing}', CAST(0 AS BIGINT), "
            f"CAST(0 AS BIGINT), CAST(0 AS BIGINT)")


INGEST_ROUNDTRIP = " UNION ALL ".join([
    *map(_landed, SOURCE_COLUMNS),
    _not_landed("again", "branches", "SUCCESS", "(SELECT count(*) FROM raw_branches WHERE branch_id % 2 = 0)"),
    _not_landed("bad", "loans", "FAILED", missing="loan_amount"), _not_landed("bad", "branches", "FAILED"),
    _not_landed("bad", "accounts", "FAILED"), _not_landed("bad", "transactions", "FAILED"),
    _not_landed("bad", "customers", "FAILED", *["(SELECT count(*) FROM raw_branches)"] * 2)])

WAREHOUSE_CTES = {"dim_date": "dim_date", "dim_branch": "clean_branches", "dim_customer": "clean_customers",
                  "dim_account": "clean_accounts", "fact_transaction": "fact_transaction",
                  "fact_loan": "clean_loans", "customer_risk_metrics": "customer_risk_metrics",
                  "data_quality_log": "data_quality_log"}

RUN_OUTPUTS = " UNION ALL ".join([
    "SELECT 'manifest' AS output, 'branches SUCCESS not ok' AS item, count(*) AS n FROM raw_branches",
    "SELECT 'manifest', 'loans SUCCESS not ok', count(*) FROM raw_loans",
    "SELECT 'manifest', 'accounts FAILED not ok', CAST(0 AS BIGINT)",
    *[f"SELECT '{x}', check_name, failed_records FROM ({DQ_CHECKS})" for x in ("check", "scorecard line")],
    *[f"SELECT 'score', '{c}', {c} FROM dq_scorecard" for c in ("total_records", "valid_records", "rejected_records")],
    *[f"SELECT '{x}', '{name}', count(*) FROM {cte}" for name, cte in WAREHOUSE_CTES.items()
      for x in ("extract", "rows written")]])

MONTHLY_VALUE = (f"SELECT d.year_month, {money('f.transaction_amount')} AS total_value "
                 f"FROM fact_transaction f JOIN dim_date d ON f.transaction_date = d.date_key "
                 f"GROUP BY d.year_month")

TXN_COLS = ("transaction_id, account_id, transaction_date, transaction_amount, transaction_type, "
            "payment_status, channel")


# DATE output columns per query: presented as ISO text on both sides.
DATE_COLUMNS = {
    "high_value_detail": ["transaction_date"],
    "clean_customers": ["dob", "customer_since"],
    "clean_accounts": ["account_opened_date"],
    "clean_loans": ["loan_start_date"],
    "clean_transactions": ["transaction_date"],
    "rejected_transactions": ["transaction_date"],
    "rejected_customers": ["dob", "customer_since"],
    "rejected_accounts": ["account_opened_date"],
    "rejected_loans": ["loan_start_date"],
    "orphan_transactions": ["transaction_date"],
    "parsed_dates": ["parsed_date"],
    "enriched_transactions": ["transaction_date", "customer_since"],
    "fact_transaction": ["transaction_date"],
    "daily_aggregation": ["transaction_date"],
    "calendar_daily_series": ["date_key"],
    "fact_profile": ["first_date", "last_date"],
}


# Key columns of the reject audit tables (raw rows, keys may be NULL):
# presented as text, as the source files carry them.
AUDIT_KEY_COLUMNS = {
    "rejected_transactions": ["transaction_id", "account_id"],
    "orphan_transactions": ["transaction_id", "account_id"],
    "rejected_customers": ["customer_id"],
    "rejected_accounts": ["account_id", "customer_id", "branch_id"],
    "rejected_loans": ["loan_id", "customer_id"],
}


def queries() -> dict[str, str]:
    out = {}
    for name, sql in _queries().items():
        cols = DATE_COLUMNS.get(name, []) + AUDIT_KEY_COLUMNS.get(name, [])
        if cols:
            cast = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
            sql = f"SELECT * REPLACE ({cast}) FROM ({sql})"
        out[name] = sql
    return out


def _queries() -> dict[str, str]:
    kpi_text = ("CAST(CAST(round(CAST({} AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS VARCHAR) "
                "|| '%'")
    return {
        # ---- Q1-Q10 --------------------------------------------------------
        "total_txn_value": _q(
            f"SELECT count(*) AS total_transactions, "
            f"{money('transaction_amount')} AS total_transaction_value FROM fact_transaction"),
        "txn_value_by_month": _q(
            f"SELECT txn_year_month, count(*) AS transaction_count, "
            f"{money('transaction_amount')} AS total_value FROM fact_transaction "
            f"GROUP BY txn_year_month ORDER BY txn_year_month"),
        "avg_txn_amount": _q(
            f"SELECT {r2(avg_money('transaction_amount'))} AS avg_transaction_amount "
            f"FROM fact_transaction"),
        "avg_txn_by_type": _q(
            f"SELECT transaction_type, count(*) AS txn_count, "
            f"{r2(avg_money('transaction_amount'))} AS avg_amount FROM fact_transaction "
            f"GROUP BY transaction_type ORDER BY avg_amount DESC"),
        "high_value_detail": _q(
            "SELECT transaction_id, customer_id, branch_id, transaction_date, transaction_amount, "
            "transaction_type, payment_status FROM fact_transaction WHERE is_high_value = 1 "
            "ORDER BY transaction_amount DESC, transaction_id LIMIT 100"),
        "high_value_summary": _q(
            f"SELECT count(*) AS high_value_txn_count, "
            f"{money('transaction_amount')} AS high_value_txn_total "
            f"FROM fact_transaction WHERE is_high_value = 1"),
        "failed_rate": _q(
            f"SELECT count(*) AS total_txns, CAST(sum(is_failed) AS BIGINT) AS failed_txns, "
            f"{pct('sum(is_failed)', 'count(*)')} AS failed_rate_pct FROM fact_transaction"),
        "failed_rate_by_channel": _q(
            f"SELECT channel, count(*) AS total_txns, CAST(sum(is_failed) AS BIGINT) AS failed_txns, "
            f"{pct('sum(is_failed)', 'count(*)')} AS failed_rate_pct FROM fact_transaction "
            f"GROUP BY channel ORDER BY failed_rate_pct DESC"),
        "top_risk_customers": _q(
            "SELECT customer_id, credit_score, risk_score, risk_tier, total_transactions, "
            "failed_transactions, defaulted_loans, overdue_loans FROM customer_risk_metrics "
            "ORDER BY risk_score DESC, customer_id LIMIT 20"),
        "risk_tier_distribution": _q(
            f"SELECT risk_tier, count(*) AS customer_count, "
            f"{r2(avg_money('risk_score'))} AS avg_risk_score, "
            f"{r0('avg(credit_score)')} AS avg_credit_score, "
            f"{money('total_transaction_value')} AS total_txn_value "
            f"FROM customer_risk_metrics GROUP BY risk_tier ORDER BY avg_risk_score DESC"),
        "monthly_trend": _q(
            f"SELECT d.year, d.month, d.month_name, count(f.transaction_id) AS txn_count, "
            f"{money('f.transaction_amount')} AS total_value, "
            f"{pct('sum(f.is_high_value)', 'count(f.transaction_id)')} AS high_value_pct "
            f"FROM fact_transaction f JOIN dim_date d ON f.transaction_date = d.date_key "
            f"GROUP BY d.year, d.month, d.month_name ORDER BY d.year, d.month"),
        "branch_performance_sql": _q(
            f"SELECT b.branch_name, b.city, count(f.transaction_id) AS total_transactions, "
            f"{money('f.transaction_amount')} AS total_value, "
            f"{pct('sum(f.is_failed)', 'count(f.transaction_id)')} AS failure_rate_pct, "
            f"count(DISTINCT f.customer_id) AS active_customers "
            f"FROM fact_transaction f JOIN clean_branches b ON f.branch_id = b.branch_id "
            f"GROUP BY b.branch_id, b.branch_name, b.city ORDER BY total_value DESC"),
        "branch_risk": _q(
            f"SELECT b.branch_name, count(DISTINCT a.customer_id) AS customers_served, "
            f"{r2(avg_money('crm.risk_score'))} AS avg_customer_risk_score, "
            f"count_if(crm.risk_tier = 'High') AS high_risk_customers "
            f"FROM clean_accounts a JOIN clean_branches b ON a.branch_id = b.branch_id "
            f"JOIN customer_risk_metrics crm ON a.customer_id = crm.customer_id "
            f"GROUP BY b.branch_name ORDER BY avg_customer_risk_score DESC"),
        "branch_risk_distinct": _q(
            f"SELECT branch_name, count(*) AS customers_served, "
            f"{r2(avg_money('risk_score'))} AS avg_customer_risk_score, "
            f"count_if(risk_tier = 'High') AS high_risk_customers FROM ("
            f"SELECT DISTINCT b.branch_name, a.customer_id, crm.risk_score, crm.risk_tier "
            f"FROM clean_accounts a JOIN clean_branches b ON a.branch_id = b.branch_id "
            f"JOIN customer_risk_metrics crm ON a.customer_id = crm.customer_id) "
            f"GROUP BY branch_name ORDER BY avg_customer_risk_score DESC"),
        "loan_default_rate": _q(
            f"SELECT count(*) AS total_loans, count_if(loan_status = 'Defaulted') AS defaulted_loans, "
            f"{pct(DEFAULTED, 'count(*)')} AS default_rate_pct FROM clean_loans"),
        "loan_default_by_type": _q(
            f"SELECT loan_type, count(*) AS total_loans, "
            f"count_if(loan_status = 'Defaulted') AS defaulted_loans, "
            f"{pct(DEFAULTED, 'count(*)')} AS default_rate_pct, "
            f"{r2(avg_money('interest_rate'))} AS avg_interest_rate, "
            f"{money('loan_amount')} AS total_loan_book FROM clean_loans "
            f"GROUP BY loan_type ORDER BY default_rate_pct DESC"),
        "loan_default_by_tier": _q(
            f"SELECT crm.risk_tier, count(fl.loan_id) AS total_loans, "
            f"count_if(fl.loan_status = 'Defaulted') AS defaulted_loans, "
            f"{pct(DEFAULTED_FL, 'count(fl.loan_id)')} AS default_rate_pct "
            f"FROM clean_loans fl JOIN customer_risk_metrics crm ON fl.customer_id = crm.customer_id "
            f"GROUP BY crm.risk_tier ORDER BY default_rate_pct DESC"),
        "dq_log_trend": _q(
            "SELECT run_at, total_records, valid_records, rejected_records, "
            "data_quality_score_pct, passed_quality_gate FROM monthly_log "
            "ORDER BY run_at DESC LIMIT 10"),
        "credit_band_distribution": _q(
            "SELECT CASE WHEN credit_score < 500 THEN '< 500' WHEN credit_score < 600 THEN '500-599' "
            "WHEN credit_score < 700 THEN '600-699' WHEN credit_score < 800 THEN '700-799' "
            "ELSE '800+' END AS credit_score_band, count(*) AS customer_count "
            "FROM clean_customers GROUP BY credit_score_band ORDER BY min(credit_score)"),
        # ---- pipeline tables -----------------------------------------------
        "clean_customers": _q("SELECT * FROM clean_customers"),
        "clean_branches": _q("SELECT * FROM clean_branches"),
        "clean_accounts": _q("SELECT * FROM clean_accounts"),
        "clean_loans": _q("SELECT * FROM clean_loans"),
        "clean_transactions": _q("SELECT * FROM clean_txns"),
        "rejected_transactions": _q("SELECT * FROM rejected_txns"),
        "rejected_customers": _q("SELECT * FROM cust_rejected"),
        "rejected_accounts": _q("SELECT * FROM acc_rejected"),
        "rejected_loans": _q("SELECT * FROM loan_rejected"),
        "orphan_transactions": _q("SELECT * FROM orphan_txns"),
        "parsed_dates": _q(
            f"SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS date_text, "
            f"{parse('transaction_date')} AS parsed_date FROM raw_transactions"),
        "enriched_transactions": _q("SELECT * FROM enriched"),
        "fact_transaction": _q("SELECT * FROM fact_transaction"),
        "customer_risk_metrics": _q("SELECT * FROM customer_risk_metrics"),
        "daily_aggregation": _q(
            f"SELECT transaction_date, branch_id, count(transaction_id) AS txn_count, "
            f"{money('transaction_amount')} AS total_amount, "
            f"{avg_money('transaction_amount')} AS avg_amount, "
            f"CAST(sum(is_failed) AS BIGINT) AS failed_count FROM enriched "
            f"GROUP BY transaction_date, branch_id ORDER BY transaction_date, branch_id"),
        "monthly_aggregation": _q(
            f"SELECT txn_year_month, branch_id, account_type, count(transaction_id) AS txn_count, "
            f"{money('transaction_amount')} AS total_amount, "
            f"{avg_money('transaction_amount')} AS avg_amount, "
            f"CAST(sum(is_high_value) AS BIGINT) AS high_value_count, "
            f"CAST(sum(is_failed) AS BIGINT) AS failed_count FROM enriched "
            f"GROUP BY txn_year_month, branch_id, account_type "
            f"ORDER BY txn_year_month, branch_id, account_type"),
        "branch_performance": _q(
            f"SELECT p.*, {r2('CAST(p.failed_transactions AS DOUBLE) / p.total_transactions * 100')}"
            f" AS failure_rate_pct, b.branch_name, b.city, b.country FROM ("
            f"SELECT branch_id, count(transaction_id) AS total_transactions, "
            f"{money('transaction_amount')} AS total_value, "
            f"CAST(sum(is_failed) AS BIGINT) AS failed_transactions, "
            f"count(DISTINCT customer_id) AS active_customers FROM enriched GROUP BY branch_id) p "
            f"LEFT JOIN clean_branches b ON p.branch_id = b.branch_id ORDER BY total_value DESC"),
        "dq_checks": _q(DQ_CHECKS),
        "dq_scorecard": _q(
            "SELECT *, data_quality_score_pct >= quality_gate_threshold_pct AS passed_quality_gate "
            "FROM dq_scorecard"),
        "constraint_violations": _q(CONSTRAINT_SQL),
        # ---- BI measures and visuals --------------------------------------
        "bi_measures": _q(BI_MEASURES),
        "data_quality_kpi": _q(
            f"SELECT {kpi_text.format('max(data_quality_score_pct)')} AS data_quality_score_max, "
            f"{kpi_text.format('arg_max(data_quality_score_pct, run_at)')} "
            f"AS data_quality_score_latest FROM monthly_log"),
        "bi_measures_sliced": _q(BI_MEASURES_SLICED),
        "fact_profile": _q(
            "SELECT count(*) AS n_rows, min(transaction_amount) AS min_amount, "
            "max(transaction_amount) AS max_amount, min(transaction_date) AS first_date, "
            "max(transaction_date) AS last_date, "
            + ", ".join(f"count_if({c} IS NULL) AS null_{c}" for c in
                        ("account_id", "customer_id", "branch_id", "transaction_amount", "is_failed"))
            + ", count(DISTINCT transaction_id) AS distinct_ids FROM fact_transaction"),
        "calendar_daily_series": _q(
            f"SELECT d.*, COALESCE(x.n, 0) AS txn_count, COALESCE(x.v, 0.0) AS total_value FROM dim_date d "
            f"LEFT JOIN (SELECT transaction_date, count(*) AS n, {money('transaction_amount')} AS v "
            f"FROM fact_transaction GROUP BY transaction_date) x ON d.date_key = x.transaction_date "
            f"WHERE d.date_key BETWEEN (SELECT min(transaction_date) FROM fact_transaction) "
            f"AND (SELECT max(transaction_date) FROM fact_transaction) ORDER BY d.date_key"),
        "ingest_roundtrip": _q(INGEST_ROUNDTRIP),
        "run_outputs": _q(RUN_OUTPUTS),
        "quality_log_rerun": _q("SELECT CAST(20260101000000 AS BIGINT) AS run_id, * EXCLUDE (run_id) "
                                "FROM data_quality_log"),
        "txn_value_mom": _q(
            f"SELECT m.year_month, m.total_value, p.total_value AS prior_value, "
            f"{r2('CASE WHEN p.total_value IS NULL OR p.total_value = 0 THEN 0.0 ELSE (m.total_value - p.total_value) / p.total_value * 100 END')}"
            f" AS value_mom_pct FROM ({MONTHLY_VALUE}) m LEFT JOIN ({MONTHLY_VALUE}) p "
            f"ON p.year_month = strftime(CAST(m.year_month || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') "
            f"ORDER BY m.year_month"),
        "txn_by_status": _q(
            "SELECT payment_status, count(*) AS txn_count FROM fact_transaction "
            "GROUP BY payment_status ORDER BY payment_status"),
        "txn_by_month_name": _q(
            "SELECT d.month, d.month_name, count(*) AS txn_count FROM fact_transaction f "
            "JOIN dim_date d ON f.transaction_date = d.date_key GROUP BY d.month, d.month_name "
            "ORDER BY d.month"),
        "txn_value_by_type": _q(
            f"SELECT transaction_type, {money('transaction_amount')} AS total_value "
            f"FROM fact_transaction GROUP BY transaction_type ORDER BY total_value DESC"),
        "txn_value_by_branch": _q(
            f"SELECT b.branch_name, {money('f.transaction_amount')} AS total_value "
            f"FROM fact_transaction f JOIN clean_branches b ON f.branch_id = b.branch_id "
            f"GROUP BY b.branch_name ORDER BY total_value DESC"),
        "high_value_by_branch": _q(
            "SELECT b.branch_name, count_if(f.is_high_value = 1) AS high_value_transactions "
            "FROM fact_transaction f JOIN clean_branches b ON f.branch_id = b.branch_id "
            "GROUP BY b.branch_name ORDER BY high_value_transactions DESC, b.branch_name"),
        "credit_histogram": _q(
            "SELECT CAST(floor(credit_score / 100) * 100 AS INTEGER) AS bin_start, "
            "count(*) AS customer_count FROM clean_customers GROUP BY bin_start ORDER BY bin_start"),
        "risk_scatter": _q(
            "SELECT customer_id, credit_score, risk_score, total_loan_amount, risk_tier "
            "FROM customer_risk_metrics"),
    }


DEFAULTED = "count_if(loan_status = 'Defaulted')"
DEFAULTED_FL = "count_if(fl.loan_status = 'Defaulted')"
