"""DuckDB SQL that must give the same rows as the query of the same name.

Written against the plain tables: the transaction view here is the full seven-way
inner join, whatever the query itself reads.
"""

from __future__ import annotations

VIEWS = """
WITH txn0 AS (
  SELECT 'TXN' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 10, '0') AS transaction_id,
         o_orderdate AS transaction_ts,
         '****-****-****-' || CAST(1000 + c_custkey % 9000 AS VARCHAR) AS card_no,
         l_linestatus AS card_type, s_name AS merchant, p_brand AS sub_category,
         p_type AS category, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         CASE l_linenumber WHEN 5 THEN 3 WHEN 6 THEN 6 WHEN 7 THEN 12 ELSE 0 END
           AS installment_months,
         CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'declined'
                            WHEN 'P' THEN 'cancelled' END AS approval_status,
         r_name AS region, l_orderkey AS k,
         '****-****-****-' || CAST(1000 + l_suppkey % 9000 AS VARCHAR) AS supplier_card
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
),
evt0 AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS transaction_ts,
         CAST(user_id AS VARCHAR) AS card_no,
         CASE WHEN user_id % 2 = 0 THEN '신용' ELSE '체크' END AS card_type,
         event_type AS category, CAST(round(value * 100) AS BIGINT) AS amount,
         CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'approved' END AS approval_status
  FROM events
),
txn AS (
  SELECT *, CAST(year(transaction_ts) AS INTEGER) AS txn_year,
         CAST(month(transaction_ts) AS INTEGER) AS txn_month,
         CAST(quarter(transaction_ts) AS INTEGER) AS txn_quarter,
         strftime(transaction_ts, '%Y-%m-%d') AS txn_date,
         CASE quarter(transaction_ts) WHEN 1 THEN 'Q1(1-3월)' WHEN 2 THEN 'Q2(4-6월)'
              WHEN 3 THEN 'Q3(7-9월)' WHEN 4 THEN 'Q4(10-12월)' END AS quarter_label
  FROM txn0
),
evt AS (
  SELECT *, CAST(year(transaction_ts) AS INTEGER) AS txn_year,
         CAST(month(transaction_ts) AS INTEGER) AS txn_month,
         CAST(quarter(transaction_ts) AS INTEGER) AS txn_quarter,
         strftime(transaction_ts, '%Y-%m-%d') AS txn_date,
         CAST(hour(transaction_ts) AS INTEGER) AS txn_hour,
         CAST(dayofweek(transaction_ts) + 1 AS INTEGER) AS txn_day_of_week
  FROM evt0
),
ok AS (SELECT * FROM txn WHERE approval_status = 'approved'),
evt_ok AS (SELECT * FROM evt WHERE approval_status = 'approved'),
dirty AS (
  SELECT CASE WHEN k % 991 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
         CASE WHEN k % 103 = 0 THEN '1998-13-45 00:00:00'
              WHEN k % 113 = 0 THEN '2099-01-01 00:00:00'
              ELSE strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') END AS transaction_date,
         CASE WHEN k % 107 = 0 THEN '1234-5678-9012-3456' WHEN k % 109 = 0 THEN NULL
              ELSE supplier_card END AS card_no,
         CASE WHEN k % 137 = 0 THEN 'X' ELSE card_type END AS card_type,
         CASE WHEN k % 151 = 0 THEN NULL ELSE merchant END AS merchant,
         CASE WHEN k % 157 = 0 THEN '' ELSE sub_category END AS sub_category,
         CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN '' WHEN k % 83 = 0 THEN 'null'
              WHEN k % 79 = 0 THEN 'UNKNOWN' ELSE category END AS category,
         CASE WHEN k % 101 = 0 THEN '-500' WHEN k % 127 = 0 THEN '0' WHEN k % 131 = 0 THEN 'abc'
              WHEN k % 167 = 0 THEN '3000000000'
              ELSE CAST(amount AS VARCHAR) END AS amount_raw,
         CASE WHEN k % 163 = 0 THEN 'x' ELSE CAST(installment_months AS VARCHAR) END
           AS installment_raw,
         CASE WHEN k % 139 = 0 THEN 'unknown' ELSE approval_status END AS approval_status,
         CASE WHEN k % 149 = 0 THEN 'ATLANTIS' ELSE region END AS region
  FROM txn0
),
typed AS (
  SELECT *, TRY_CAST(amount_raw AS BIGINT) AS amount,
         TRY_CAST(installment_raw AS INTEGER) AS installment_months,
         try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S') AS parsed
  FROM dirty
)
"""

N = "count(transaction_id) AS txn_count"
ROWS = "count(*) AS txn_count"
SUM = "CAST(sum(amount) AS BIGINT) AS total_amount"
MEAN = "round(CAST(sum(amount) AS DOUBLE) / count(amount), 0)"
AVG = f"{MEAN} AS avg_amount"
CARDS = "count(DISTINCT card_no) AS unique_cards"
MERCHANTS = "count(DISTINCT merchant) AS unique_merchants"
STANDARD = f"{N}, {SUM}, {AVG}, {CARDS}"
EXACT_MEAN = "CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount"
SLOT = """CASE WHEN txn_hour BETWEEN 6 AND 11 THEN '오전' WHEN txn_hour BETWEEN 12 AND 17 THEN '오후'
          WHEN txn_hour BETWEEN 18 AND 23 THEN '저녁' WHEN txn_hour IS NOT NULL THEN '심야' END"""


def _growth(current: str, previous: str) -> str:
    return (
        f"round(CAST({current} - {previous} AS DOUBLE) / nullif({previous}, 0) * 100, 2)"
    )


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, {digits})"


DAILY = f"""SELECT txn_date, category, {STANDARD}, max(amount) AS max_amount,
            min(amount) AS min_amount FROM ok GROUP BY txn_date, category"""
REGIONAL = f"SELECT region, category, {STANDARD} FROM ok GROUP BY region, category"
RANKING = f"""SELECT merchant, category, sub_category, {N},
              count(DISTINCT card_no) AS unique_customers,
              CAST(sum(amount) AS BIGINT) AS total_revenue, {MEAN} AS avg_transaction,
              round(CAST(sum(amount) AS DOUBLE) / 10000, 1) AS revenue_rank
              FROM ok GROUP BY merchant, category, sub_category"""
QUARTER_CATEGORY = f"""SELECT txn_quarter, quarter_label, category, {STANDARD} FROM ok
                       WHERE txn_year = 1998 GROUP BY txn_quarter, quarter_label, category"""
MASTER = """master(category, category_group, priority) AS (
  VALUES ('STANDARD', 'core', CAST(1 AS BIGINT)), ('ECONOMY', 'core', 2), ('MEDIUM', 'core', 3),
         ('PROMO', 'campaign', 4))"""
BY_GROUP = f""", {MASTER}
SELECT category_group, priority, {ROWS}, {SUM}
FROM txn LEFT JOIN master USING (category) GROUP BY category_group, priority"""

# check_no, category, name, severity, rows found, detail, detail only when found
_FACT = [
    ("transaction_id", True),
    ("transaction_date", True),
    ("card_no", True),
    ("card_type", True),
    ("merchant", True),
    ("sub_category", True),
    ("category", True),
    ("amount", False),
    ("installment_months", False),
    ("approval_status", True),
    ("region", True),
]
_CATEGORIES = "'STANDARD', 'ECONOMY', 'MEDIUM', 'PROMO', 'SMALL', 'LARGE'"
_REGIONS = "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'"


def _count_if(condition: str) -> str:
    return f"(SELECT count(*) FROM typed WHERE {condition})"


def _check_list() -> list[tuple[str, str, str, str, str, bool]]:
    """(category, name, severity, count, detail, detail only when found)"""
    checks = []
    for name, is_text in _FACT:
        missing = f"{name} IS NULL" + (f" OR {name} IN ('', 'null')" if is_text else "")
        checks.append(
            (
                "missing",
                f"Null 검사 [{name}]",
                "MISSING",
                _count_if(missing),
                f"컬럼 ''{name}''에 Null 값 발견",
                True,
            )
        )

    def groups(keys: str) -> str:
        return (
            "(SELECT count(*) FROM (SELECT 1 AS one FROM typed "
            f"GROUP BY {keys} HAVING count(*) > 1))"
        )

    quoted = _CATEGORIES.replace("'", "''")
    checks += [
        ("duplicates", "거래ID 중복 검사", "FAIL", groups("transaction_id"),
         "transaction_id 중복 발견", True),
        ("duplicates", "이중결제 의심 검사", "WARN",
         groups("transaction_date, card_no, amount, merchant"),
         "동일 시각/카드/금액/가맹점 거래 발견", True),
        ("amount", "음수 금액 검사", "FAIL", _count_if("amount < 0"), "", False),
        ("amount", "과도 금액 검사", "WARN", _count_if("amount > 10000000"),
         "기준: 10,000,000원 초과", False),
        ("amount", "0원 거래 검사", "WARN", _count_if("amount = 0"), "", False),
        ("date", "날짜 형식 검사", "FAIL", _count_if("parsed IS NULL"),
         "yyyy-MM-dd HH:mm:ss 형식 불일치", False),
        ("date", "미래 날짜 검사", "WARN",
         _count_if("parsed > TIMESTAMP '2026-01-01 00:00:00'"), "", False),
        ("domain", "카테고리 유효성 검사", "FAIL", _count_if(f"category NOT IN ({_CATEGORIES})"),
         f"유효 카테고리: [{quoted}]", False),
        ("domain", "카드유형 유효성 검사", "FAIL", _count_if("card_type NOT IN ('O', 'F')"), "",
         False),
        ("domain", "승인상태 유효성 검사", "FAIL",
         _count_if("approval_status NOT IN ('approved', 'declined', 'cancelled')"), "", False),
        ("domain", "지역 유효성 검사", "FAIL", _count_if(f"region NOT IN ({_REGIONS})"), "", False),
        ("card", "카드번호 마스킹 검사", "FAIL",
         _count_if(r"NOT regexp_full_match(card_no, '\*{4}-\*{4}-\*{4}-\d{4}')"),
         "****-****-****-NNNN 패턴 불일치", False),
    ]
    return checks


def _checks_sql() -> str:
    lines = []
    for number, (category, name, severity, count, detail, only_found) in enumerate(
        _check_list(), 1
    ):
        shown = f"CASE WHEN n > 0 THEN '{detail}' ELSE '' END" if only_found else f"'{detail}'"
        bad = (
            "CASE WHEN n > total * CAST(0.01 AS DOUBLE) THEN 'FAIL' ELSE 'WARN' END"
            if severity == "MISSING"
            else f"'{severity}'"
        )
        lines.append(
            f"SELECT {number} AS check_no, '{category}' AS check_category, '{name}' AS check_name, "
            f"CASE WHEN n > 0 THEN {bad} ELSE 'PASS' END AS status, n AS issue_count, "
            f"CAST(n AS DOUBLE) / total * 100 AS issue_pct, {shown} AS detail, "
            f"total AS total_records FROM (SELECT {count} AS n, total FROM size)"
        )
    declined = _count_if("approval_status = 'declined'")
    lines.append(
        "SELECT 24, 'distribution', '거절률 이상 탐지', 'WARN', n, CAST(n AS DOUBLE) / total * 100, "
        "printf('거절률 %.2f%% (기준: 10%% 이하)', CAST(n AS DOUBLE) / total * 100), total "
        f"FROM (SELECT {declined} AS n, total FROM size) "
        "WHERE CAST(n AS DOUBLE) / total * 100 > 10"
    )
    for number, name in ((25, "amount"), (26, "installment_months")):
        text = {"amount": "amount_raw", "installment_months": "installment_raw"}[name]
        found = _count_if(f"{text} IS NOT NULL AND {text} NOT IN ('', 'null') AND {name} IS NULL")
        lines.append(
            f"SELECT {number}, 'format', 'unreadable_{name}', 'FAIL', n, "
            f"CAST(n AS DOUBLE) / total * 100, '', total FROM (SELECT {found} AS n, total FROM size) "
            "WHERE n > 0"
        )
    return (
        ", size AS (SELECT count(*) AS total FROM typed), checks AS ("
        + " UNION ALL ".join(lines)
        + "), listed AS (SELECT CAST(check_no AS INTEGER) AS check_no, check_category, check_name, "
        "status, issue_count, issue_pct, printf('%.4f%%', issue_pct) AS issue_ratio, detail, "
        "total_records FROM checks)"
    )


CHECKS = _checks_sql()
OVERALL = """CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'
             WHEN count(*) FILTER (status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END"""

_BUSINESS = [
    ("installment_eligibility",
     "installment_months > 0 AND NOT (card_type = 'O' AND amount >= 500000)"),
    ("installment_plan", "installment_months NOT IN (0, 3, 6)"),
    ("amount_step", "amount % 100 <> 0"),
    ("transaction_id_format", r"NOT regexp_full_match(transaction_id, 'TXN\d{10}')"),
    ("date_in_batch",
     "CAST(transaction_ts AS DATE) NOT BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'"),
]
BUSINESS = (
    ", size AS (SELECT count(*) AS total FROM txn), found AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS check_no, '{name}' AS check_name, "
        f"(SELECT count(*) FROM txn WHERE {condition}) AS n"
        for i, (name, condition) in enumerate(_BUSINESS, 1)
    )
    + """)
SELECT CAST(check_no AS INTEGER) AS check_no, 'business' AS check_category, check_name,
       CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS status, n AS issue_count,
       CAST(n AS DOUBLE) / total * 100 AS issue_pct,
       printf('%.4f%%', CAST(n AS DOUBLE) / total * 100) AS issue_ratio,
       '' AS detail, total AS total_records
FROM found, size"""
)

BODIES: dict[str, str] = {
    "daily_category_summary": DAILY,
    "merchant_ranking": RANKING,
    "hourly_pattern": f"""SELECT txn_hour, {STANDARD}, {SLOT} AS time_slot FROM evt_ok
        GROUP BY txn_hour""",
    "regional_analysis": REGIONAL,
    "monthly_trend": f"""SELECT txn_year, txn_month, {STANDARD}, {MERCHANTS} FROM ok
        GROUP BY txn_year, txn_month""",
    "etl_report": f"""SELECT {ROWS}, {SUM}, {CARDS}, {MERCHANTS}, min(txn_date) AS min_date,
        max(txn_date) AS max_date FROM ok""",
    "calendar_columns": """SELECT transaction_id, txn_year, txn_month, txn_quarter, txn_date,
        txn_hour, txn_day_of_week FROM evt""",
    "quarter_label": "SELECT transaction_id, txn_date, txn_quarter, quarter_label FROM txn",
    "quarterly_category_summary": QUARTER_CATEGORY,
    "quarterly_merchant_top10": f""", sums AS (
        SELECT txn_quarter, quarter_label, merchant, category, {N},
               CAST(sum(amount) AS BIGINT) AS total_revenue,
               count(DISTINCT card_no) AS unique_customers
        FROM ok WHERE txn_year = 1998 GROUP BY txn_quarter, quarter_label, merchant, category),
      ranked AS (
        SELECT *, CAST(dense_rank() OVER (PARTITION BY txn_quarter ORDER BY total_revenue DESC)
                       AS INTEGER) AS rank FROM sums)
      SELECT * FROM ranked WHERE rank <= 10""",
    "qoq_growth": f""", sums AS (
        SELECT txn_quarter, quarter_label, {N}, {SUM}, {CARDS} FROM ok WHERE txn_year = 1998
        GROUP BY txn_quarter, quarter_label),
      lagged AS (
        SELECT *, lag(total_amount) OVER (ORDER BY txn_quarter) AS prev_amount,
               lag(txn_count) OVER (ORDER BY txn_quarter) AS prev_count FROM sums)
      SELECT *, {_growth('total_amount', 'prev_amount')} AS amount_growth_rate,
             {_growth('txn_count', 'prev_count')} AS count_growth_rate FROM lagged""",
    "qoq_growth_calendar": f""", spine(txn_year, txn_quarter, quarter_label) AS (
        VALUES (2000, 4, 'Q4(10-12월)'), (2001, 1, 'Q1(1-3월)'), (2001, 2, 'Q2(4-6월)'),
               (2001, 3, 'Q3(7-9월)'), (2001, 4, 'Q4(10-12월)')),
      sums AS (SELECT txn_year, txn_quarter, {N}, {SUM}, {CARDS} FROM ok
               GROUP BY txn_year, txn_quarter),
      filled AS (
        SELECT s.txn_year, s.txn_quarter, s.quarter_label, coalesce(txn_count, 0) AS txn_count,
               total_amount, coalesce(unique_cards, 0) AS unique_cards
        FROM spine s LEFT JOIN sums q
          ON s.txn_year = q.txn_year AND s.txn_quarter = q.txn_quarter),
      lagged AS (
        SELECT *, lag(total_amount) OVER (ORDER BY txn_year, txn_quarter) AS prev_amount,
               lag(txn_count) OVER (ORDER BY txn_year, txn_quarter) AS prev_count FROM filled)
      SELECT CAST(txn_quarter AS INTEGER) AS txn_quarter, quarter_label, txn_count, total_amount,
             unique_cards, prev_amount, prev_count,
             {_growth('total_amount', 'prev_amount')} AS amount_growth_rate,
             {_growth('txn_count', 'prev_count')} AS count_growth_rate
      FROM lagged WHERE txn_year = 2001""",
    "quarterly_card_type": f"""SELECT txn_quarter, quarter_label, card_type, {N}, {SUM}, {AVG}
        FROM ok WHERE txn_year = 1998 GROUP BY txn_quarter, quarter_label, card_type""",
    "quarterly_region": f"""SELECT txn_quarter, quarter_label, region, {N}, {SUM}
        FROM ok WHERE txn_year = 1998 GROUP BY txn_quarter, quarter_label, region""",
    "quarterly_installment": f"""SELECT txn_quarter, quarter_label, installment_months, {N}, {SUM}
        FROM ok WHERE txn_year = 1998 AND installment_months > 0
        GROUP BY txn_quarter, quarter_label, installment_months""",
    "quarterly_report": f""", found AS (
        SELECT txn_quarter, {ROWS}, {SUM}, {CARDS}, {MERCHANTS} FROM ok WHERE txn_year = 2001
        GROUP BY txn_quarter)
      SELECT CAST(q AS INTEGER) AS txn_quarter, coalesce(txn_count, 0) AS txn_count, total_amount,
             coalesce(unique_cards, 0) AS unique_cards,
             coalesce(unique_merchants, 0) AS unique_merchants,
             printf('%d-%d', q * 3 - 2, q * 3) AS months,
             total_amount // nullif(txn_count, 0) AS avg_amount,
             CASE WHEN txn_count IS NULL THEN '데이터 없음' END AS note
      FROM (VALUES (1), (2), (3), (4)) quarters(q) LEFT JOIN found ON q = txn_quarter""",
    "notebook_category": f"SELECT category, {ROWS}, {SUM}, {AVG} FROM ok GROUP BY category",
    "notebook_hourly": f"""SELECT txn_hour, {ROWS}, {SUM},
        CAST(sum(amount) AS DOUBLE) / 1000000 AS amount_millions FROM evt_ok GROUP BY txn_hour""",
    "notebook_monthly": f"""SELECT txn_month, {ROWS}, {SUM}, {AVG},
        CAST(sum(amount) AS DOUBLE) / 100000000 AS amount_hundred_millions
        FROM ok GROUP BY txn_month""",
    "notebook_regional": f"SELECT region, {ROWS}, {SUM}, {AVG} FROM ok GROUP BY region",
    "merchant_top15": f"""SELECT merchant, category, {ROWS}, {SUM},
        merchant || ' (' || category || ')' AS label,
        CAST(sum(amount) AS DOUBLE) / 100000000 AS amount_hundred_millions
        FROM ok GROUP BY merchant, category
        ORDER BY total_amount DESC, merchant, category LIMIT 15""",
    "notebook_summary": f"""SELECT {ROWS}, {SUM}, {CARDS}, {MERCHANTS},
        round(CAST(sum(amount) AS DOUBLE) / 100000000, 1) AS amount_hundred_millions,
        CAST(sum(amount) // count(*) AS BIGINT) AS avg_amount FROM ok""",
    "amount_describe": """, sums AS (
        SELECT count(amount) AS n, sum(CAST(amount AS HUGEINT)) AS s,
               sum(CAST(amount AS HUGEINT) * amount) AS q, min(amount) AS low, max(amount) AS high FROM ok),
      near AS (SELECT *, CAST(floor(CAST(s AS DOUBLE) / n) AS HUGEINT) AS m FROM sums)
      SELECT n AS "count", CAST(s AS DOUBLE) / n AS mean,
             sqrt((CAST(q - 2 * m * s + n * m * m AS DOUBLE)
                   - CAST(s - n * m AS DOUBLE) * CAST(s - n * m AS DOUBLE) / n) / (n - 1)) AS stddev,
             low AS "min", high AS "max" FROM near""",
    "category_distribution": f"""SELECT category, {ROWS}, {SUM},
        {_pct('count(*)', 'sum(count(*)) OVER ()', 1)} AS share_pct FROM txn GROUP BY category""",
    "approval_distribution": f"""SELECT approval_status, {ROWS},
        {_pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct FROM txn
        GROUP BY approval_status""",
    "preview_merchants": f"""{RANKING}
        ORDER BY total_revenue DESC, merchant, category, sub_category LIMIT 15""",
    "daily_approval_rate": f"""SELECT txn_date, category, {N},
        count(*) FILTER (approval_status = 'approved') AS approved_count,
        count(*) FILTER (approval_status = 'cancelled') AS cancelled_count,
        {_pct("count(*) FILTER (approval_status = 'approved')", 'count(transaction_id)')}
          AS approval_rate
        FROM txn GROUP BY txn_date, category""",
    "merchant_amount_rank": f""", sums AS (
        SELECT merchant, category, {N}, {SUM}, {AVG}, {CARDS} FROM ok GROUP BY merchant, category)
      SELECT *, rank() OVER (ORDER BY total_amount DESC) AS amount_rank FROM sums""",
    "hourly_ratios": f"""SELECT txn_hour, {SLOT} AS time_slot, {N},
        {_pct("count(*) FILTER (card_type = '신용')", 'count(transaction_id)')} AS credit_ratio,
        {_pct("count(*) FILTER (approval_status = 'cancelled')", 'count(transaction_id)')}
          AS cancel_rate
        FROM evt GROUP BY txn_hour""",
    "hourly_ratios_by_commute": f"""SELECT txn_hour,
        CASE WHEN txn_hour BETWEEN 7 AND 9 THEN 'way there'
             WHEN txn_hour BETWEEN 16 AND 18 THEN 'way back'
             WHEN txn_hour IS NOT NULL THEN 'rest of the day' END AS time_slot, {N},
        {_pct("count(*) FILTER (card_type = '신용')", 'count(transaction_id)')} AS credit_ratio,
        {_pct("count(*) FILTER (approval_status = 'cancelled')", 'count(transaction_id)')}
          AS cancel_rate
        FROM evt GROUP BY txn_hour""",
    "regional_profile": f""", tops AS (
        SELECT region, category, row_number() OVER (
                 PARTITION BY region ORDER BY count(*) DESC, category DESC) AS place
        FROM ok GROUP BY region, category),
      sums AS (
        SELECT region, {N}, {SUM}, {AVG}, {MERCHANTS},
               {_pct("count(*) FILTER (card_type = 'O')", 'count(transaction_id)')} AS credit_ratio
        FROM ok GROUP BY region)
      SELECT sums.*, tops.category AS top_category FROM sums JOIN tops USING (region)
      WHERE place = 1""",
    "monthly_mom_growth": f""", sums AS (
        SELECT strftime(transaction_ts, '%Y-%m') AS txn_month, {STANDARD}, {MERCHANTS}
        FROM ok GROUP BY 1),
      lagged AS (SELECT *, lag(total_amount) OVER (ORDER BY txn_month) AS prev FROM sums)
      SELECT * EXCLUDE (prev), {_growth('total_amount', 'prev')} AS mom_growth_rate FROM lagged""",
    "quarterly_category_qoq": f""", sums AS (
        SELECT txn_quarter, category, {N}, {SUM}, {AVG} FROM ok WHERE txn_year = 1998
        GROUP BY txn_quarter, category),
      lagged AS (
        SELECT *, lag(total_amount) OVER (PARTITION BY category ORDER BY txn_quarter) AS prev
        FROM sums)
      SELECT 'Q' || txn_quarter AS quarter, category, txn_count, total_amount, avg_amount,
             {_growth('total_amount', 'prev')} AS qoq_growth_rate FROM lagged""",
    "daily_top5_category": f""", daily AS ({DAILY}),
      placed AS (
        SELECT txn_date, category, total_amount, CAST(row_number() OVER (
                 PARTITION BY txn_date ORDER BY total_amount DESC, category) AS INTEGER) AS rn
        FROM daily)
      SELECT * FROM placed WHERE rn <= 5""",
    "time_slot_share": f"""SELECT {SLOT} AS time_slot, count(*) AS total_txns,
        {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM evt_ok GROUP BY 1""",
    "regional_monthly_trend": f"""SELECT strftime(transaction_ts, '%Y-%m') AS txn_month, region,
        {N}, {SUM} FROM ok GROUP BY 1, region""",
    "join_category_left": f""", {MASTER}
        SELECT category, transaction_id, amount, category_group, priority
        FROM txn LEFT JOIN master USING (category)""",
    "join_category_broadcast": BY_GROUP,
    "join_category_merge": BY_GROUP,
    "dq_merchant_master": f"""SELECT merchant, {ROWS}, {SUM} FROM txn
        WHERE merchant NOT IN (SELECT s_name FROM supplier WHERE s_acctbal >= 0)
        GROUP BY merchant""",
    "dq_category_amount_range": """, ranges(category, low, high) AS (
        VALUES ('STANDARD', 200000, 9000000), ('ECONOMY', 150000, 6000000),
               ('MEDIUM', 100000, 8000000), ('PROMO', 500000, 10000000),
               ('SMALL', 300000, 5000000), ('LARGE', 900000, 10500000))
      SELECT category, count(*) FILTER (amount < low - 50) AS below_count,
             count(*) FILTER (amount > high + 50) AS above_count
      FROM txn JOIN ranges USING (category)
      WHERE amount < low - 50 OR amount > high + 50 GROUP BY category""",
    "dq_checks": f"{CHECKS} SELECT * FROM listed",
    "dq_verdict": f"""{CHECKS} SELECT {OVERALL} AS overall_status, count(*) AS check_count,
        count(*) FILTER (status = 'PASS') AS pass_count,
        count(*) FILTER (status = 'WARN') AS warn_count,
        count(*) FILTER (status = 'FAIL') AS fail_count FROM listed""",
    "dq_report_json": f"""{CHECKS} SELECT total_records, (SELECT {OVERALL} FROM listed)
        AS overall_status, check_no, check_name AS "check", status, issue_count, issue_ratio, detail
        FROM listed""",
    "dq_duplicate_ids": """SELECT transaction_id, count(*) AS "count" FROM dirty
        GROUP BY transaction_id HAVING count(*) > 1""",
    "dq_duplicate_sample": """SELECT transaction_id, count(*) AS "count" FROM txn
        GROUP BY transaction_id HAVING count(*) > 1
        ORDER BY "count" DESC, transaction_id LIMIT 5""",
    "dq_double_payment": """SELECT txn_date, txn_hour, card_no, category, count(*) AS "count"
        FROM evt GROUP BY txn_date, txn_hour, card_no, category HAVING count(*) > 1""",
    "dq_declined_rate": f""", one AS (
        SELECT count(*) FILTER (approval_status = 'declined') AS issue_count, count(*) AS total
        FROM txn)
      SELECT 'declined' AS approval_status, issue_count, {_pct('issue_count', 'total')}
        AS declined_pct FROM one WHERE CAST(issue_count AS DOUBLE) / total * 100 > 10""",
    "dq_business_rules": BUSINESS,
    "amount_stats": """SELECT CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount,
        CAST(count(*) FILTER (amount < 0) AS BIGINT) AS negative_count FROM typed""",
    "csv_raw_try_cast": """SELECT count(*) AS total_records, count(amount) AS amount_ok,
        count(*) FILTER (amount IS NULL AND amount_raw IS NOT NULL) AS amount_unparseable,
        count(installment_months) AS installment_ok,
        count(*) FILTER (installment_months IS NULL AND installment_raw IS NOT NULL)
          AS installment_unparseable,
        CAST(sum(amount) AS BIGINT) AS amount_sum FROM typed""",
    "csv_parquet_roundtrip": """SELECT transaction_id,
        strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') AS transaction_date, card_no, card_type,
        merchant, sub_category, category, amount, installment_months,
        approval_status, region, txn_date, txn_quarter FROM txn""",
    "sink_by_day": DAILY,
    "sink_by_region": REGIONAL,
    "sink_by_quarter": QUARTER_CATEGORY,
    "partitioned_transactions": """SELECT transaction_id,
        strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') AS transaction_date, card_no, card_type,
        merchant, sub_category, category, amount, installment_months, approval_status, region,
        txn_date, CAST(hour(transaction_ts) AS INTEGER) AS txn_hour,
        CAST(dayofweek(transaction_ts) + 1 AS INTEGER) AS txn_day_of_week, txn_quarter,
        quarter_label, txn_year, txn_month FROM ok""",
    "output_manifest": """, regions AS (
        SELECT CAST(count(DISTINCT coalesce(region, '?')) AS HUGEINT) AS files,
               CAST(count(*) AS HUGEINT) AS "rows" FROM (SELECT DISTINCT region, category FROM ok)),
      quarters AS (
        SELECT count(DISTINCT txn_quarter) AS files, count(*) AS "rows"
        FROM (SELECT DISTINCT txn_quarter, category FROM ok WHERE txn_year = 1998))
      SELECT table_name, CAST(files AS BIGINT) AS files, true AS bytes_match, true AS snappy,
             CAST("rows" AS BIGINT) AS "rows"
      FROM (SELECT 'regional_analysis' AS table_name, * FROM regions
            UNION ALL SELECT 'a+b/regional_analysis', * FROM regions
            UNION ALL SELECT '1998/quarterly_category_summary', * FROM quarters)""",
    "catalog_tables": """, sizes AS (
        SELECT 'hourly_pattern' AS table_name, count(DISTINCT txn_hour) AS "rows",
               count(transaction_id) AS txn_count FROM evt_ok
        UNION ALL SELECT 'monthly_trend', count(DISTINCT (txn_year, txn_month)),
               count(transaction_id) FROM ok
        UNION ALL SELECT 'qoq_growth', count(DISTINCT txn_quarter), count(transaction_id)
               FROM ok WHERE txn_year = 1998
        UNION ALL SELECT 'quarterly_region', count(DISTINCT (txn_quarter, region)),
               count(transaction_id) FROM ok WHERE txn_year = 2001)
      SELECT * FROM sizes""",
    "catalog_comments": """, groups AS (SELECT DISTINCT region, category FROM ok)
      SELECT column_name, comment, is_partition, (SELECT count(*) FROM groups) AS filled
      FROM (VALUES ('region', 'Region', true), ('category', 'Merchant category', false),
                   ('txn_count', 'Number of transactions', false),
                   ('total_amount', 'Sum of amounts', false),
                   ('avg_amount', 'Rounded mean amount', false),
                   ('unique_cards', 'Distinct masked card numbers', false))
        AS columns_(column_name, comment, is_partition)""",
    "catalog_external_table": f"""SELECT txn_year, txn_month, category, {N}, {SUM} FROM ok
        GROUP BY txn_year, txn_month, category""",
    "lookup_day_plain": """SELECT transaction_id, card_no, category, amount, txn_date FROM evt
        WHERE txn_date = '2024-01-15'""",
    "lookup_day_partitioned": """SELECT transaction_id, card_no, category, amount, txn_date FROM evt
        WHERE txn_date = '2024-01-15'""",
    "lookup_month_partitioned": """SELECT transaction_id, category, amount, txn_year, txn_month
        FROM txn WHERE txn_year = 1998 AND txn_month = 6""",
    "cached_reuse": f"""SELECT category, {ROWS}, {SUM}, CAST(2 AS BIGINT) AS runs FROM ok
        GROUP BY category""",
    "category_rollup_for_cache": f"""SELECT category, {ROWS}, {SUM}, {EXACT_MEAN} FROM ok
        GROUP BY category""",
    "repartition_invariance": f"""SELECT category, {ROWS}, {SUM},
        CAST(1 AS BIGINT) AS distinct_results FROM ok GROUP BY category""",
    "partition_profile": """SELECT count(*) AS total_rows, CAST(16 AS BIGINT) AS partitions,
        true AS even FROM ok""",
    "benchmark_report_roundtrip": """SELECT 'join_merge' AS test_name,
        (SELECT count(*) FROM txn) || ' rows' AS detail, true AS timed
      UNION ALL SELECT 'join_broadcast', (SELECT count(*) FROM txn) || ' rows', true
      UNION ALL SELECT 'aggregate',
        (SELECT count(DISTINCT category) FROM txn) || ' rows', true""",
}

BODIES |= {
    "dq_history": """, batch AS (SELECT *, k % 7 = 0 AS id_old, k % 11 = 0 AS pay_old FROM txn WHERE txn_year = 1998),
      stored_ids AS (SELECT transaction_id FROM txn WHERE txn_year < 1998
        UNION ALL SELECT transaction_id FROM batch WHERE id_old),
      stored_pay AS (SELECT transaction_ts, card_no, amount, merchant FROM txn WHERE txn_year < 1998
        UNION ALL SELECT transaction_ts, card_no, amount, merchant FROM batch WHERE pay_old),
      counts AS (
        SELECT 1 AS check_no, 'id_stored_already' AS check_name, 'FAIL' AS bad,
               (SELECT count(*) FROM batch WHERE transaction_id IN (SELECT transaction_id FROM stored_ids)) AS n
        UNION ALL SELECT 2, 'payment_stored_already', 'WARN',
               (SELECT count(*) FROM batch b WHERE EXISTS (SELECT 1 FROM stored_pay s WHERE s.transaction_ts = b.transaction_ts
                AND s.card_no = b.card_no AND s.amount = b.amount AND s.merchant = b.merchant))),
      size AS (SELECT count(*) AS total FROM batch)
      SELECT CAST(check_no AS INTEGER) AS check_no, 'duplicates' AS check_category, check_name,
             CASE WHEN n > 0 THEN bad ELSE 'PASS' END AS status, n AS issue_count,
             CAST(n AS DOUBLE) / total * 100 AS issue_pct,
             printf('%.4f%%', CAST(n AS DOUBLE) / total * 100) AS issue_ratio, '' AS detail, total AS total_records
      FROM counts, size""",
    "lookup_card_clustered": """SELECT transaction_id, card_no, category, amount FROM txn
        WHERE card_no = '****-****-****-1037'""",
    "bucketed_merchant_join": f"""SELECT category,
        merchant IN (SELECT s_name FROM supplier WHERE s_acctbal >= 0) AS in_master, {ROWS}, {SUM}
        FROM txn GROUP BY ALL""",
    "catalog_touched_months": BODIES["catalog_external_table"],
    "footer_profile": """SELECT 'amount' AS column_name, count(*)::HUGEINT::BIGINT AS row_count,
        CAST(count(*) - count(amount) AS BIGINT) AS null_count, CAST(NULL AS VARCHAR) AS min_text,
        CAST(NULL AS VARCHAR) AS max_text, min(amount) AS min_amount, max(amount) AS max_amount FROM txn
      UNION ALL SELECT 'merchant', count(*), count(*) - count(merchant), min(merchant), max(merchant), NULL, NULL FROM txn
      UNION ALL SELECT 'transaction_id', count(*), count(*) - count(transaction_id), min(transaction_id),
        max(transaction_id), NULL, NULL FROM txn""",
}

# Days that were run again must leave no trace.
BODIES |= {
    "etl_day_rerun": BODIES["partitioned_transactions"],
    "rerun_daily_approval_rate": BODIES["daily_approval_rate"],
    "rerun_hourly_ratios": BODIES["hourly_ratios"],
    "rerun_daily_category": DAILY,
    "rerun_hourly_pattern": BODIES["hourly_pattern"],
    "rerun_regional_analysis": REGIONAL,
    "rerun_monthly_trend": BODIES["monthly_trend"],
    "rerun_monthly_mom_growth": BODIES["monthly_mom_growth"],
    "rerun_merchant_ranking": RANKING,
    "rerun_etl_report": BODIES["etl_report"],
    "rerun_quarterly_category": QUARTER_CATEGORY,
    "rerun_quarterly_region": BODIES["quarterly_region"],
    "rerun_qoq_growth": BODIES["qoq_growth"],
}


def oracle_sql() -> dict[str, str]:
    return {name: VIEWS + body for name, body in BODIES.items()}
