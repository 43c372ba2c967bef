"""DuckDB statements equivalent to the registered queries, written from the definitions. Word lists, patterns and mart names are
the package's own; unit tests with literal inputs pin them.

Rounded quotients are computed in integers (exact half-up), so they do not depend on either engine's floating point.
"""

from __future__ import annotations

from peoplelake import bindings as b
from peoplelake.bindings import AS_OF
from peoplelake.functions.cleaning import DEPARTMENT_PATTERNS
from peoplelake.operators.retrieval import DIMENSIONS
from peoplelake.operators.routing import INTENT_RULES, INTENTS, TOPIC_WORDS
from peoplelake.plans.catalog import BLOCKED_WORDS, MAX_SQL_CHARS
from peoplelake.plans.gold import MARTS
from peoplelake.schemas import STREAMS

ORACLES: dict[str, str] = {}
SNAP = f"DATE '{AS_OF}' AS snapshot_date"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def options(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values, position: str) -> str:
    return f"({options(values)})[CAST(({position}) % {len(values)} AS INT) + 1]"


def case_of(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half-up at ``digits``, for non-negative numbers; null without a denominator."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"(CAST((2 * {n} * {10**digits} + {d}) // (2 * nullif({d}, 0)) AS DOUBLE) / CAST({10**digits} AS DOUBLE))"


def units(x: str) -> str:
    return f"CAST(round({x} * 10000) AS HUGEINT)"


def mean(x: str, digits: int = 2) -> str:
    return half_up(f"sum({units(x)})", f"count({x}) * 10000", digits)


def total(x: str, digits: int = 2) -> str:
    return half_up(f"sum({units(x)})", "10000", digits)


def rate(a: str, n: str) -> str:
    return half_up(a, n, 4)


# -- shared relations -----------------------------------------------------------------------------------------------------
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {}


def relation(name: str, sql: str, *needs: str) -> None:
    RELATIONS[name] = (needs, sql)


def using(names: str, final: str) -> str:
    """``final`` with the named relations, and what they need, as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in RELATIONS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n][1]})" for n in ordered) + "\n" + final


def oracle(key: str, relations: str, final: str) -> None:
    ORACLES[key] = using(relations, final) if relations else final


relation(
    "people",
    "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
relation(
    "emp",
    """SELECT CAST(o_orderkey AS VARCHAR) AS employee_id, c_name AS name,
    CASE WHEN o_custkey % 41 <> 0 THEN c_mktsegment END AS department,
    CASE WHEN o_custkey % 59 <> 0 THEN n_name END AS country,
    CASE WHEN o_custkey % 47 <> 0 THEN o_totalprice END AS salary,
    CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' END AS attrition,
    CASE WHEN o_custkey % 43 <> 0 THEN CAST(o_orderdate AS DATE) END AS joining_date,
    CASE WHEN o_custkey % 37 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INT) END AS performance_rating,
    CASE WHEN o_custkey % 39 <> 0 THEN CAST(o_custkey % 36 AS INT) END AS experience_years FROM people""",
    "people",
)
_salary = (
    f"CASE WHEN o_orderkey % 30 < {len(b.SALARY_WORDS)} THEN {pick(b.SALARY_WORDS, 'o_orderkey % 30')} "
    "WHEN o_orderkey % 30 = 12 THEN '$' || format('{:,}', CAST(floor(price) AS BIGINT)) "
    "WHEN o_orderkey % 30 = 13 THEN CAST(CAST(floor(price / 1000) AS BIGINT) AS VARCHAR) || 'k' "
    "WHEN o_orderkey % 30 = 14 THEN format('{:,.2f}', CAST(price AS DOUBLE)) "
    "WHEN o_orderkey % 30 = 15 THEN '€' || format('{:,}', CAST(floor(price) AS BIGINT)) "
    "WHEN o_orderkey % 30 = 16 THEN '  ' || CAST(price AS VARCHAR) || ' INR  ' "
    "WHEN o_orderkey % 30 <> 17 THEN CAST(price AS VARCHAR) END"
)
relation(
    "feed",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS employee_id, '  ' || c_name || ' ' AS name,
    CASE WHEN o_orderkey % 53 <> 0 THEN {pick(b.DEPARTMENT_SPELLINGS, 'o_orderkey')} END AS department,
    {_salary} AS salary,
    CASE WHEN o_orderkey % 40 < {len(b.BAD_DATES)} THEN {pick(b.BAD_DATES, 'o_orderkey % 40')}
         WHEN o_orderkey % 40 <> 12 THEN strftime(o_orderdate, '%Y-%m-%d') END AS joining_date,
    CASE o_orderkey % 17 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 4.7::DOUBLE WHEN 2 THEN 5.4::DOUBLE WHEN 3 THEN NULL
         ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS performance_rating,
    CASE WHEN o_custkey % 23 = 0 THEN '   ' WHEN o_custkey % 29 <> 0 THEN 'Manager ' || (o_custkey % 50) END AS manager,
    CASE WHEN o_orderstatus = 'F' THEN {pick(b.YES_SPELLINGS, 'o_orderkey')}
         WHEN o_orderstatus = 'O' THEN {pick(b.NO_SPELLINGS, 'o_orderkey')}
         WHEN o_orderkey % 2 = 0 THEN 'maybe' END AS attrition,
    CASE o_orderkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN '  ' || n_name || ' ' ELSE n_name END AS country,
    CASE WHEN o_orderkey % 13 <> 0 THEN [{pick(b.SKILLS, 'o_orderkey')}, {pick(b.SKILLS, 'o_orderkey * 7 + 3')},
         {pick(b.SKILLS, 'o_custkey')}, {pick(b.SKILLS, 'o_orderkey')}] END AS skills,
    CASE o_orderkey % 19 WHEN 0 THEN -1.0::DOUBLE WHEN 1 THEN 60.0::DOUBLE WHEN 2 THEN 61.0::DOUBLE WHEN 3 THEN NULL
         ELSE CAST(o_custkey % 36 AS DOUBLE) END AS experience,
    o_orderkey * 2 + copy AS "offset",
    o_orderdate + CASE WHEN copy = 2 AND o_custkey % 2 = 1 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ingest_ts,
    CAST(o_orderdate AS DATE) AS ingest_date
    FROM (SELECT *, CAST(o_totalprice + (copy - 1) * 1000 AS DECIMAL(14, 2)) AS price FROM (
      SELECT *, unnest(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN [1, 2] ELSE [1] END) AS copy
      FROM people))""",
    "people",
)
_canonical = "CASE WHEN nullif(trim(department), '') IS NULL THEN NULL " + " ".join(
    f"WHEN regexp_matches(lower(trim(department)), {lit(p)}) THEN {lit(n)}" for n, p in DEPARTMENT_PATTERNS
) + " ELSE department END"
_known = "(" + ", ".join(lit(n) for n, _ in DEPARTMENT_PATTERNS) + ")"
_text = "lower(trim(salary))"
_amount = (
    f"CASE WHEN regexp_matches({_text}, '^[0-9,. ]+\\s*k\\s*$') "
    f"THEN TRY_CAST(regexp_replace({_text}, '[^0-9.]', '', 'g') AS DOUBLE) * 1000 "
    f"ELSE TRY_CAST(regexp_replace({_text}, '[^0-9.\\-]', '', 'g') AS DOUBLE) END"
)
_day = "CAST(try_strptime(joining_date, '%Y-%m-%d') AS DATE)"
relation(
    "parsed",
    f"""SELECT * EXCLUDE (name, manager, country, department, salary, joining_date, performance_rating, attrition, skills),
    nullif(trim(name), '') AS name, nullif(trim(manager), '') AS manager,
    department AS department_raw, {_canonical} AS department,
    salary AS salary_raw, CASE WHEN {_text} NOT IN ('n/a', 'unknown', 'tbd', '-', '??', 'null', '')
       AND {_amount} BETWEEN 0 AND 100000000 THEN {_amount} END AS salary,
    joining_date AS joining_date_raw,
    CASE WHEN year({_day}) >= 1950 AND {_day} <= DATE '{AS_OF}' THEN {_day} END AS joining_date,
    CASE WHEN performance_rating BETWEEN 1 AND 5 THEN CAST(trunc(performance_rating) AS INT) END AS performance_rating,
    CASE WHEN lower(trim(attrition)) IN ('yes', 'y', 'true', '1') THEN 'Yes'
         WHEN lower(trim(attrition)) IN ('no', 'n', 'false', '0') THEN 'No' END AS attrition,
    upper(substr(trim(country), 1, 1)) || lower(substr(trim(country), 2)) AS country,
    array_to_string(list_sort(list_distinct(skills)), '|') AS skills,
    CAST(coalesce(len(list_distinct(skills)), 0) AS INT) AS skills_count,
    CASE WHEN experience BETWEEN 0 AND 60 THEN CAST(trunc(experience) AS INT) END AS experience_years
    FROM feed""",
    "feed",
)
relation(
    "silver",
    f"""SELECT employee_id, name, department, department_raw, department IN {_known} AS department_canonical,
    salary, salary_raw, salary IS NOT NULL AS salary_valid, joining_date, joining_date_raw,
    joining_date IS NOT NULL AS joining_date_valid, performance_rating, manager, attrition, country, skills,
    skills_count, experience_years, ingest_ts, ingest_date
    FROM (SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY ingest_ts DESC, "offset" DESC) AS rn FROM parsed)
    WHERE rn = 1""",
    "parsed",
)
relation(
    "versions",
    """SELECT CAST(o_orderkey AS VARCHAR) AS employee_id, c_mktsegment AS department, r_name AS location,
    'L' || version AS grade, o_totalprice + (version - 1) * 500 AS base_salary,
    CASE WHEN version = 1 THEN o_orderstatus <> 'F' ELSE o_orderstatus = 'F' END AS is_active,
    CAST(o_orderdate AS DATE) AS hire_date, CAST(CAST(o_orderdate AS DATE) + CAST(version AS INT) AS TIMESTAMP) AS event_ts,
    version = max(version) OVER (PARTITION BY o_orderkey) AS is_current
    FROM (SELECT *, unnest(CASE WHEN o_orderpriority = '2-HIGH' THEN [1, 2] ELSE [1] END) AS version FROM people)""",
    "people",
)
relation(
    "attendance",
    f"""SELECT user_id || '-' || strftime(ts, '%Y%m%d') AS attendance_id, CAST(user_id AS VARCHAR) AS employee_id,
    CAST(ts AS DATE) AS work_date, value / 10 AS hours_worked, {case_of('event_type', b.STATUS_OF_EVENT)} AS status,
    value > 100 AS is_late, event_id AS sequence, ts AS event_ts FROM events""",
)
relation(
    "fct_attendance",
    """SELECT attendance_id, employee_id, work_date,
    CASE WHEN hours_worked BETWEEN 0 AND 24 THEN hours_worked END AS hours_worked, lower(status) AS status, is_late,
    sequence, event_ts, CAST(dayofweek(work_date) + 1 AS INT) AS dow, dayofweek(work_date) IN (0, 6) AS is_weekend
    FROM (SELECT *, row_number() OVER (PARTITION BY attendance_id ORDER BY event_ts DESC, hours_worked DESC, status DESC,
      is_late DESC, sequence DESC) AS rn FROM attendance) WHERE rn = 1""",
    "attendance",
)
relation(
    "reviews",
    """SELECT l_orderkey || '-' || l_linenumber AS review_id, CAST(l_orderkey AS VARCHAR) AS employee_id,
    year(l_shipdate) || CASE WHEN month(l_shipdate) <= 6 THEN '-H1' ELSE '-H2' END AS cycle, l_linenumber AS rating,
    (l_discount - 0.05::DOUBLE) * 1000 AS goals_met_pct, l_returnflag = 'R' AS promotion_flag,
    l_extendedprice AS bonus_amount, l_shipdate AS event_ts FROM lineitem""",
)
relation(
    "fct_performance",
    """SELECT review_id, employee_id, cycle, rating, CASE WHEN goals_met_pct < 0 THEN 0.0::DOUBLE ELSE goals_met_pct END
    AS goals_met_pct, promotion_flag, bonus_amount, event_ts, rating >= 4 AS is_high_performer
    FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY event_ts DESC, cycle DESC, goals_met_pct DESC,
      promotion_flag DESC, bonus_amount DESC) AS rn FROM reviews WHERE rating BETWEEN 1 AND 5) WHERE rn = 1""",
    "reviews",
)
_k = "CAST(json_extract(props, '$.k') AS INT)"
relation(
    "applications",
    f"""SELECT user_id || '-' || (event_id % 7) AS application_id, 'src' || ({_k} % 5) AS source,
    CASE WHEN {_k} >= 90 THEN 'ghosted' ELSE {case_of('event_type', b.STAGE_OF_EVENT)} END AS stage,
    c_mktsegment AS department, value AS offer_amount, event_id AS sequence, ts AS event_ts
    FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
relation(
    "fct_recruitment",
    """SELECT * EXCLUDE (rn), CAST(list_position(['applied', 'screen', 'interview', 'offer', 'hired', 'rejected'], stage)
    AS INT) AS stage_rank FROM (SELECT *, row_number() OVER (PARTITION BY application_id, stage ORDER BY event_ts DESC,
      source DESC, department DESC, offer_amount DESC, sequence DESC) AS rn FROM applications
      WHERE stage IN ('applied', 'screen', 'interview', 'offer', 'hired', 'rejected')) WHERE rn = 1""",
    "applications",
)

# -- marts ----------------------------------------------------------------------------------------------------------------
_SPLIT = (
    "count(*) AS headcount, count(*) FILTER (attrition = 'Yes') AS attrited, count(*) FILTER (attrition = 'No') AS active"
)


def _split_mart(key: str, source: str = "emp") -> str:
    return f"SELECT {key}, {_SPLIT} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1"


def attrition_mart(key: str, source: str = "emp") -> str:
    return (f"SELECT {key}, headcount, attrited, active, {rate('attrited', 'headcount')} AS attrition_rate, {SNAP} "
            f"FROM ({_split_mart(key, source)})")


def workforce_mart(key: str) -> str:
    return (f"SELECT {key}, headcount, active, attrited, {rate('active', 'headcount')} AS active_pct, {SNAP} "
            f"FROM ({_split_mart(key)})")


_y, _m, _d = AS_OF.split("-")
_TENURE = (f"(({int(_y)} - year(joining_date)) * 12 + ({int(_m)} - month(joining_date)) "
           f"+ ({int(_d)} - day(joining_date)) / 31.0) / 12.0")
relation(
    "cohorts",
    f"""SELECT *, CAST(year(joining_date) AS INT) AS hire_year, CAST(month(joining_date) AS INT) AS hire_month,
    CASE WHEN joining_date IS NULL THEN NULL WHEN {_TENURE} < 1 THEN '0-1y' WHEN {_TENURE} < 3 THEN '1-3y'
         WHEN {_TENURE} < 5 THEN '3-5y' WHEN {_TENURE} < 10 THEN '5-10y' ELSE '10y+' END AS tenure_bucket FROM emp""",
    "emp",
)


def percentile(p: float) -> str:
    return f"round(quantile_disc(salary, {p}), 2)"


_PAY = (
    f"count(*) AS employees_with_salary, {mean('salary')} AS avg_salary, {percentile(0.5)} AS median_salary, "
    f"{percentile(0.25)} AS p25_salary, {percentile(0.75)} AS p75_salary, {percentile(0.9)} AS p90_salary, "
    "round(stddev_samp(salary), 2) AS stddev_salary, round(min(salary), 2) AS min_salary, "
    f"round(max(salary), 2) AS max_salary, {total('salary')} AS total_payroll, {SNAP}"
)
MART_SQL = {
    "attrition_by_department": ("emp", attrition_mart("department")),
    "attrition_by_country": ("emp", attrition_mart("country")),
    "attrition_trend_by_cohort": ("cohorts", attrition_mart("hire_year", "cohorts")),
    "attrition_by_tenure_bucket": ("cohorts", attrition_mart("tenure_bucket", "cohorts")),
    "salary_by_department": ("emp", f"SELECT department, {_PAY} FROM emp WHERE salary IS NOT NULL GROUP BY 1"),
    "salary_distribution": (
        "emp", f"SELECT {_PAY}, {percentile(0.95)} AS p95_salary, {percentile(0.99)} AS p99_salary FROM emp "
        "WHERE salary IS NOT NULL"),
    "workforce_by_country": ("emp", workforce_mart("country")),
    "workforce_by_department": ("emp", workforce_mart("department")),
    "workforce_experience_distribution": (
        "emp",
        f"""SELECT experience_bucket, headcount, {rate('headcount', 'sum(headcount) OVER ()')} AS share_pct, {SNAP} FROM (
        SELECT CASE WHEN experience_years < 2 THEN '0-2y' WHEN experience_years < 5 THEN '2-5y'
          WHEN experience_years < 10 THEN '5-10y' WHEN experience_years < 20 THEN '10-20y' ELSE '20y+' END
          AS experience_bucket, count(*) AS headcount FROM emp WHERE experience_years IS NOT NULL GROUP BY 1)"""),
    "workforce_hiring_trends": (
        "cohorts",
        f"""SELECT hire_year, hire_month, count(*) AS hires, printf('%04d-%02d', hire_year, hire_month) AS year_month, {SNAP}
        FROM cohorts WHERE hire_year IS NOT NULL GROUP BY hire_year, hire_month"""),
    "performance_by_department": (
        "emp",
        f"""SELECT *, {rate('high_performers', 'rated_employees')} AS high_performer_pct,
        {rate('low_performers', 'rated_employees')} AS low_performer_pct, {SNAP} FROM (
        SELECT department, count(*) AS rated_employees, {half_up('sum(performance_rating)', 'count(*)', 2)} AS avg_rating,
          count(*) FILTER (performance_rating >= 4) AS high_performers,
          count(*) FILTER (performance_rating <= 2) AS low_performers
        FROM emp WHERE performance_rating IS NOT NULL GROUP BY 1)"""),
    "performance_vs_salary": (
        "emp",
        f"""SELECT performance_rating, count(*) AS employees, {mean('salary')} AS avg_salary,
        {percentile(0.5)} AS median_salary, round(min(salary), 2) AS min_salary, round(max(salary), 2) AS max_salary, {SNAP}
        FROM emp WHERE performance_rating IS NOT NULL AND salary IS NOT NULL GROUP BY 1"""),
}
for _name, (_needs, _sql) in MART_SQL.items():
    relation(f"m_{_name}", _sql, *_needs.split())
relation(
    "m_salary_top_paying_depts",
    "SELECT rank, department, avg_salary, median_salary, employees_with_salary, total_payroll, snapshot_date FROM "
    "(SELECT *, CAST(dense_rank() OVER (ORDER BY avg_salary DESC) AS INT) AS rank FROM m_salary_by_department) WHERE rank <= 5",
    "m_salary_by_department",
)
relation(
    "m_performance_top_teams",
    "SELECT rank, department, avg_rating, rated_employees, high_performer_pct, snapshot_date FROM (SELECT *, CAST(dense_rank() "
    "OVER (ORDER BY avg_rating DESC) AS INT) AS rank FROM m_performance_by_department WHERE rated_employees >= 5) WHERE rank <= 5",
    "m_performance_by_department",
)
for _mart in MARTS:
    oracle(_mart.view, f"m_{_mart.view}", f"SELECT * FROM m_{_mart.view}")

oracle(
    "attrition_from_dirty_feed", "silver", attrition_mart("department", "silver"))
oracle(
    "gold_headcount", "versions",
    f"""SELECT *, {rate('attrition_count', 'headcount')} AS attrition_rate, {SNAP} FROM (
    SELECT department, location, count(*) AS headcount, count(*) FILTER (is_active) AS active_headcount,
      count(*) FILTER (NOT is_active) AS attrition_count, {mean('base_salary')} AS avg_salary,
      round(sum(date_diff('day', hire_date, CASE WHEN is_active THEN DATE '{AS_OF}' ELSE hire_date + 100 END))
        / CAST(count(*) AS DOUBLE) / 365.0, 2) AS avg_tenure_years
    FROM versions WHERE is_current GROUP BY 1, 2)""")
_HISTORY = """SELECT employee_id, grade, base_salary, event_ts, event_ts AS valid_from,
    lead(event_ts) OVER (PARTITION BY employee_id ORDER BY event_ts) AS valid_to, is_current FROM versions"""
oracle("scd_current_flag", "versions", _HISTORY)
oracle("silver_hris_history", "versions", _HISTORY)
relation(
    "staff",
    "SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_mktsegment AS department, r_name AS location FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
oracle(
    "gold_attendance", "fct_attendance staff",
    f"""SELECT *, {rate('present_days', 'total_records')} AS attendance_rate, {SNAP} FROM (
    SELECT department, location, count(*) AS total_records, count(*) FILTER (status = 'present') AS present_days,
      count(*) FILTER (status = 'absent') AS absent_days, count(*) FILTER (status = 'leave') AS leave_days,
      count(*) FILTER (status = 'wfh') AS wfh_days, count(*) FILTER (is_late) AS late_count,
      {mean('hours_worked')} AS avg_hours_worked
    FROM fct_attendance LEFT JOIN staff USING (employee_id) GROUP BY 1, 2)""")
oracle(
    "gold_reviews", "fct_performance",
    f"""SELECT *, {rate('high_performers', 'reviews')} AS hp_share, {SNAP} FROM (
    SELECT c_mktsegment AS department, cycle, count(*) AS reviews, {half_up('sum(rating)', 'count(*)', 2)} AS avg_rating,
      count(*) FILTER (is_high_performer) AS high_performers, count(*) FILTER (promotion_flag) AS promotions,
      {mean('goals_met_pct')} AS avg_goals_met_pct, {total('bonus_amount')} AS total_bonus
    FROM fct_performance LEFT JOIN (orders JOIN customer ON o_custkey = c_custkey)
      ON employee_id = CAST(o_orderkey AS VARCHAR) GROUP BY 1, 2)""")
_stages = ", ".join(
    f"count(DISTINCT application_id) FILTER (stage = '{s}') AS {s}"
    for s in ("applied", "screen", "interview", "offer", "hired", "rejected"))
oracle(
    "gold_recruitment_funnel", "fct_recruitment",
    f"""SELECT *, CASE WHEN offer > 0 THEN {rate('hired', 'offer')} ELSE 0.0::DOUBLE END AS offer_to_hire_rate, {SNAP}
    FROM (SELECT department, source, {_stages} FROM fct_recruitment GROUP BY 1, 2)""")
oracle(
    "recruitment_funnel_long", "fct_recruitment",
    f"SELECT department, source, stage, count(DISTINCT application_id) AS applications, {mean('offer_amount')} AS avg_offer "
    "FROM fct_recruitment GROUP BY 1, 2, 3")

# -- cleaning -------------------------------------------------------------------------------------------------------------
for _key, _columns in {
    "clean_department": f"department, department_raw, department IN {_known} AS department_canonical",
    "clean_salary": "salary, salary_raw, salary IS NOT NULL AS salary_valid",
    "clean_date": "joining_date, joining_date_raw, joining_date IS NOT NULL AS joining_date_valid",
    "clean_flag": "attrition",
    "clean_country": "country",
    "clean_skills": "skills, skills_count",
    "clean_ranges": "performance_rating, experience_years",
}.items():
    oracle(_key, "parsed", f'SELECT employee_id, "offset", {_columns} FROM parsed')
oracle(
    "clean_trim", "feed",
    "SELECT employee_id, \"offset\", nullif(trim(name), '') AS name, nullif(trim(manager), '') AS manager, "
    "nullif(trim(country), '') AS country FROM feed")
oracle(
    "dedupe_latest", "feed",
    'SELECT employee_id, "offset", ingest_ts, salary FROM (SELECT *, row_number() OVER (PARTITION BY employee_id '
    'ORDER BY ingest_ts DESC, "offset" DESC) AS rn FROM feed) WHERE rn = 1')
oracle("silver_employees", "silver", "SELECT * FROM silver")
oracle("silver_incremental", "silver", "SELECT * FROM silver")
oracle("stream_silver_upsert", "silver", "SELECT * FROM silver")
_raw_checks = (
    ("raw_null_employee_id_pct", "count(*) FILTER (employee_id IS NULL)", 0.01),
    ("raw_duplicate_employee_id_ratio", "count(*) - count(DISTINCT employee_id) - CAST(bool_or(employee_id IS NULL) AS INT)", 0.25))
oracle("quality_report_raw", "feed", " UNION ALL ".join(
    f"SELECT '{name}' AS name, round(({part}) / CAST(count(*) AS DOUBLE), 9) AS value, {limit}::DOUBLE AS threshold, "
    f"({part}) / CAST(count(*) AS DOUBLE) <= {limit} AS passed, false AS blocking, count(*) AS total_rows FROM feed"
    for name, part, limit in _raw_checks))
oracle("silver_write_roundtrip", "silver", "SELECT * EXCLUDE (skills) FROM silver")
oracle("silver_attendance", "fct_attendance", "SELECT * FROM fct_attendance")
oracle("silver_performance", "fct_performance", "SELECT * FROM fct_performance")
oracle("silver_recruitment", "fct_recruitment", "SELECT * FROM fct_recruitment")
oracle(
    "dim_filter", "emp",
    "SELECT employee_id, department, salary FROM emp WHERE department IN ('BUILDING', 'MACHINERY')")
oracle("dim_options", "feed", "SELECT DISTINCT department FROM feed WHERE trim(department) <> ''")
_checks = {
    "null_employee_id_pct": ("count(*) FILTER (employee_id IS NULL) / CAST(count(*) AS DOUBLE)", 0.0, True),
    "duplicate_employee_id_ratio": ("1 - count(DISTINCT employee_id) / CAST(count(*) AS DOUBLE)", 0.0, True),
    "invalid_salary_pct": ("count(*) FILTER (NOT salary_valid) / CAST(count(*) AS DOUBLE)", 0.1, False),
    "invalid_joining_date_pct": ("count(*) FILTER (NOT joining_date_valid) / CAST(count(*) AS DOUBLE)", 0.1, False),
    "unknown_department_pct": ("count(*) FILTER (NOT department_canonical) / CAST(count(*) AS DOUBLE)", 0.05, False),
}
oracle(
    "dq_report", "silver",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, CAST({sql} AS DOUBLE) AS value, {limit}::DOUBLE AS threshold, ({sql}) <= {limit} AS passed, "
        f"{str(blocking).lower()} AS blocking, count(*) AS total_rows FROM silver"
        for n, (sql, limit, blocking) in _checks.items()))

# -- sources and sinks ----------------------------------------------------------------------------------------------------
_hours = "CASE WHEN event_type NOT IN ('signup', 'error') THEN value / 10 END"
_ok = "event_type <> 'error'"
_stamp = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
relation(
    "landed",
    f"""SELECT 'attendance' AS topic, CAST(event_id % 4 AS INT) AS partition, event_id AS "offset", ts AS kafka_ts,
    CAST(user_id AS VARCHAR) AS kafka_key,
    CASE WHEN {_ok} THEN '{{"attendance_id":' || event_id || ',"employee_id":' || user_id || ',"work_date":"'
      || strftime(ts, '%Y-%m-%d') || '","punch_in":"' || {_stamp} || '","hours_worked":'
      || CASE WHEN event_type = 'signup' THEN '"abc"' ELSE CAST(value / 10 AS VARCHAR) END || ',"status":"'
      || {case_of('event_type', b.STATUS_OF_EVENT)} || '","is_late":' || CAST(value > 100 AS VARCHAR)
      || ',"event_ts":"' || {_stamp} || '"}}'
      ELSE '{{broken ' || event_id END AS _raw,
    CASE WHEN {_ok} THEN CAST(event_id AS VARCHAR) END AS attendance_id,
    CASE WHEN {_ok} THEN CAST(user_id AS VARCHAR) END AS employee_id,
    CASE WHEN {_ok} THEN CAST(ts AS DATE) END AS work_date, CASE WHEN {_ok} THEN ts END AS punch_in,
    {_hours} AS hours_worked, CASE WHEN {_ok} THEN {case_of('event_type', b.STATUS_OF_EVENT)} END AS status,
    CASE WHEN {_ok} THEN value > 100 END AS is_late, CASE WHEN {_ok} THEN ts END AS event_ts,
    CAST(ts AS DATE) AS ingest_date FROM events""",
)
oracle("bronze_parse_attendance", "landed", "SELECT * FROM landed")
oracle(
    "stream_bronze_ingest", "landed",
    'SELECT ingest_date, count(*) AS rows, count(attendance_id) AS parsed_rows, CAST(sum("offset") AS BIGINT) AS offset_sum, '
    "CAST(sum(length(_raw)) AS BIGINT) AS raw_chars, (SELECT count(*) FROM events) AS input_rows FROM landed GROUP BY 1")
oracle(
    "bronze_incremental_since", "landed",
    'SELECT "offset", attendance_id, hours_worked, ingest_date FROM landed WHERE ingest_date >= DATE \'2024-01-16\'')
oracle(
    "bronze_offset_gaps", "landed",
    """SELECT topic, partition, "offset" + 1 AS gap_from, following - 1 AS gap_to, following - "offset" - 1 AS missing FROM (
    SELECT topic, partition, "offset", lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS following
    FROM (SELECT DISTINCT topic, partition, "offset" FROM landed JOIN events ON event_id = "offset" WHERE event_type <> 'error'))
    WHERE following > "offset" + 1""")
oracle(
    "bronze_replay", "landed",
    'SELECT partition, "offset", kafka_key, attendance_id, hours_worked, status, ingest_date FROM landed '
    'WHERE "offset" >= 100')
oracle(
    "bronze_audit", "landed",
    'SELECT topic, partition, "offset", kafka_key, attendance_id IS NOT NULL AS is_json, CASE WHEN attendance_id IS NOT NULL '
    "THEN _raw ELSE substr(_raw, 1, 200) END AS payload FROM landed WHERE partition = 2")
oracle(
    "bronze_parse_payload", "feed",
    "SELECT 'employee_csv' AS topic, employee_id AS kafka_key, employee_id, name, department, salary, joining_date, "
    "performance_rating, manager, attrition, country, array_to_string(skills, '|') AS skills, experience FROM feed")
oracle(
    "bronze_parse_performance", "reviews",
    "SELECT 'performance' AS topic, CAST(employee_id AS BIGINT) * 8 + rating AS \"offset\", review_id, employee_id, cycle, "
    "rating, promotion_flag, bonus_amount, CAST(event_ts AS DATE) AS event_date FROM reviews")
oracle(
    "bronze_parse_recruitment", "applications",
    'SELECT sequence AS "offset", application_id, source, stage, department, offer_amount, event_ts, '
    "CAST(event_ts AS DATE) AS ingest_date FROM applications")


def json_field(name: str, sql: str, text: bool) -> str:
    value = f"to_json({sql})" if text else f"CAST({sql} AS VARCHAR)"
    return f"'\"{name}\":' || coalesce(CAST({value} AS VARCHAR), 'null')"


_fields = ("employee_id name department salary joining_date performance_rating manager attrition country skills "
           "experience").split()
oracle(
    "publish_records", "feed",
    "SELECT employee_id AS key, '{' || " + " || ',' || ".join(
        json_field(c, c, c not in ("performance_rating", "experience")) for c in _fields) + " || '}' AS value FROM feed")
relation(
    "counted",
    """SELECT count(*) AS rows, count(department) AS departments, CAST(sum(length(salary)) AS BIGINT) AS salary_chars,
    CAST(sum(length(name)) AS BIGINT) AS name_chars, count(joining_date) AS dates,
    CAST(sum(coalesce(len(skills), 0)) AS BIGINT) AS skills, sum(experience) AS experience FROM feed""",
    "feed",
)
oracle(
    "scan_formats_roundtrip", "counted",
    # An empty CSV cell is a missing value; the other two formats keep empty text apart from null.
    "SELECT * REPLACE ((SELECT count(nullif(joining_date, '')) FROM feed) AS dates), 'csv' AS format FROM counted "
    "UNION ALL SELECT *, 'json' FROM counted UNION ALL SELECT *, 'parquet' FROM counted")
_ALL_MARTS = " ".join(f"m_{m.view}" for m in MARTS)
_COLUMNS = {
    "attrition_by_department": "department string, headcount bigint, attrited bigint, active bigint, attrition_rate double",
    "attrition_by_country": "country string, headcount bigint, attrited bigint, active bigint, attrition_rate double",
    "attrition_trend_by_cohort": "hire_year int, headcount bigint, attrited bigint, active bigint, attrition_rate double",
    "attrition_by_tenure_bucket":
        "tenure_bucket string, headcount bigint, attrited bigint, active bigint, attrition_rate double",
    "salary_by_department":
        "department string, employees_with_salary bigint, avg_salary double, median_salary double, p25_salary double, "
        "p75_salary double, p90_salary double, stddev_salary double, min_salary double, max_salary double, "
        "total_payroll double",
    "salary_top_paying_depts":
        "rank int, department string, avg_salary double, median_salary double, employees_with_salary bigint, "
        "total_payroll double",
    "salary_distribution":
        "employees_with_salary bigint, avg_salary double, median_salary double, p25_salary double, p75_salary double, "
        "p90_salary double, p95_salary double, p99_salary double, stddev_salary double, min_salary double, "
        "max_salary double, total_payroll double",
    "workforce_by_country": "country string, headcount bigint, active bigint, attrited bigint, active_pct double",
    "workforce_by_department": "department string, headcount bigint, active bigint, attrited bigint, active_pct double",
    "workforce_experience_distribution": "experience_bucket string, headcount bigint, share_pct double",
    "workforce_hiring_trends": "hire_year int, hire_month int, hires bigint, year_month string",
    "performance_by_department":
        "department string, rated_employees bigint, avg_rating double, high_performers bigint, low_performers bigint, "
        "high_performer_pct double, low_performer_pct double",
    "performance_top_teams":
        "rank int, department string, avg_rating double, rated_employees bigint, high_performer_pct double",
    "performance_vs_salary":
        "performance_rating int, employees bigint, avg_salary double, median_salary double, min_salary double, "
        "max_salary double",
}
oracle(
    "mart_catalog", _ALL_MARTS,
    " UNION ALL ".join(
        f"SELECT '{m.view}' AS view_name, '{m.domain}' AS domain, '{m.metric}' AS metric, "
        f"{_COLUMNS[m.view].count(',') + 2} AS column_count, "
        f"{lit(m.view + '(' + _COLUMNS[m.view] + ', snapshot_date date)')} AS signature, count(*) AS row_count "
        f"FROM m_{m.view}" for m in MARTS))
oracle(
    "mart_catalog_discovered", "emp m_attrition_by_country m_workforce_by_department",
    " UNION ALL ".join(
        f"SELECT '{m.view}' AS view_name, '{m.domain}' AS domain, '{m.metric}' AS metric, "
        f"{_COLUMNS[m.view].count(',') + 2} AS column_count, "
        f"{lit(m.view + '(' + _COLUMNS[m.view] + ', snapshot_date date)')} AS signature, count(*) AS row_count "
        f"FROM m_{m.view}" for m in MARTS if m.name in ("attrition/by_country", "workforce/by_department"))
    + " UNION ALL SELECT 'custom_people_by_place', 'custom', 'people_by_place', 3, "
    "'custom_people_by_place(department string, people bigint, country string)', count(*) FROM "
    "(SELECT DISTINCT country, department FROM emp)")
oracle(
    "gold_build_all", _ALL_MARTS,
    " UNION ALL ".join(
        f"SELECT '{m.name}' AS mart, count(*) AS rows, {_COLUMNS[m.view].count(',') + 2} AS columns, true AS passed, "
        f"'ok' AS detail, 'written' AS status FROM m_{m.view}" for m in MARTS))
oracle(
    "mart_validation", "m_attrition_by_department m_workforce_by_country",
    "SELECT 'attrition/by_department' AS mart, count(*) AS rows, 6 AS columns, true AS passed, 'ok' AS detail "
    "FROM m_attrition_by_department UNION ALL SELECT 'workforce/by_country', count(*), 6, false, 'too_few_rows=' || count(*) "
    "|| '<1000' FROM m_workforce_by_country UNION ALL SELECT 'workforce/no_rate', count(*), 5, false, "
    "'missing_columns=[''active_pct'']' FROM m_workforce_by_country UNION ALL SELECT 'workforce/empty', count(*), 6, false, "
    "'empty_mart' FROM m_workforce_by_country WHERE headcount < 0")

# -- reports --------------------------------------------------------------------------------------------------------------
_one = "(SELECT {} FROM m_salary_distribution)"
oracle(
    "overview_snapshot", "m_workforce_by_department m_salary_distribution m_performance_by_department",
    f"""SELECT CAST(sum(headcount) AS BIGINT) AS total_headcount, CAST(sum(active) AS BIGINT) AS total_active,
    CAST(sum(attrited) AS BIGINT) AS total_attrited, count(DISTINCT department) AS departments,
    {half_up('sum(attrited)', 'sum(headcount)', 6)} AS attrition_rate, {_one.format('avg_salary')} AS avg_salary,
    {_one.format('median_salary')} AS median_salary, {_one.format('total_payroll')} AS total_payroll,
    (SELECT round(sum(avg_rating * rated_employees) / sum(rated_employees), 6) FROM m_performance_by_department)
      AS avg_rating FROM m_workforce_by_department""")
oracle(
    "kpi_home", "m_workforce_by_department m_workforce_by_country m_salary_distribution",
    f"""SELECT CAST(sum(headcount) AS BIGINT) AS total_employees, count(DISTINCT department) AS departments,
    {half_up('sum(attrited) * 100', 'sum(headcount)', 2)} AS attrition_pct, CAST(sum(active) AS BIGINT) AS active,
    CAST(sum(attrited) AS BIGINT) AS attrited, (SELECT count(DISTINCT country) FROM m_workforce_by_country) AS countries,
    {_one.format('avg_salary')} AS avg_salary, {_one.format('total_payroll')} AS total_payroll
    FROM m_workforce_by_department""")
oracle(
    "kpi_workforce", "m_workforce_by_department m_workforce_by_country",
    """SELECT CAST(sum(headcount) AS BIGINT) AS headcount, CAST(sum(active) AS BIGINT) AS active,
    count(DISTINCT department) AS departments, (SELECT count(DISTINCT country) FROM m_workforce_by_country) AS countries
    FROM m_workforce_by_department WHERE department IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""")
oracle(
    "kpi_salary", "m_salary_distribution",
    "SELECT avg_salary, median_salary, p90_salary, total_payroll FROM m_salary_distribution")
oracle(
    "kpi_attrition", "m_attrition_by_department",
    f"""SELECT CAST(sum(headcount) AS BIGINT) AS headcount, CAST(sum(attrited) AS BIGINT) AS attrited,
    {half_up('sum(attrited) * 100', 'sum(headcount)', 2)} AS overall_rate_pct,
    first(department ORDER BY attrition_rate DESC, department) AS highest_department, max(attrition_rate) AS highest_rate,
    first(department ORDER BY attrition_rate, department) AS lowest_department, min(attrition_rate) AS lowest_rate
    FROM m_attrition_by_department""")
oracle(
    "kpi_performance", "m_performance_by_department",
    f"""SELECT CAST(sum(rated_employees) AS BIGINT) AS rated_employees,
    {half_up('sum(CAST(round(avg_rating * 100) AS BIGINT) * rated_employees)', 'sum(rated_employees) * 100', 2)} AS avg_rating,
    CAST(sum(high_performers) AS BIGINT) AS high_performers,
    {half_up('sum(high_performers) * 100', 'sum(rated_employees)', 2)} AS high_performer_pct,
    first(department ORDER BY avg_rating DESC, department) AS top_department, max(avg_rating) AS top_rating
    FROM m_performance_by_department""")
relation(
    "years", "SELECT hire_year, CAST(sum(hires) AS BIGINT) AS hires FROM m_workforce_hiring_trends GROUP BY 1",
    "m_workforce_hiring_trends")
oracle("hires_by_year", "years", "SELECT * FROM years")
oracle("governed_sql", "years", "SELECT *, false AS truncated FROM years")
_nth = "(SELECT {} FROM years ORDER BY hire_year DESC LIMIT 1 OFFSET {})"
relation(
    "pulse",
    f"""SELECT count(*) AS years, max(hire_year) AS latest_year, {_nth.format('hires', 0)} AS latest_hires,
    {_nth.format('hire_year', 1)} AS prior_year, {_nth.format('hires', 1)} AS prior_hires,
    CASE sign({_nth.format('hires', 0)} - {_nth.format('hires', 1)}) WHEN 1 THEN 'up' WHEN 0 THEN 'flat' ELSE 'down' END
      AS direction, first(hire_year ORDER BY hires DESC, hire_year) AS peak_year, max(hires) AS peak_hires,
    CAST(sum(hires) AS BIGINT) AS total_hires FROM years""",
    "years",
)
oracle("hiring_pulse", "pulse", "SELECT * FROM pulse")
relation(
    "gap",
    """SELECT count(*) AS ratings, min(performance_rating) AS low_rating, max(performance_rating) AS high_rating,
    first(avg_salary ORDER BY performance_rating) AS low_avg_salary,
    first(avg_salary ORDER BY performance_rating DESC) AS high_avg_salary FROM m_performance_vs_salary""",
    "m_performance_vs_salary",
)
oracle(
    "pay_for_performance_gap", "gap",
    """SELECT *, round(high_avg_salary - low_avg_salary, 2) AS gap,
    round((high_avg_salary - low_avg_salary) / low_avg_salary * 100, 4) AS gap_pct,
    CASE WHEN high_avg_salary > low_avg_salary THEN 'more' ELSE 'less' END AS direction FROM gap""")
oracle(
    "salary_spread_long", "m_salary_by_department",
    " UNION ALL ".join(
        f"SELECT department, '{p}' AS percentile, {p} AS salary FROM m_salary_by_department"
        for p in ("p25_salary", "median_salary", "p75_salary")))


def ends(table: str, label: str, metric: str, which=("top", "bottom")) -> str:
    parts = []
    for end in which:
        order = f"{metric} {'DESC NULLS LAST' if end == 'top' else 'ASC NULLS FIRST'}, {label} NULLS FIRST"
        parts.append(f"SELECT '{end}' AS \"end\", CAST(row_number() OVER (ORDER BY {order}) AS INT) AS place, {label}, "
                     f"{metric} FROM {table} QUALIFY place <= 3")
    return " UNION ALL ".join(f"({p})" for p in parts)


oracle("hotspots_attrition", "m_attrition_by_country", ends("m_attrition_by_country", "country", "attrition_rate"))
_PAID, _STAFFED = "m_salary_by_department", "m_workforce_by_department"
oracle(
    "gold_append_twice", f"{_PAID} m_salary_top_paying_depts {_STAFFED}",
    " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, DATE '{day}' AS snapshot_date, count(*) AS rows, {leader} AS leader FROM {table}"
        for day in (AS_OF, "2002-01-02")
        for mart, table, leader in (
            ("salary/by_department", _PAID, "arg_max(department, {'a': avg_salary, 'd': department})"),
            ("salary/top_paying_depts", "m_salary_top_paying_depts", "arg_max(department, {'a': avg_salary, 'd': department})"),
            ("workforce/by_department", _STAFFED, "max(department)"))))
oracle("hotspots_salary", "m_salary_by_department", ends("m_salary_by_department", "department", "avg_salary"))
oracle(
    "hotspots_talent", "m_performance_by_department",
    ends("m_performance_by_department", "department", "high_performer_pct", ("top",)))
_PROFILE = {
    "employee_id": ("string", "categorical"), "department": ("string", "categorical"), "salary": ("string", "categorical"),
    "joining_date": ("string", "date"), "performance_rating": ("double", "numeric"), "country": ("string", "categorical"),
    "attrition": ("string", "categorical"), "ingest_date": ("date", "date"),
}
oracle(
    "profile_columns", "feed",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{dtype}' AS dtype, '{kind}' AS class, count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, min(CAST({c} AS VARCHAR)) AS min_value, max(CAST({c} AS VARCHAR)) "
        "AS max_value FROM feed" for c, (dtype, kind) in _PROFILE.items()))
_feed_types = dict(field.split(" ") for field in STREAMS["employee_csv"].ddl.split(", "))
_feed_types |= {"offset": "bigint", "ingest_ts": "timestamp", "ingest_date": "date"}


def _profiled(c: str, kind: str) -> str:
    if kind == "array<string>":
        return f"CAST(to_json({c}) AS VARCHAR)"
    return f"CAST(\"{c}\" AS VARCHAR)"


def _class_of(c: str, kind: str) -> str:
    if "date" in c or kind in ("date", "timestamp"):
        return "date"
    return "numeric" if kind in ("double", "bigint") else "categorical"


oracle(
    "profile_columns_approx", "feed",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{kind}' AS dtype, '{_class_of(c, kind)}' AS class, count(*) AS rows, "
        f"count(*) - count(\"{c}\") AS nulls, min({_profiled(c, kind)}) AS min_value, max({_profiled(c, kind)}) AS max_value, "
        "true AS distinct_is_close FROM feed" for c, kind in _feed_types.items()))
_dataset = [("rows", "count(*)"), ("unique_employee_id", "count(DISTINCT employee_id)"),
            ("duplicate_rows", "count(*) - count(DISTINCT employee_id)"),
            *[(f"nulls_{c}", f"count(*) - count({c})") for c in _fields],
            ("distinct_department", "count(DISTINCT department)")]
oracle(
    "profile_dataset", "feed",
    " UNION ALL ".join(f"SELECT '{n}' AS measure, CAST({sql} AS BIGINT) AS value FROM feed" for n, sql in _dataset))


def money(v: str) -> str:
    v = f"CAST({v} AS DOUBLE)"
    return (f"coalesce('INR ' || CASE WHEN {v} >= 1e7 THEN format('{{:.2f}}', {v} / 1e7) || ' Cr' "
            f"WHEN {v} >= 1e5 THEN format('{{:.2f}}', {v} / 1e5) || ' L' ELSE format('{{:,.0f}}', {v}) END, 'n/a')")


def pct(v: str, digits: int = 1) -> str:
    return f"coalesce(format('{{:.{digits}f}}', CAST({v} AS DOUBLE) * 100) || '%', 'n/a')"


def grouped(v: str) -> str:
    return f"format('{{:,}}', CAST({v} AS BIGINT))"


def f2(v: str) -> str:
    return f"format('{{:.2f}}', CAST({v} AS DOUBLE))"


oracle(
    "fmt_money", "emp",
    f"SELECT employee_id, {money('salary')} AS salary_text, {money('salary * 100')} AS hundredfold_text, "
    f"{money('salary / 100')} AS hundredth_text, CAST(coalesce(performance_rating, 0) AS BIGINT) AS rating FROM emp")
oracle(
    "fmt_pct", "m_attrition_by_country",
    f"SELECT country, {pct('attrition_rate')} AS rate_text, {pct('attrition_rate', 2)} AS rate_text_2 "
    "FROM m_attrition_by_country")
oracle(
    "governed_query", "m_attrition_by_country",
    "SELECT country, headcount, attrited, attrition_rate, false AS truncated FROM m_attrition_by_country WHERE attrited > 0")
oracle(
    "result_summary", "m_attrition_by_department",
    "SELECT row_count, '[SQL] department=' || department || ', headcount=' || headcount || ', attrited=' || attrited || "
    "CASE WHEN row_count > 1 THEN ' (+' || (row_count - 1) || ' rows)' ELSE '' END AS summary FROM "
    "(SELECT *, count(*) OVER () AS row_count FROM m_attrition_by_department) ORDER BY attrition_rate DESC, department LIMIT 1")

# -- question and answer logs ---------------------------------------------------------------------------------------------


def filled(values) -> str:
    return f"replace({pick(values, 'o_orderkey')}, '{{dept}}', c_mktsegment)"


relation("staffed", "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey")
relation("statements", f"SELECT o_orderkey AS log_id, {filled(b.STATEMENTS)} AS sql FROM staffed", "staffed")
_stmt = r"regexp_replace(regexp_replace(sql, '^\s+|\s+$', '', 'g'), ';\s*$', '')"
_words = ", ".join(
    f"CASE WHEN regexp_matches(upper({_stmt}), '(^|[^A-Z_]){w}([^A-Z_]|$)') THEN '{w}' END" for w in BLOCKED_WORDS)
oracle(
    "audit_query_log", "statements",
    f"""SELECT *, NOT is_empty AND NOT too_long AND is_select AND NOT has_many_statements AND blocked_words = '' AS allowed
    FROM (SELECT log_id, sql, {_stmt} = '' AS is_empty, length(sql) > {MAX_SQL_CHARS} AS too_long,
      regexp_matches(upper({_stmt}), '^\\s*(SELECT|WITH)\\b') AS is_select, contains({_stmt}, ';') AS has_many_statements,
      array_to_string(list_sort(list_filter([{_words}], lambda w: w IS NOT NULL)), ',') AS blocked_words FROM statements)""")
relation("answers", f"SELECT o_orderkey AS log_id, {filled(b.ANSWERS)} AS answer FROM staffed", "staffed")
_blocks = r"regexp_extract_all(answer, '(?is)```(?:sql)?\s*(.+?)\s*```', 1)"
_lines = "list_filter(string_split(answer, chr(10)), lambda x: trim(x) <> '')"
_chatty = "(" + " OR ".join(
    f"starts_with(lower(coalesce({_lines}[1], '')), '{p}')" for p in ("here", "the sql", "this query")) + ")"
oracle(
    "extract_sql_blocks", "answers",
    rf"""SELECT *, contains(sql, 'CANNOT_ANSWER') AS cannot_answer FROM (SELECT log_id, answer,
    coalesce(regexp_replace(CASE WHEN len({_blocks}) > 0 THEN {_blocks}[-1]
      WHEN {_chatty} THEN array_to_string({_lines}[2:], chr(10)) ELSE array_to_string({_lines}, chr(10)) END,
      '^\s+|\s+$', '', 'g'), '') AS sql FROM answers)""")
relation(
    "questions",
    f"""SELECT 'o' || o_orderkey AS log_id, {filled(b.QUESTIONS)} AS question FROM staffed UNION ALL
    SELECT 'c' || conv_id || '-' || turn, text FROM conversations WHERE role = 'user'""",
    "staffed",
)
# Letters outside ASCII become 'x' before matching, which gives \b its Unicode meaning.
_q = r"regexp_replace(lower(regexp_replace(question, '^\s+|\s+$', '', 'g')), '[^\x00-\x7F]', 'x', 'g')"


def _score(intent: str) -> str:
    return " + ".join(
        f"CASE WHEN regexp_matches(q, {lit('(?i)' + rule)}) THEN {weight} ELSE 0 END"
        for rule, target, weight in INTENT_RULES if target == intent)


_scores = [f"score_{i.lower()}" for i in INTENTS]
_sum, _best = " + ".join(_scores), f"greatest({', '.join(_scores)})"
_winner = "CASE " + " ".join(f"WHEN {s} = {_best} THEN '{i}'" for i, s in zip(INTENTS, _scores)) + " END"
oracle(
    "classify_intents", "questions",
    f"""SELECT *, CASE WHEN confidence >= 0.75 OR (intent = 'OFFTOPIC' AND confidence >= 0.6) THEN 'accepted'
      ELSE 'needs_review' END AS decision, intent IN ('ANALYTICAL', 'HYBRID') AS needs_sql,
      intent IN ('SEMANTIC', 'HYBRID') AS needs_rag
    FROM (SELECT log_id, {', '.join(_scores)},
      CASE WHEN {_sum} > 0 THEN {_winner} WHEN on_topic THEN 'SEMANTIC' ELSE 'OFFTOPIC' END AS intent,
      CASE WHEN {_sum} > 0 THEN round({_best} / CAST({_sum} AS DOUBLE), 6) WHEN on_topic THEN 0.0::DOUBLE
           ELSE 0.6::DOUBLE END AS confidence
      FROM (SELECT log_id, {', '.join(f'{_score(i)} AS score_{i.lower()}' for i in INTENTS)},
        regexp_matches(q, {lit('|'.join(TOPIC_WORDS))}) AS on_topic FROM (SELECT log_id, {_q} AS q FROM questions)))""")
_views = ", ".join(f"('{m.view}')" for m in MARTS)
oracle(
    "resolve_table_refs", "staffed",
    f"""WITH refs AS (SELECT o_orderkey AS log_id, {filled(b.QUESTIONS)} AS question,
      {pick(b.TABLE_REFS, 'o_orderkey')} AS table_ref FROM staffed), views(view) AS (VALUES {_views}),
    scored AS (SELECT log_id, view, len(list_filter(string_split(substr(view, length(table_ref) + 2), '_'),
        lambda p: list_contains(regexp_extract_all(lower(question), '[a-z0-9]+'), p))) AS score
      FROM refs JOIN views ON starts_with(view, table_ref || '_')
      WHERE table_ref NOT IN (SELECT view FROM views)),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY score DESC, length(view), view) = 1)
    SELECT refs.*, CASE WHEN table_ref IN (SELECT view FROM views) THEN table_ref WHEN score > 0 THEN view END
      AS resolved_view, CAST(coalesce(score, 0) AS INT) AS score FROM refs LEFT JOIN best USING (log_id)""".replace(
        "WITH refs", "relations_end", 1).replace("relations_end", ", refs", 1))
ORACLES["resolve_table_refs"] = ORACLES["resolve_table_refs"].replace(")\n, refs AS", "),\nrefs AS", 1)
relation(
    "turns",
    """SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer_summary FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'""",
)
relation(
    "recent",
    "SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS INT) AS recency FROM turns", "turns")
oracle("conversation_last_n", "recent", "SELECT * FROM recent WHERE recency <= 6")


def side(c: str) -> str:
    return rf"substr(replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), chr(10), ' '), 1, 300)"


oracle(
    "conversation_context", "recent",
    f"""SELECT conv_id, CAST(count(*) AS INT) AS turns, 'Recent conversation:' || chr(10) || string_agg('  User: ' || {side('question')}
    || chr(10) || '  Assistant: ' || coalesce({side('answer_summary')}, ''), chr(10) ORDER BY turn) AS context
    FROM recent WHERE recency <= 3 GROUP BY 1""")

# -- retrieval ------------------------------------------------------------------------------------------------------------
relation(
    "queries",
    """SELECT label AS query_id, list(v ORDER BY pos) AS query_vector FROM (
    SELECT label, pos, avg(CAST(v AS DOUBLE)) AS v FROM (
      SELECT label, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings) GROUP BY 1, 2)
    GROUP BY 1""",
)


def top_k(k: int, where: str = "true", floor: float = 0.0) -> str:
    return f"""SELECT query_id, vec_id, greatest(0.0::DOUBLE, raw) AS similarity, CAST(rank AS INT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, vec_id) AS rank FROM (
      SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), query_vector), 9) AS raw
      FROM embeddings, queries WHERE {where})) WHERE rank <= {k} AND greatest(0.0, raw) >= {floor}"""


oracle("vector_topk_blocks", "", f"""WITH queries AS (
    SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS query_vector FROM embeddings WHERE vec_id % 50 = 0)
    SELECT * REPLACE (round(similarity, 6) AS similarity) FROM ({top_k(5)})""")
oracle("vector_topk", "queries", f"SELECT * REPLACE (round(similarity, 6) AS similarity) FROM ({top_k(5)})")
oracle(
    "vector_topk_filtered", "queries",
    f"SELECT * REPLACE (round(similarity, 6) AS similarity) FROM ({top_k(10, 'label = 3', 0.1)})")
oracle(
    "pack_context", "queries",
    f"""SELECT query_id, vec_id, rank, line, CAST(used_chars AS BIGINT) AS used_chars FROM (
    SELECT *, sum(length(line)) OVER (PARTITION BY query_id ORDER BY rank) AS used_chars FROM (
      SELECT *, '- [' || vec_id || ' | sim=' || {f2('similarity')} || '] ' || coalesce(text, '') AS line
      FROM ({top_k(10)}) LEFT JOIN documents ON doc_id = vec_id)) WHERE used_chars <= 6000""")
oracle(
    "chunk_upsert", "",
    """SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN source ELSE source || '-' || quality END AS source, lang,
    CASE WHEN l.doc_id IS NULL THEN n_chars ELSE n_chars + 1 END AS n_chars
    FROM documents LEFT JOIN (SELECT doc_id AS label_id, doc_id, quality FROM labels) l USING (doc_id)""".replace(
        "l.doc_id IS NULL", "label_id IS NULL"))
oracle(
    "chunk_delete_where", "",
    "SELECT doc_id, source, lang, n_chars FROM documents WHERE (lang = 'en' AND source = 'src1') IS NOT TRUE")

# -- hashed terms ---------------------------------------------------------------------------------------------------------
def hashed(ident: str, text: str, source: str) -> str:
    """(id, vector): counts of terms at their hashed places, scaled to length one, as single precision like the engine's."""
    return f"""SELECT id, list(coalesce(n, 0) / CAST(greatest(length, 1e-300) AS DOUBLE) ORDER BY place) AS raw FROM (
    SELECT id, place, n, sqrt(sum(coalesce(n * n, 0)) OVER (PARTITION BY id)) AS length FROM (
      SELECT id, place FROM (SELECT {ident} AS id FROM {source}), (SELECT unnest(range({DIMENSIONS})) AS place))
    LEFT JOIN (SELECT id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {DIMENSIONS} AS place, count(*) AS n FROM (
      SELECT {ident} AS id, unnest(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM {source})
      WHERE word <> '' GROUP BY 1, 2) USING (id, place)) GROUP BY 1"""


def hashed_top_k(corpus: str, asked: str, k: int = 5) -> str:
    """(query_id, id, similarity, rank) over two relations of :func:`hashed`."""
    return f"""SELECT query_id, id, greatest(0.0::DOUBLE, raw) AS similarity, CAST(rank AS INT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, id) AS rank FROM (
      SELECT q.id AS query_id, c.id AS id, round(coalesce(CASE WHEN isfinite(s) THEN s END, 0), 9) AS raw FROM (
        SELECT q, c, list_cosine_similarity(q.raw::FLOAT[]::DOUBLE[], c.raw::FLOAT[]::DOUBLE[]) AS s
        FROM ({asked}) q, ({corpus}) c))) WHERE rank <= {k}"""


_DOCUMENT_VECTORS = hashed("doc_id", "text", "documents")
oracle("embed_text", "", f"""SELECT doc_id, CAST({DIMENSIONS} AS INT) AS dimensions, CAST(place - 1 AS INT) AS place,
    round(CAST(CAST(value AS FLOAT) AS DOUBLE), 6) AS value FROM (
    SELECT id AS doc_id, unnest(raw) AS value, generate_subscripts(raw, 1) AS place FROM ({_DOCUMENT_VECTORS})) WHERE value <> 0""")
oracle("document_search", "", f"""SELECT query_id, id AS doc_id, similarity, rank FROM (
    {hashed_top_k(_DOCUMENT_VECTORS, hashed('item_id', 'text', 'benchmark'))})""")

# -- insights -------------------------------------------------------------------------------------------------------------
_NONE = "coalesce({}, 'None')"


def chunk(domain: str, metric: str, chunk_id: str, text: str, source: str, kind: str | None) -> str:
    return (f"SELECT substr(replace({chunk_id}, ' ', '_'), 1, 512) AS chunk_id, {text} AS text, '{domain}' AS domain, "
            f"'{metric}' AS metric, 'gold/{domain}/{metric}' AS source_mart, "
            f"{lit(kind) if kind else 'CAST(NULL AS VARCHAR)'} AS kind, '{AS_OF}' AS snapshot_date FROM {source}")


def row_chunk(domain: str, metric: str, key: str, text: str, source: str | None = None) -> str:
    return chunk(domain, metric, f"'{domain}.{metric}.' || {key}", text, source or f"m_{domain}_{metric}", None)


def named(label: str, column: str) -> str:
    return f"'{label}=' || coalesce(CAST({column} AS VARCHAR), 'None')"


_dept = _NONE.format("department")
_ROWS = [
    row_chunk("attrition", "by_department", named("dept", "department"),
              f"'In the ' || {_dept} || ' department, total headcount is ' || headcount || ' employees, with ' || attrited "
              "|| ' who have left and ' || active || ' still active. The attrition rate is ' || "
              f"{pct('attrition_rate')} || '.'"),
    row_chunk("attrition", "by_country", named("country", "country"),
              "'In ' || country || ', headcount is ' || headcount || ' with ' || attrited || ' attritions, giving an "
              f"attrition rate of ' || {pct('attrition_rate')} || '.'"),
    row_chunk("attrition", "trend_by_cohort", named("year", "hire_year"),
              "'Employees who joined in ' || hire_year || ': ' || headcount || ' hired, ' || attrited || ' have since left "
              f"(attrition rate ' || {pct('attrition_rate')} || ').'"),
    row_chunk("attrition", "by_tenure_bucket", named("bucket", "tenure_bucket"),
              "'For employees with ' || tenure_bucket || ' of tenure, headcount is ' || headcount || ' and attrition rate "
              f"is ' || {pct('attrition_rate')} || '.'"),
    row_chunk("salary", "by_department", named("dept", "department"),
              f"'Salary in the ' || {_dept} || ' department: average ' || {money('avg_salary')} || ', median ' || "
              f"{money('median_salary')} || ', P25 ' || {money('p25_salary')} || ', P75 ' || {money('p75_salary')} || "
              f"', P90 ' || {money('p90_salary')} || ', standard deviation ' || {money('stddev_salary')} || "
              f"'. Total payroll is ' || {money('total_payroll')} || ' across ' || employees_with_salary || "
              "' employees with recorded salaries.'"),
    row_chunk("salary", "top_paying_depts", f"{named('dept', 'department')} || '.' || {named('rank', 'rank')}",
              f"'Rank #' || rank || ': ' || {_dept} || ' pays an average of ' || {money('avg_salary')} || ' (median ' || "
              f"{money('median_salary')} || ') across ' || employees_with_salary || ' employees, with total payroll of ' || "
              f"{money('total_payroll')} || '.'"),
    row_chunk("workforce", "by_country", named("country", "country"),
              "'Workforce in ' || country || ': total ' || headcount || ' (' || active || ' active, ' || attrited || "
              f"' attrited; ' || {pct('active_pct')} || ' active).'"),
    row_chunk("workforce", "by_department", named("dept", "department"),
              "'The ' || department || ' department has ' || headcount || ' employees: ' || active || ' active and ' || "
              f"attrited || ' attrited (' || {pct('active_pct')} || ' active rate).'"),
    row_chunk("workforce", "experience_distribution", named("bucket", "experience_bucket"),
              "'In the ' || experience_bucket || ' experience band, headcount is ' || headcount || ', representing ' || "
              f"{pct('share_pct')} || ' of the workforce.'"),
    row_chunk("workforce", "hiring_trends", named("year", "hire_year"),
              "'In ' || hire_year || ', the company made ' || hires || ' hires.'", "years"),
    row_chunk("performance", "by_department", named("dept", "department"),
              f"'Performance ratings in ' || {_dept} || ': average rating ' || {f2('avg_rating')} || '/5 across ' || "
              "rated_employees || ' rated employees. High performers (rating >= 4): ' || high_performers || ' (' || "
              f"{pct('high_performer_pct')} || '). Low performers (rating <= 2): ' || low_performers || ' (' || "
              f"{pct('low_performer_pct')} || ').'"),
    row_chunk("performance", "top_teams", f"{named('dept', 'department')} || '.' || {named('rank', 'rank')}",
              f"'Top-performing team #' || rank || ': ' || {_dept} || ' with average rating ' || {f2('avg_rating')} || "
              f"'/5 across ' || rated_employees || ' employees, ' || {pct('high_performer_pct')} || "
              "' high-performer share.'"),
    row_chunk("performance", "vs_salary", named("rating", "performance_rating"),
              "'Employees with performance rating ' || performance_rating || ': ' || employees || ' people, average salary ' "
              f"|| {money('avg_salary')} || ' (median ' || {money('median_salary')} || ', min ' || {money('min_salary')} || "
              f"', max ' || {money('max_salary')} || ').'"),
]
oracle("insight_rows", _ALL_MARTS + " years", " UNION ALL ".join(_ROWS))


def listed(table: str, item: str, order: str, sep: str, n: int | None = None, shown: str | None = None) -> str:
    """Items of the first ``n`` rows in ``order``, joined in ``shown`` order."""
    inner = f"SELECT *, row_number() OVER (ORDER BY {order}) AS pos FROM {table}"
    keep = f" WHERE pos <= {n}" if n else ""
    return f"(SELECT string_agg({item}, '{sep}' ORDER BY {shown or 'pos'}) FROM ({inner}){keep})"


def summary(domain: str, metric: str, text: str, source: str | None = None, tail: str = ".summary") -> str:
    return chunk(domain, metric, f"'{domain}.{metric}{tail}'", text, source or "(SELECT 1)", "summary")


def _ratio_item(label: str) -> str:
    return f"{_NONE.format(label)} || ' (' || {pct('attrition_rate')} || ')'"


def _agg(table: str, sql: str) -> str:
    return f"(SELECT {sql} FROM {table})"


_DOWN = "attrition_rate DESC, department ASC"
_AD, _AC, _WD, _WC = (f"m_{n}" for n in (
    "attrition_by_department", "attrition_by_country", "workforce_by_department", "workforce_by_country"))
_SD, _PD = "m_salary_by_department", "m_performance_by_department"
_pay_item = f"{_dept} || ' ' || {money('avg_salary')}"
_rate_item = f"{_dept} || ' ' || {f2('avg_rating')}"
_board = f"'#' || rank || ' ' || {_dept}"
_nulls = "department ASC NULLS FIRST"
_SUMMARIES = [
    summary("attrition", "by_department",
            f"'Across ' || {_agg(_AD, 'count(*)')} || ' departments, the overall attrition rate is ' || "
            f"{pct(_agg(_AD, 'sum(attrited) / CAST(sum(headcount) AS DOUBLE)'))} || ' (' || "
            f"{grouped(_agg(_AD, 'sum(attrited)'))} || ' employees left out of ' || {grouped(_agg(_AD, 'sum(headcount)'))} || "
            f"'). The departments with the highest attrition are ' || {listed(_AD, _ratio_item('department'), _DOWN, ', ', 3)}"
            " || '. The departments with the lowest attrition are ' || "
            f"{listed(_AD, _ratio_item('department'), 'attrition_rate ASC, department DESC', ', ', 3, 'pos DESC')} || '.'"),
    summary("attrition", "by_country",
            f"'Geographic attrition concentration: ' || "
            f"{listed(_AC, 'country || chr(32) || ' + pct('attrition_rate'), 'attrition_rate DESC, country', '; ', 3)} || "
            f"'. Workforce spans ' || {_agg(_AC, 'count(*)')} || ' countries.'"),
    summary("attrition", "trend_by_cohort",
            "'Hire-cohort attrition trend: the cohorts with the highest churn are ' || "
            + listed("m_attrition_trend_by_cohort", _ratio_item("CAST(hire_year AS VARCHAR)"),
                     "attrition_rate DESC, hire_year", ", ", 2)
            + " || '. Coverage spans ' || (SELECT min(hire_year) || '-' || max(hire_year) "
              "FROM m_attrition_trend_by_cohort) || '.'"),
    summary("attrition", "by_tenure_bucket",
            "'Attrition by tenure: the highest-churn tenure bucket is ' || "
            + listed("m_attrition_by_tenure_bucket", _ratio_item("tenure_bucket"), "attrition_rate DESC, tenure_bucket", "", 1)
            + " || '. Tenure analysis can guide retention investments at specific career stages.'"),
    summary("salary", "by_department",
            f"'Across ' || {_agg(_SD, 'count(*)')} || ' departments, top-paying are: ' || "
            f"{listed(_SD, _pay_item, 'avg_salary DESC, ' + _nulls, '; ', 3)} || '. Lowest-paying are: ' || "
            f"{listed(_SD, _pay_item, 'avg_salary ASC, ' + _nulls, '; ', 3)} || "
            f"'. Total company payroll across departments: ' || {money(_agg(_SD, 'sum(total_payroll)'))} || '.'"),
    summary("salary", "top_paying_depts",
            "'Top-paying departments leaderboard: ' || "
            + listed("m_salary_top_paying_depts", _board, "rank, " + _nulls, " > ") + " || '.'"),
    summary("salary", "distribution",
            "'Company-wide salary distribution: average ' || " + money("avg_salary") + "".join(
                f" || ', {label} ' || {money(column)}" for label, column in (
                    ("median", "median_salary"), ("P25", "p25_salary"), ("P75", "p75_salary"), ("P90", "p90_salary"),
                    ("P95", "p95_salary"), ("P99", "p99_salary"), ("min", "min_salary"), ("max", "max_salary"),
                    ("stddev", "stddev_salary")))
            + f" || '. Total payroll ' || {money('total_payroll')} || ' across ' || employees_with_salary || ' employees.'",
            "m_salary_distribution"),
    summary("workforce", "by_country",
            f"'Workforce spans ' || {_agg(_WC, 'count(*)')} || ' countries with total headcount of ' || "
            f"{_agg(_WC, 'CAST(sum(headcount) AS BIGINT)')} || '. Largest geographies: ' || "
            + listed(_WC, "country || ' (' || headcount || ')'", "headcount DESC, country", "; ", 3) + " || '.'"),
    summary("workforce", "by_department",
            f"'Departments by headcount across ' || {_agg(_WD, 'count(*)')} || ' departments. Largest: ' || "
            + listed(_WD, "department || ' (' || headcount || ')'", "headcount DESC, department", "; ", 3)
            + f" || '. Total active workforce: ' || {_agg(_WD, 'CAST(sum(active) AS BIGINT)')} || '.'"),
    summary("workforce", "experience_distribution",
            "'Seniority pyramid: ' || " + listed(
                "m_workforce_experience_distribution",
                f"experience_bucket || ' ' || headcount || ' (' || {pct('share_pct')} || ')'",
                "list_position(['0-2y', '2-5y', '5-10y', '10-20y', '20y+'], experience_bucket)", " | ")),
    summary("workforce", "hiring_trends",
            "'Hiring trend across ' || years || ' years. Peak year: ' || peak_year || ' with ' || peak_hires || "
            "' hires. Latest year (' || latest_year || '): ' || latest_hires || ' hires, ' || direction || ' from ' || "
            "prior_hires || ' the year before.'", "pulse"),
    summary("performance", "by_department",
            f"'Performance leaderboard across ' || {_agg(_PD, 'count(*)')} || ' departments. Top-rated: ' || "
            f"{listed(_PD, _rate_item, 'avg_rating DESC, ' + _nulls, '; ', 3)} || '. Lowest-rated: ' || "
            f"{listed(_PD, _rate_item, 'avg_rating ASC, ' + _nulls, '; ', 3)} || '.'"),
    summary("performance", "top_teams",
            "'Top-performing teams: ' || " + listed("m_performance_top_teams", _board, "rank, " + _nulls, " > ") + " || '.'"),
    summary("performance", "vs_salary",
            "'Pay-for-performance signal: rating-' || high_rating || ' employees earn an average of ' || "
            f"{money('high_avg_salary')} || ', vs rating-' || low_rating || ' at ' || {money('low_avg_salary')} || "
            f"' -- top performers earn ' || {money('abs(high_avg_salary - low_avg_salary)')} || ' ' || "
            "CASE WHEN high_avg_salary > low_avg_salary THEN 'more' ELSE 'less' END || ' on average (' || "
            "CASE WHEN high_avg_salary >= low_avg_salary THEN '+' ELSE '' END || "
            "format('{:.1f}', (high_avg_salary - low_avg_salary) / low_avg_salary * 100) || '%).'", "gap"),
]
oracle("insight_summaries", _ALL_MARTS + " pulse gap", " UNION ALL ".join(_SUMMARIES))
_OVERVIEW = [
    summary("overview", "company_snapshot",
            "'Company snapshot: total workforce of ' || hc || ' employees (' || ac || ' active, ' || gone || "
            "' attrited) across ' || nd || ' departments. Overall attrition rate is ' || "
            f"{pct('gone / CAST(hc AS DOUBLE)')} || '. Average salary is ' || {money(_one.format('avg_salary'))} || "
            f"', median ' || {money(_one.format('median_salary'))} || ', total payroll ' || "
            f"{money(_one.format('total_payroll'))} || '. Average performance rating across all rated employees is ' || "
            + f2(_agg(_PD, "sum(avg_rating * rated_employees) / sum(rated_employees)"))
            + " || '/5. This snapshot can be used to answer high-level questions about size, attrition, compensation, "
              "and performance.'",
            "(SELECT CAST(sum(headcount) AS BIGINT) AS hc, CAST(sum(active) AS BIGINT) AS ac, "
            f"CAST(sum(attrited) AS BIGINT) AS gone, count(DISTINCT department) AS nd FROM {_WD})", ""),
    summary("overview", "hiring_pulse",
            "'Hiring pulse: ' || latest_hires || ' hires in ' || latest_year || ', vs ' || prior_hires || ' in ' || "
            "prior_year || '. Total cumulative hires recorded: ' || total_hires || '.'", "pulse", ""),
    summary("overview", "attrition_hotspots",
            "'Highest-attrition departments to watch: ' || "
            + listed(_AD, f"department || ' (' || {pct('attrition_rate')} || ', ' || attrited || '/' || headcount || ')'",
                     _DOWN, "; ", 3) + " || '. These are the priority areas for retention investment.'", tail=""),
    summary("overview", "compensation_leaders",
            "'Highest-paying departments: ' || "
            + listed(_SD, f"{_dept} || ' (avg ' || {money('avg_salary')} || ')'", "avg_salary DESC, " + _nulls, "; ", 3)
            + " || '.'", tail=""),
    summary("overview", "talent_density",
            "'Highest concentration of high performers (rating >= 4): ' || "
            + listed(_PD, f"{_dept} || ' (' || {pct('high_performer_pct')} || ' of ' || rated_employees || ' rated)'",
                     "high_performer_pct DESC, " + _nulls, "; ", 3)
            + " || '. These departments have the strongest talent density.'", tail=""),
]
oracle("insight_overview", _ALL_MARTS + " pulse", " UNION ALL ".join(_OVERVIEW))
oracle(
    "insight_chunks", _ALL_MARTS + " years pulse gap",
    "SELECT domain, metric, count(*) AS chunks, count(kind) AS summaries, count(DISTINCT chunk_id) AS ids FROM ("
    + " UNION ALL ".join(_ROWS + _SUMMARIES + _OVERVIEW) + ") GROUP BY 1, 2")
_EXTRAS = {  # chunk rows and the fields that their metadata has, by mart
    "attrition_by_department": "department attrition_rate headcount", "attrition_by_country": "country attrition_rate headcount",
    "attrition_trend_by_cohort": "hire_year attrition_rate", "attrition_by_tenure_bucket": "tenure_bucket attrition_rate",
    "salary_by_department": "department avg_salary total_payroll", "salary_top_paying_depts": "rank department avg_salary",
    "workforce_by_country": "country headcount", "workforce_by_department": "department headcount",
    "workforce_experience_distribution": "experience_bucket headcount", "workforce_hiring_trends": "hire_year hires",
    "performance_by_department": "department avg_rating rated_employees", "performance_top_teams": "rank department avg_rating",
    "performance_vs_salary": "performance_rating avg_salary"}


def entries(chunk: str, fields: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {chunk} AS chunk_id, '{f}' AS field, CAST({f} AS VARCHAR) AS entry FROM {source}" for f in fields.split())


def _row_entries(sql: str) -> str:
    """Entries of a row chunk: its id expression is what precedes `` AS chunk_id``, its mart what follows the last FROM."""
    source = sql.rsplit(" FROM ", 1)[1]
    domain, metric = sql.split(" AS domain")[0].rsplit("'", 2)[1], sql.split(" AS metric")[0].rsplit("'", 2)[1]
    return entries(sql.split(" AS chunk_id")[0].removeprefix("SELECT "), _EXTRAS[f"{domain}_{metric}"], source)


oracle("insight_metadata", _ALL_MARTS + " years", f"""SELECT chunk_id, field,
    CASE WHEN try_cast(entry AS DOUBLE) IS NULL THEN entry END AS entry, round(try_cast(entry AS DOUBLE), 6) AS number FROM (
    {' UNION ALL '.join(map(_row_entries, _ROWS))} UNION ALL
    {entries("'salary.distribution.summary'", 'avg_salary', 'm_salary_distribution')} UNION ALL
    {entries("'overview.company_snapshot'", 'total_headcount attrition_rate',
             f"(SELECT sum(headcount) AS total_headcount, sum(attrited) / CAST(sum(headcount) AS DOUBLE) AS attrition_rate FROM {_WD})")})""")


def searched(scope: str, where: str) -> str:
    hits = hashed_top_k(hashed("chunk_id", "text", f"(SELECT * FROM chunks WHERE {where})"), "SELECT * FROM asked")
    return f"""SELECT '{scope}' AS scope, query_id AS question_id, rank, chunk_id, similarity, line,
    CAST(sum(length(line)) OVER (PARTITION BY query_id ORDER BY rank) AS BIGINT) AS used_chars FROM (
    SELECT query_id, rank, id AS chunk_id, similarity,
      '- [' || id || ' | sim=' || {f2('similarity')} || '] ' || text AS line
    FROM ({hits}) JOIN chunks ON chunk_id = id)"""


_QUESTIONS = hashed("conv_id || '.' || turn", "text", "conversations")
oracle("insight_search", _ALL_MARTS + " years pulse gap", f"""SELECT * FROM (
    WITH chunks AS MATERIALIZED ({' UNION ALL '.join(_ROWS + _SUMMARIES + _OVERVIEW)}), asked AS MATERIALIZED ({_QUESTIONS})
    {searched('attrition', "domain = 'attrition'")} UNION ALL
    {searched('pay_summary', "domain = 'salary' AND kind = 'summary'")}) WHERE used_chars <= 600""")
oracle(
    "lake_health", _ALL_MARTS + " years",
    " UNION ALL ".join(
        f"SELECT '{m.name}' AS artefact, true AS present, count(*) AS row_count, DATE '{AS_OF}' AS newest, true AS ready "
        f"FROM m_{m.view}" for m in MARTS)
    + f" UNION ALL SELECT 'insight_chunks', true, count(*), DATE '{AS_OF}', true FROM ({' UNION ALL '.join(_ROWS)})")
_POINTS = (("median", 0.5), ("p25", 0.25), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))
oracle("line_item_quantiles", "", " UNION ALL ".join(
    f"SELECT '{m}' AS measure, l_returnflag, l_linestatus, "
    + ", ".join(f"quantile_disc({m}, {p})::DOUBLE AS {name}" for name, p in _POINTS) + " FROM lineitem GROUP BY 2, 3"
    for m in ("l_extendedprice", "l_quantity")))
