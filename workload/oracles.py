"""Each registered query once more, as plain SQL for the oracle engine.

The texts are written from the rules, not from the Spark plans: layers as CTEs, one CTE per table and scenario.
"""

from __future__ import annotations

from strataudit.plans.reports import FIX_PLAYBOOK
from workload import history as W
from workload.domain import RAW_CUSTOMERS_SQL, RAW_LOANS_SQL, RAW_SUPPLY_SQL, SCENARIOS, SOURCES
from workload.queries import DRAFT_ROOTS_SQL, DRAFTS_SQL, NOTES_SQL

NUMERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def number(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, '{NUMERAL}') THEN try_cast(trim({e}) AS double) END"


BAND = """CASE WHEN credit_score IS NULL THEN 'UNKNOWN' WHEN credit_score >= 740 THEN 'PRIME'
  WHEN credit_score >= 670 THEN 'NEAR_PRIME' ELSE 'SUBPRIME' END"""
LOAN_FIELDS = ("loan_id, customer_id, loan_type, source_system, principal, balance, interest_rate, term_months, "
               "status, origination_date")


def layers(scenario: str = "clean") -> str:
    """CTEs raw_customers, raw_loans, stg_customers, stg_loans, portfolio."""
    score = "CASE WHEN cast(customer_id AS bigint) % 100 < 35 THEN NULL ELSE credit_score END" \
        if scenario == "null_spike" else "credit_score"
    text = "CASE WHEN source_system = 'CORE_BANKING' THEN format('${:,.2f}', balance) ELSE printf('%.2f', balance) END"
    balance = text if scenario == "type_change" else "balance"
    staged_balance = number("balance") if scenario == "type_change" else "balance"
    key = "CASE WHEN source_system = 'CARD_PLATFORM' THEN cast(cast(customer_id AS bigint) AS varchar) ELSE customer_id END" \
        if scenario == "dropped_join_key" else "customer_id"
    again = "UNION ALL SELECT * FROM once WHERE origination_date >= DATE '2001-08-01' - 365" \
        if scenario == "duplicate_rows" else ""
    return f"""
raw_customers AS (SELECT customer_id, full_name, state, {score} AS credit_score, annual_income
  FROM ({RAW_CUSTOMERS_SQL})),
raw_loans AS (SELECT loan_id, customer_id, loan_type, source_system, principal, {balance} AS balance, interest_rate,
  term_months, status, origination_date FROM ({RAW_LOANS_SQL})),
stg_customers AS (SELECT {strip('customer_id')} AS customer_id, {strip('full_name')} AS full_name,
  upper({strip('state')}) AS state, credit_score, annual_income FROM raw_customers
  QUALIFY row_number() OVER (PARTITION BY {strip('customer_id')} ORDER BY full_name) = 1),
cleaned AS (SELECT loan_id, {strip('customer_id')} AS customer_id, loan_type, source_system, principal,
  {staged_balance} AS balance, interest_rate, term_months, upper({strip('status')}) AS status, origination_date
  FROM raw_loans),
once AS (SELECT loan_id, {key} AS customer_id, loan_type, source_system, principal, balance, interest_rate,
  term_months, status, origination_date FROM cleaned WHERE status IS NULL OR status <> 'WITHDRAWN'
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY cleaned.customer_id) = 1),
stg_loans AS (SELECT * FROM once {again}),
portfolio AS (SELECT l.loan_id, l.customer_id, c.state, c.credit_score, {BAND} AS risk_band, l.loan_type,
  l.source_system, l.principal, l.balance, l.interest_rate, l.term_months, l.status,
  l.status IN ('DELINQUENT_30', 'DELINQUENT_90', 'DEFAULT') AS is_delinquent,
  cast(l.origination_date AS date) AS origination_date
  FROM stg_loans l JOIN stg_customers c ON l.customer_id = c.customer_id)"""


def over(scenario: str, text: str) -> str:
    return f"WITH {layers(scenario)}\n{text}"


# ---------------------------------------------------------------- profiles

CUSTOMER_TYPES = {"customer_id": "VARCHAR", "full_name": "VARCHAR", "state": "VARCHAR", "credit_score": "BIGINT",
                  "annual_income": "DOUBLE"}
LOAN_TYPES = {"loan_id": "VARCHAR", "customer_id": "VARCHAR", "loan_type": "VARCHAR", "source_system": "VARCHAR",
              "principal": "DOUBLE", "balance": "DOUBLE", "interest_rate": "DOUBLE", "term_months": "BIGINT",
              "status": "VARCHAR", "origination_date": "TIMESTAMP"}
PORTFOLIO_TYPES = {"loan_id": "VARCHAR", "customer_id": "VARCHAR", "state": "VARCHAR", "credit_score": "BIGINT",
                   "risk_band": "VARCHAR", "loan_type": "VARCHAR", "source_system": "VARCHAR", "principal": "DOUBLE",
                   "balance": "DOUBLE", "interest_rate": "DOUBLE", "term_months": "BIGINT", "status": "VARCHAR",
                   "is_delinquent": "BOOLEAN", "origination_date": "DATE"}
LINEITEM_TYPES = {"l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER",
                  "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
                  "l_returnflag": "VARCHAR", "l_linestatus": "VARCHAR", "l_shipdate": "TIMESTAMP"}
# table -> (relation, arrived types, contract types, key, transition, upstream)
TABLES = {
    "raw.customers": ("raw_customers", CUSTOMER_TYPES, "customer_id", "source->raw"),
    "raw.loans": ("raw_loans", LOAN_TYPES, "loan_id", "source->raw"),
    "staging.customers": ("stg_customers", CUSTOMER_TYPES, "customer_id", "raw->staging"),
    "staging.loans": ("stg_loans", LOAN_TYPES, "loan_id", "raw->staging"),
    "final.loan_portfolio": ("portfolio", PORTFOLIO_TYPES, "loan_id", "staging->final"),
}


def arrived(table: str, types: dict[str, str], scenario: str) -> dict[str, str]:
    return types | {"balance": "VARCHAR"} if table == "raw.loans" and scenario == "type_change" else types


def profile(table: str, relation: str, types: dict[str, str], key: str) -> list[str]:
    out = []
    for i, (c, t) in enumerate(types.items()):
        numeric, dated = t in ("DOUBLE", "BIGINT", "INTEGER"), t in ("DATE", "TIMESTAMP")
        low, high, total = (f"cast({f}({c}) AS double)" if numeric else "cast(NULL AS double)" for f in ("min", "max", "sum"))
        low_text, high_text = (f"cast({f}({c}) AS varchar)" if dated else "cast(NULL AS varchar)" for f in ("min", "max"))
        out.append(f"""SELECT '{table}' AS "table", {i} AS column_idx, '{c}' AS "column", '{t}' AS dtype,
  count(*) AS row_count, count(*) - count({c}) AS null_count,
  CASE WHEN count(*) = 0 THEN 0.0::double ELSE round(100.0::double * (count(*) - count({c})) / count(*), 2) END AS null_pct,
  count(DISTINCT {c}) AS distinct_count, {low} AS min_value, {high} AS max_value, round({total}, 2) AS sum_value,
  {low_text} AS min_text, {high_text} AS max_text, count(*) - count(DISTINCT {key}) AS duplicate_keys FROM {relation}""")
    return out


def all_profiles(scenario: str) -> str:
    parts = [p for name, (rel, types, key, _) in TABLES.items()
             for p in profile(name, rel, arrived(name, types, scenario), key)]
    return "\nUNION ALL\n".join(parts)


RAW_LOANS_PROFILE = "\nUNION ALL\n".join(profile("raw.loans", "raw_loans", LOAN_TYPES, "loan_id"))
LINEITEM_PROFILE = "\nUNION ALL\n".join(
    profile("lineitem", "lineitem", LINEITEM_TYPES, "(l_orderkey, l_linenumber)"))


# ---------------------------------------------------------------- findings

UPSTREAM = {"staging.customers": "raw.customers", "staging.loans": "raw.loans", "final.loan_portfolio": "staging.loans"}
DOWNSTREAM = {"raw.customers": ["staging.customers", "final.loan_portfolio"],
              "raw.loans": ["staging.loans", "final.loan_portfolio"], "staging.customers": ["final.loan_portfolio"],
              "staging.loans": ["final.loan_portfolio"], "final.loan_portfolio": []}
STEP = ["source->raw", "raw->staging", "staging->final"]
PRIORITY = ["SCHEMA_DRIFT", "JOIN_KEY_MISMATCH", "DUPLICATE_ROWS", "NULL_SPIKE", "ROW_INFLATION", "ROW_LOSS",
            "MEASURE_DRIFT", "DISTRIBUTION_SHIFT"]


def _contract_values() -> str:
    rows = []
    for t_idx, (name, (_, types, _, step)) in enumerate(TABLES.items()):
        for c_idx, (c, t) in enumerate(types.items()):
            up = UPSTREAM.get(name)
            if name == "final.loan_portfolio" and c in ("credit_score", "state"):
                up = "staging.customers"
            rows.append(f"('{name}', {t_idx}, '{c}', {c_idx}, '{t}', '{step}', {STEP.index(step)}, "
                        f"{repr(up) if up else 'NULL'})")
    return ", ".join(rows)


def _count_rule(ci: int, ii: int, table: str, step: str, source: str) -> str:
    return f"""SELECT {ci} AS ci, {ii} AS ii, 'row_count' AS "check", CASE WHEN act > exp THEN 'ROW_INFLATION' ELSE 'ROW_LOSS' END AS category,
  CASE WHEN abs(pct) >= 1 THEN 'critical' ELSE 'warning' END AS severity, '{step}' AS transition, '{table}' AS "table",
  NULL AS "column", CASE WHEN act > exp THEN '{table} has ' || format('{{:,}}', act - exp) || ' more rows than expected (+' || pct || '%)'
    ELSE format('{{:,}}', exp - act) || ' rows lost during {step} (' || pct || '%)' END AS message,
  cast(exp AS varchar) AS expected, cast(act AS varchar) AS actual
  FROM (SELECT *, round(100.0::double * (act - exp) / exp, 1) AS pct FROM ({source})) WHERE act <> exp"""


def findings_ctes(scenario: str) -> str:
    no_withdrawn = f"(upper({strip('status')}) IS NULL OR upper({strip('status')}) <> 'WITHDRAWN')"
    parsed = "try_cast(replace(replace(cast(balance AS varchar), '$', ''), ',', '') AS double)"
    return f"""{layers(scenario)},
prof AS ({all_profiles(scenario)}),
tab AS (SELECT DISTINCT "table", row_count, duplicate_keys FROM prof),
contract("table", table_idx, "column", column_idx, expected_type, transition, transition_idx, upstream) AS
  (VALUES {_contract_values()}),
changed AS (SELECT count(*) AS n FROM (SELECT DISTINCT loan_id, {strip('customer_id')} AS raw_id, source_system FROM raw_loans) r
  JOIN (SELECT DISTINCT loan_id, customer_id AS stg_id FROM stg_loans) s USING (loan_id) WHERE raw_id <> stg_id),
counts AS (SELECT (SELECT count(DISTINCT {strip('customer_id')}) FROM raw_customers) AS customers,
  (SELECT count(DISTINCT loan_id) FROM raw_loans WHERE {no_withdrawn}) AS kept,
  (SELECT count(DISTINCT loan_id) FROM raw_loans WHERE NOT {no_withdrawn}) AS withdrawn,
  (SELECT count(*) FROM raw_loans) AS raw_n, (SELECT count(*) - count(DISTINCT loan_id) FROM raw_loans) AS raw_dups,
  (SELECT count(*) FROM stg_customers) AS stg_c, (SELECT count(*) FROM stg_loans) AS stg_l,
  (SELECT count(*) FROM portfolio) AS fin_l),
totals AS (SELECT (SELECT coalesce(sum(b), 0) FROM (SELECT min({parsed}) AS b FROM raw_loans WHERE {no_withdrawn} GROUP BY loan_id)) AS t0,
  (SELECT coalesce(sum(balance), 0) FROM stg_loans) AS t1, (SELECT coalesce(sum(balance), 0) FROM portfolio) AS t2),
steps AS (SELECT 0 AS ii, 'raw->staging' AS transition, 'staging.loans' AS "table", t0 AS e, t1 AS a FROM totals
  UNION ALL SELECT 1, 'staging->final', 'final.loan_portfolio', t1, t2 FROM totals),
unknown AS (SELECT round(100.0::double * count(*) FILTER (WHERE risk_band = 'UNKNOWN') / count(*), 1) AS pct FROM portfolio),
found AS (
SELECT 0 AS ci, table_idx * 1000 + c.column_idx AS ii, 'schema' AS "check", 'SCHEMA_DRIFT' AS category, 'critical' AS severity,
  transition, c."table", c."column", c."table" || '.' || c."column" || ' arrived as ' || dtype || ', contract says ' || expected_type AS message,
  expected_type AS expected, dtype AS actual FROM contract c JOIN prof p USING ("table", "column") WHERE dtype <> expected_type
UNION ALL
SELECT 1, 0, 'key_integrity', 'JOIN_KEY_MISMATCH', 'critical', 'raw->staging', 'staging.loans', 'customer_id',
  'customer_id changed on ' || format('{{:,}}', n) || ' loans between raw and staging', 'unchanged', format('{{:,}}', n) || ' changed'
  FROM changed WHERE n > 0
UNION ALL
SELECT 2, c.table_idx, 'uniqueness', 'DUPLICATE_ROWS', 'critical', c.transition, c."table", c."column",
  CASE WHEN coalesce(u.duplicate_keys, 0) = 0 THEN c."table" || ' has ' || format('{{:,}}', t.duplicate_keys) || ' duplicate ' || c."column" || ' rows, none upstream'
    ELSE c."table" || ' has ' || format('{{:,}}', t.duplicate_keys - u.duplicate_keys) || ' more duplicate ' || c."column" || ' rows than upstream' END,
  '0', cast(t.duplicate_keys AS varchar)
  FROM contract c JOIN tab t USING ("table") LEFT JOIN tab u ON u."table" = c.upstream
  WHERE c.column_idx = 0 AND t.duplicate_keys - coalesce(u.duplicate_keys, 0) > 0
UNION ALL
SELECT 3, c.table_idx * 1000 + c.column_idx, 'null_rate', 'NULL_SPIKE', CASE WHEN p.null_pct > 10 THEN 'critical' ELSE 'warning' END,
  c.transition, c."table", c."column", c."table" || '.' || c."column" || CASE WHEN c.transition_idx = 0 THEN ' arrived with ' ELSE
  ' picked up during ' || c.transition || ': ' END || p.null_pct || '% nulls (limit 1.0%)', '<= 1.0%', p.null_pct || '%'
  FROM contract c JOIN prof p USING ("table", "column") LEFT JOIN prof u ON u."table" = c.upstream AND u."column" = c."column"
  WHERE p.null_pct > 1.0 AND coalesce(u.null_pct, 0) <= 1.0
UNION ALL
{_count_rule(4, 1, 'staging.customers', 'raw->staging', 'SELECT customers AS exp, stg_c AS act FROM counts')}
UNION ALL
SELECT 4, 10, 'row_count', 'EXPECTED_CHANGE', 'info', 'raw->staging', 'staging.loans', NULL,
  format('{{:,}}', raw_n - kept) || ' loans are expected to drop out in staging: ' || format('{{:,}}', withdrawn) || ' WITHDRAWN (business rule) and '
  || format('{{:,}}', raw_dups) || ' duplicate keys', cast(kept AS varchar), cast(kept AS varchar) FROM counts
UNION ALL
{_count_rule(4, 11, 'staging.loans', 'raw->staging', 'SELECT kept AS exp, stg_l AS act FROM counts')}
UNION ALL
{_count_rule(4, 1000, 'final.loan_portfolio', 'staging->final', 'SELECT stg_l AS exp, fin_l AS act FROM counts')}
UNION ALL
SELECT 5, ii, 'measure', 'MEASURE_DRIFT', CASE WHEN abs(pct) >= 5 THEN 'critical' ELSE 'warning' END, transition, "table", 'balance',
  'total balance in ' || "table" || ' is ' || CASE WHEN a < e THEN 'short' ELSE 'over' END || ' by $' || format('{{:,.0f}}', abs(a - e)) || ' ('
  || printf('%+.1f', pct) || '%) vs the layer before', printf('%.2f', e), printf('%.2f', a)
  FROM (SELECT *, CASE WHEN e <> 0 THEN 100.0::double * (a - e) / e ELSE 0 END AS pct FROM steps) WHERE abs(pct) > 0.5
UNION ALL
SELECT 6, 0, 'distribution', 'DISTRIBUTION_SHIFT', CASE WHEN pct > 10 THEN 'critical' ELSE 'warning' END, 'staging->final',
  'final.loan_portfolio', 'risk_band', pct || '% of loans in final have risk_band = UNKNOWN (limit 1.0%)', '<= 1.0%', pct || '%'
  FROM unknown WHERE pct > 1.0)"""


def findings(scenario: str) -> str:
    return f"""WITH {findings_ctes(scenario)}
SELECT '{scenario}' AS run_id, "check", category, severity, transition, "table", "column", message, expected, actual FROM found"""


VERDICT = """CASE "check" WHEN 'null_rate' THEN 'nulls' WHEN 'row_count' THEN 'row_counts' WHEN 'measure' THEN 'measures' ELSE "check" END"""


def _priority(category: str = "category") -> str:
    return f"CASE {category} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(PRIORITY)) + " ELSE 99 END"


def _step(transition: str = "transition") -> str:
    return f"CASE {transition} " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(STEP)) + " END"


def diagnosis(scenario: str) -> str:
    return f"""WITH {findings_ctes(scenario)},
ranked AS (SELECT *, row_number() OVER (ORDER BY {_step()}, {_priority()}, ci, ii) AS r FROM found WHERE severity <> 'info')
SELECT '{scenario}' AS run_id, CASE WHEN (SELECT count(*) FROM ranked) > 0 THEN 'FAILED' ELSE 'HEALTHY' END AS status,
  (SELECT category FROM ranked WHERE r = 1) AS root_category, (SELECT transition FROM ranked WHERE r = 1) AS root_transition,
  (SELECT "table" FROM ranked WHERE r = 1) AS root_table, (SELECT "column" FROM ranked WHERE r = 1) AS root_column,
  (SELECT count(*) FROM ranked WHERE r > 1) AS symptom_count,
  coalesce((SELECT string_agg(category || ' at ' || transition, ', ' ORDER BY r) FROM ranked WHERE r > 1), '') AS symptoms,
  coalesce((SELECT string_agg(message, ', ' ORDER BY ci, ii) FROM found WHERE severity = 'info'), '') AS expected_changes,
  coalesce((SELECT string_agg(DISTINCT {VERDICT}, ', ' ORDER BY {VERDICT}) FROM ranked), '') AS failed_checks,
  fin_l AS final_loan_rows, (SELECT row_count - duplicate_keys FROM tab WHERE "table" = 'final.loan_portfolio') AS final_distinct_loans,
  (SELECT sum_value FROM prof WHERE "table" = 'final.loan_portfolio' AND "column" = 'balance') AS final_total_balance,
  stg_l AS staging_loan_rows FROM counts"""


# ---------------------------------------------------------------- pieces shared by several queries

def segment_flags(relation: str, item: str, condition: str) -> str:
    return f"""SELECT '{item}' AS item, source_system AS segment, count(*) AS "rows", count(*) FILTER (WHERE {condition}) AS affected,
  round(100.0::double * count(*) FILTER (WHERE {condition}) / count(*), 1) AS affected_pct FROM {relation} GROUP BY source_system"""


NOT_A_NUMBER = f"({number('balance')}) IS NULL AND balance IS NOT NULL"
ORPHANS = "SELECT * FROM stg_loans l WHERE NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = l.customer_id)"
PAIRS = f"""SELECT r.source_system AS segment, raw_id, stg_id, lpad(stg_id, length(raw_id)::int, '0') = raw_id AS padded
  FROM (SELECT DISTINCT loan_id, {strip('customer_id')} AS raw_id, source_system FROM raw_loans) r
  JOIN (SELECT DISTINCT loan_id, customer_id AS stg_id FROM stg_loans) s USING (loan_id) WHERE raw_id <> stg_id"""
BY_SOURCE = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, source_system, count(*) AS loans, "
    f"round(coalesce(sum(try_cast(balance AS double)), 0), 2) AS balance FROM {rel} GROUP BY source_system"
    for layer, rel in (("raw", "raw_loans"), ("staging", "stg_loans"), ("final", "portfolio")))


def pivot(value: str) -> str:
    sources = ", ".join(f"('{s}')" for s in SOURCES)
    cells = ", ".join(f"max(CASE WHEN layer = '{l}' THEN {value} END) AS \"{l}\"" for l in ("raw", "staging", "final"))
    return over("dropped_join_key", f"SELECT source_system, {cells} FROM (VALUES {sources}) s(source_system) "
                                    f"LEFT JOIN ({BY_SOURCE}) b USING (source_system) GROUP BY source_system")


KEPT_RAW = f"(upper({strip('status')}) IS NULL OR upper({strip('status')}) <> 'WITHDRAWN')"
PARSED = "try_cast(replace(replace(cast(balance AS varchar), '$', ''), ',', '') AS double)"
SEGMENT_SUMS = f"""seg AS (SELECT source_system AS segment, sum(t0) AS t0, sum(t1) AS t1, sum(t2) AS t2 FROM (
  SELECT source_system, b AS t0, 0 AS t1, 0 AS t2 FROM (SELECT min(source_system) AS source_system, min({PARSED}) AS b FROM raw_loans WHERE {KEPT_RAW} GROUP BY loan_id)
  UNION ALL SELECT source_system, 0, balance, 0 FROM stg_loans UNION ALL SELECT source_system, 0, 0, balance FROM portfolio) GROUP BY source_system)"""


def layer_counts(scenario: str = "clean") -> str:
    return over(scenario, "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", count(*) AS \"rows\" FROM {rel}" for name, (rel, *_) in TABLES.items()))


def supplies(lost: str = "false") -> str:
    """CTEs of the second set of tables; ``lost`` names suppliers that staging loses."""
    return f"""raw_nations AS ({RAW_SUPPLY_SQL['nations']}), raw_suppliers AS ({RAW_SUPPLY_SQL['suppliers']}), raw_shipments AS ({RAW_SUPPLY_SQL['shipments']}),
stg_nations AS (SELECT nation_id, upper(trim(nation)) AS nation FROM raw_nations),
stg_suppliers AS (SELECT * FROM raw_suppliers WHERE NOT ({lost})),
stg_shipments AS (SELECT * FROM raw_shipments WHERE flag IS NULL OR flag <> 'A' QUALIFY row_number() OVER (PARTITION BY line_id
  ORDER BY supplier_id, flag, price, shipped) = 1),
supplies AS (SELECT line_id, supplier_id, nation, flag, price, shipped FROM stg_shipments JOIN stg_suppliers USING (supplier_id) JOIN stg_nations USING (nation_id)),
revenue AS (SELECT nation, count(*) AS lines, round(sum(price), 2) AS revenue FROM supplies GROUP BY nation)"""


SUPPLY_TABLES = {"raw.nations": "raw_nations", "raw.suppliers": "raw_suppliers", "raw.shipments": "raw_shipments", "staging.nations": "stg_nations",
                 "staging.suppliers": "stg_suppliers", "staging.shipments": "stg_shipments", "final.supplies": "supplies", "final.nation_revenue": "revenue"}

CLOSURE = f"""WITH RECURSIVE {layers()}, {supplies()},
edges(src, dst) AS (VALUES ('raw.customers', 'staging.customers'), ('raw.loans', 'staging.loans'),
  ('staging.loans', 'final.loan_portfolio'), ('staging.customers', 'final.loan_portfolio'), ('raw.nations', 'staging.nations'),
  ('raw.suppliers', 'staging.suppliers'), ('raw.shipments', 'staging.shipments'), ('staging.shipments', 'final.supplies'),
  ('staging.suppliers', 'final.supplies'), ('staging.nations', 'final.supplies')),
reach AS (SELECT src, dst, 1 AS depth FROM edges UNION ALL SELECT r.src, e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.dst),
n AS ({" UNION ALL ".join(f"SELECT '{name}' AS t, count(*) AS c FROM {rel}" for name, rel in [*((k, v[0]) for k, v in TABLES.items()), *SUPPLY_TABLES.items()])})
SELECT src AS src_table, dst AS dst_table, min(depth) AS depth, any_value(a.c) AS src_rows, any_value(b.c) AS dst_rows
FROM reach JOIN n a ON a.t = src JOIN n b ON b.t = dst GROUP BY src, dst"""

LOST = "cast(substr(supplier_id, 2) AS bigint) % 10 = 3"
LOST_SUPPLIERS = f"""WITH {supplies(LOST)},
n AS (SELECT (SELECT count(*) FROM raw_suppliers) AS s0, (SELECT count(*) FROM stg_suppliers) AS s1, (SELECT count(*) FROM stg_shipments) AS l1,
  (SELECT count(*) FROM supplies) AS l2, (SELECT sum(price) FROM stg_shipments) AS p1, (SELECT coalesce(sum(price), 0) FROM supplies) AS p2)
SELECT 'lost_suppliers' AS run_id, category, transition, "table", "column", expected, actual, unmatched_rows FROM (
  SELECT 'ROW_LOSS' AS category, 'raw->staging' AS transition, 'staging.suppliers' AS "table", cast(NULL AS varchar) AS "column",
    cast(s0 AS varchar) AS expected, cast(s1 AS varchar) AS actual, cast(NULL AS bigint) AS unmatched_rows FROM n WHERE s0 <> s1
  UNION ALL SELECT 'ROW_LOSS', 'staging->final', 'final.supplies', NULL, cast(l1 AS varchar), cast(l2 AS varchar),
    l1 - l2 FROM n WHERE l1 <> l2
  UNION ALL SELECT 'MEASURE_DRIFT', 'staging->final', 'final.supplies', 'price', printf('%.2f', p1), printf('%.2f', p2), NULL FROM n
    WHERE abs(100.0 * (p2 - p1) / p1) > 0.5
  UNION ALL SELECT 'DUPLICATE_ROWS', 'source->raw', 'raw.shipments', 'line_id', '0', cast(count(*) - count(DISTINCT line_id) AS varchar), NULL
    FROM raw_shipments HAVING count(*) <> count(DISTINCT line_id))"""
LOST_CUSTOMERS = f"""WITH {layers()},
kept AS (SELECT * FROM stg_customers WHERE cast(customer_id AS bigint) % 7 <> 0), q AS (SELECT l.* FROM stg_loans l JOIN kept USING (customer_id)),
n AS (SELECT (SELECT count(*) FROM stg_customers) AS c0, (SELECT count(*) FROM kept) AS c1, (SELECT count(*) FROM stg_loans) AS l0,
  (SELECT count(*) FROM q) AS l1, (SELECT sum(balance) FROM stg_loans) AS b0, (SELECT coalesce(sum(balance), 0) FROM q) AS b1)
SELECT 'lost_customers' AS run_id, 'row_count' AS "check", 'ROW_LOSS' AS category, 'raw->staging' AS transition, 'staging.customers' AS "table",
  cast(c0 AS varchar) AS expected, cast(c1 AS varchar) AS actual FROM n WHERE c0 <> c1
UNION ALL SELECT 'lost_customers', 'row_count', 'ROW_LOSS', 'staging->final', 'final.loan_portfolio', cast(l0 AS varchar), cast(l1 AS varchar) FROM n WHERE l0 <> l1
UNION ALL SELECT 'lost_customers', 'measure', 'MEASURE_DRIFT', 'staging->final', 'final.loan_portfolio', printf('%.2f', b0), printf('%.2f', b1) FROM n
  WHERE abs(100.0 * (b1 - b0) / b0) > 0.5"""

# ---------------------------------------------------------------- history

HIST = f"""WITH runs AS ({W.RUNS_SQL}), found AS ({W.FINDINGS_SQL}), diagnosed AS ({W.DIAGNOSED_SQL}),
reports AS ({W.REPORTS_SQL}), gates AS ({W.GATES_SQL}), truth AS ({W.TRUTH_SQL}), profiles AS ({W.PROFILES_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY transition_idx, {_priority()}, check_idx, item_idx) AS rank
  FROM found WHERE severity <> 'info'),
roots AS (SELECT * FROM ranked WHERE rank = 1),
known AS (SELECT run_id, scenario, injected_at, rows_affected,
  CASE WHEN injected_at LIKE 'extract:%' THEN 'source->raw' ELSE 'raw->staging' END AS step,
  replace(replace(injected_at, 'extract:', 'raw.'), 'staging:', 'staging.') AS place FROM truth),
named AS (SELECT *, CASE category WHEN 'SCHEMA_DRIFT' THEN 'type_change' WHEN 'NULL_SPIKE' THEN 'null_spike'
  WHEN 'JOIN_KEY_MISMATCH' THEN 'dropped_join_key' WHEN 'DUPLICATE_ROWS' THEN 'duplicate_rows' END AS guess FROM roots),
scores AS (SELECT r.run_id, coalesce(k.scenario, 'none') AS scenario, guess AS diagnosed_as,
  CASE WHEN k.scenario IS NOT NULL THEN coalesce(guess = k.scenario, false) END AS scenario_correct,
  k.step || ' ' || k.place AS location_expected, n.transition || ' ' || n."table" AS location_found,
  CASE WHEN k.scenario IS NOT NULL THEN coalesce(n.transition = k.step AND n."table" = k.place, false) END AS location_correct,
  CASE WHEN k.scenario IS NULL THEN n.run_id IS NULL
    ELSE coalesce(guess = k.scenario AND n.transition = k.step AND n."table" = k.place, false) END AS correct
  FROM runs r LEFT JOIN named n USING (run_id) LEFT JOIN known k USING (run_id)),
statuses AS (SELECT r.run_id, CASE WHEN count(f.run_id) > 0 THEN 'FAILED' ELSE 'HEALTHY' END AS status, count(f.run_id) AS failures
  FROM runs r LEFT JOIN ranked f USING (run_id) GROUP BY r.run_id),
diagnoses AS (SELECT s.run_id, s.status, c.category AS root_cause FROM statuses s JOIN diagnosed USING (run_id) LEFT JOIN roots c USING (run_id))
"""
VERDICT_ORDER = ("schema", "key_integrity", "uniqueness", "nulls", "row_counts", "measures", "distribution")
VERDICT_NAMES = ", ".join(f"('{v}')" for v in VERDICT_ORDER)
HEADINGS = ("Summary", "Where it broke", "Root cause", "Downstream impact", "Recommended fix")

JUDGED = rf"""WITH drafts AS ({DRAFTS_SQL}), roots AS ({DRAFT_ROOTS_SQL}),
s1 AS (SELECT run_id, {strip('text')} AS t FROM drafts),
s2 AS (SELECT run_id, starts_with(t, '```') AS fenced, CASE WHEN starts_with(t, '```') THEN
    CASE WHEN instr(t, chr(10)) > 0 THEN substr(t, instr(t, chr(10)) + 1) ELSE '' END ELSE t END AS t FROM s1),
s3 AS (SELECT run_id, CASE WHEN fenced THEN regexp_replace(t, '```\s*$', '') ELSE t END AS t FROM s2),
s4 AS (SELECT run_id, {strip("CASE WHEN instr(t, '## ') > 1 THEN substr(t, instr(t, '## ')) ELSE t END")} AS draft FROM s3),
judged AS (SELECT run_id, draft,
  (contains(lower(draft), lower("table")) OR contains(lower(draft), lower(split_part("table", '.', 2))))
    AND contains(lower(draft), lower(coalesce("column", ''))) AS grounded,
  list_filter({list(HEADINGS)}, lambda h: NOT contains(lower(draft), lower('## ' || h))) AS missing
  FROM s4 JOIN roots USING (run_id))
"""

NOTES = HIST + """, drafts AS (SELECT DISTINCT run_id FROM
  (SELECT *, """ + W.RUN_ID + """ AS run_id FROM events) e WHERE event_type = 'error'),
noted AS (SELECT r.run_id, n.run_id IS NOT NULL AS failed, d.run_id IS NOT NULL AS drafted, d.run_id IS NOT NULL AND
  split_part(n."table", '.', 2) = 'loans' AND (n."column" IS NULL OR n."column" = 'balance') AS grounded
  FROM runs r LEFT JOIN roots n USING (run_id) LEFT JOIN drafts d USING (run_id))
SELECT run_id, CASE WHEN failed THEN 'FAILED' ELSE 'HEALTHY' END AS status,
  CASE WHEN failed AND grounded THEN 'draft' ELSE 'template' END AS source, CASE WHEN failed AND grounded THEN 'writer' END AS author,
  NOT (failed AND drafted) OR grounded AS grounded,
  CASE WHEN NOT failed THEN 'healthy run - no draft needed' WHEN NOT drafted THEN 'no draft - used template'
    WHEN NOT grounded THEN 'draft did not name the root-cause table/column - used template'
    ELSE 'filled from template: Where it broke, Root cause, Downstream impact, Recommended fix' END AS note FROM noted"""

# ---------------------------------------------------------------- report texts

def _playbook(style: str) -> str:
    rows = []
    for category, steps in FIX_PLAYBOOK.items():
        lines = [f"{i}. {t}" if style == "numbered" else f"  - {t}" for i, t in enumerate(steps, 1)]
        rows.append("('" + category + "', '" + "' || chr(10) || '".join(t.replace("'", "''") for t in lines) + "')")
    return f"(VALUES {', '.join(rows)}) b(category, steps)"


def _shown(e: str) -> str:
    return f"""CASE WHEN verdict IN ('uniqueness', 'row_counts') THEN format('{{:,}}', cast({e} AS bigint))
    WHEN verdict = 'measures' THEN format('{{:,.2f}}', cast({e} AS double)) ELSE {e} END"""


TEXTS = HIST + f""", described AS (SELECT *, "table" || coalesce('.' || "column", '') AS place FROM ranked),
texts AS (SELECT *, '[' || category || '] at step ' || transition || ', ' || place || ': ' || message || chr(10) || '  expected: ' || {_shown('expected')}
  || ' | actual: ' || {_shown('actual')} AS body FROM described),
notes AS (SELECT run_id, count(*) - 1 AS n, any_value(category) FILTER (WHERE rank = 1) AS category,
  any_value(transition) FILTER (WHERE rank = 1) AS transition, any_value(place) FILTER (WHERE rank = 1) AS place,
  any_value(message) FILTER (WHERE rank = 1) AS message, any_value(body) FILTER (WHERE rank = 1) AS root_body,
  coalesce(string_agg('- ' || message || ' (' || transition || ')', chr(10) ORDER BY rank) FILTER (WHERE rank > 1), '- none') AS impact,
  coalesce(string_agg(body, chr(10) ORDER BY rank) FILTER (WHERE rank > 1), '  none') AS symptoms,
  string_agg(body, chr(10) || chr(10) ORDER BY rank) AS bodies FROM texts GROUP BY run_id),
expecting AS (SELECT run_id, string_agg('- ' || message, chr(10) ORDER BY check_idx, item_idx) AS bullets,
  string_agg('  ' || message, chr(10) ORDER BY check_idx, item_idx) AS lines FROM found WHERE severity = 'info' GROUP BY run_id)
"""
GAP = "chr(10) || chr(10)"
REPORT_TEXT = TEXTS + f""", drafts AS (SELECT run_id, count(*) AS errors FROM (SELECT *, {W.RUN_ID} AS run_id FROM events) e
  WHERE event_type = 'error' GROUP BY run_id),
parts AS (SELECT r.run_id, n.*  EXCLUDE (run_id), d.errors, e.bullets, b.steps,
  errors IS NOT NULL AND split_part(place, '.', 2) = 'loans' AND split_part(place, '.', 3) IN ('', 'balance') AS grounded,
  '## Where it broke' || chr(10) || 'Step `' || transition || '`, column `' || place || '`.' || {GAP} || '## Root cause' || chr(10)
  || array_to_string(list_transform(string_split(lower(n.category), '_'), lambda w: upper(w[1]) || w[2:]), ' ') || ': ' || message || '.'
  || {GAP} || '## Downstream impact' || chr(10) || impact || {GAP} || '## Recommended fix' || chr(10) || coalesce(steps, '') AS rest
  FROM runs r LEFT JOIN notes n USING (run_id) LEFT JOIN drafts d USING (run_id) LEFT JOIN expecting e USING (run_id)
  LEFT JOIN {_playbook('numbered')} ON b.category = n.category)
SELECT run_id, CASE WHEN n IS NULL THEN 'HEALTHY' ELSE 'FAILED' END AS status,
  CASE WHEN n IS NOT NULL AND grounded THEN 'draft' ELSE 'template' END AS source,
  '# Pipeline incident report - run ' || run_id || {GAP} || 'Status: **' || CASE WHEN n IS NULL THEN 'HEALTHY' ELSE 'FAILED' END
  || '** | written by: ' || CASE WHEN n IS NOT NULL AND grounded THEN 'draft / writer' ELSE 'template' END || {GAP} ||
  CASE WHEN n IS NULL THEN '## Summary' || chr(10) || 'All checks passed. Row counts, schemas, keys, nulls and balance totals reconcile across raw, staging and final.'
    || {GAP} || 'Checks run: schema, key_integrity, uniqueness, nulls, row_counts, measures, distribution' || {GAP} || '## Expected changes' || chr(10)
    || coalesce(bullets, '- none')
  ELSE '## Summary' || chr(10) || CASE WHEN grounded THEN errors || ' errors hit loans balance' ELSE message || '. The problem started at the ' || transition
    || ' step. It caused ' || n || ' downstream issue(s) in later layers.' END || {GAP} || rest || {GAP}
    || '---' || chr(10) || '### Evidence from automated checks' || chr(10) || '```' || chr(10) || bodies || chr(10) || '```' END AS markdown FROM parts"""
FACT_TEXT = TEXTS + f""", passed AS (SELECT run_id, string_agg(verdict || '=' || result, ', ' ORDER BY i) AS checks FROM (
  SELECT r.run_id, v.i, v.verdict, CASE WHEN EXISTS (SELECT 1 FROM ranked f WHERE f.run_id = r.run_id AND f.verdict = v.verdict) THEN 'FAIL' ELSE 'PASS' END AS result
  FROM runs r, (VALUES {", ".join(f"({i}, '{v}')" for i, v in enumerate(VERDICT_ORDER))}) v(i, verdict)) GROUP BY run_id),
impacts AS (SELECT run_id, max(row_count) FILTER (WHERE layer = 'final') AS fin, max(row_count) FILTER (WHERE layer = 'staging') AS stg,
  max(sum_value) FILTER (WHERE layer = 'final') AS total FROM profiles GROUP BY run_id)
SELECT run_id, 'FACTS' || chr(10) || 'Run: ' || run_id || chr(10) || 'Steps, in order: source->raw, raw->staging, staging->final'
  || chr(10) || 'Checks: ' || checks || {GAP} || 'ROOT CAUSE (earliest failure in the pipeline):' || chr(10) || root_body || {GAP}
  || 'DOWNSTREAM SYMPTOMS (caused by the root cause):' || chr(10) || symptoms || {GAP}
  || 'EXPECTED CHANGES (normal business rules, NOT problems):' || chr(10) || coalesce(lines, '  none') || {GAP}
  || 'FINAL LAYER NOW:' || chr(10) || '  loan rows: ' || format('{{:,}}', fin) || ' (staging had ' || format('{{:,}}', stg) || ')' || chr(10)
  || '  distinct loans: ' || format('{{:,}}', fin) || chr(10) || '  total balance: ' || format('{{:,.2f}}', total) || {GAP}
  || 'FIX PLAYBOOK for this type of failure:' || chr(10) || coalesce(steps, '  - Investigate the root cause above.') AS facts
FROM notes n JOIN passed USING (run_id) JOIN impacts USING (run_id) LEFT JOIN expecting USING (run_id)
LEFT JOIN {_playbook('bulleted')} ON b.category = n.category"""

def _lines(*parts: str) -> str:
    return " || chr(10) || ".join(parts)


def _one_segment(c: str) -> str:
    return (f"CASE WHEN count(DISTINCT {c}) = 1 THEN '  affected_segment: source_system = ''' || min({c}) || '''' "
            "|| chr(10) ELSE '' END")


SCENARIO_NOTE = f"""WITH {findings_ctes('dropped_join_key')}, {SEGMENT_SUMS}, o AS ({ORPHANS}), pairs AS ({PAIRS}),
examples AS (SELECT string_agg('"''' || raw_id || ''' -> ''' || stg_id || '''"', ', ' ORDER BY raw_id, stg_id) AS t
  FROM (SELECT DISTINCT raw_id, stg_id FROM pairs ORDER BY 1, 2 LIMIT 3)),
samples AS (SELECT string_agg('"' || k || '"', ', ' ORDER BY k) AS t FROM (SELECT DISTINCT customer_id AS k FROM o ORDER BY 1 LIMIT 3)),
missing AS (SELECT string_agg('"' || t || '"', ', ' ORDER BY t) AS t FROM (SELECT DISTINCT loan_type AS t FROM stg_loans EXCEPT SELECT loan_type FROM portfolio)),
pair_segments AS (SELECT string_agg('    ' || segment || ': changed_rows=' || format('{{:,}}', n), chr(10) ORDER BY n DESC, segment) AS t
  FROM (SELECT segment, count(*) AS n FROM pairs GROUP BY segment)),
orphan_segments AS (SELECT string_agg('    ' || source_system || ': unmatched_rows=' || format('{{:,}}', n), chr(10) ORDER BY n DESC, source_system) AS t
  FROM (SELECT source_system, count(*) AS n FROM o GROUP BY source_system)),
sum_segments AS (SELECT string_agg('    ' || segment || ': expected=' || format('{{:,.2f}}', t1) || ', actual=' || format('{{:,.2f}}', t2) || ', delta='
  || format('{{:,.2f}}', round(t2 - t1, 2) + 0.0), chr(10) ORDER BY abs(round(t2 - t1, 2)) DESC, segment) AS t FROM seg),
evidence AS (
SELECT 'key_integrity' AS "check", {_one_segment('segment')} || CASE WHEN bool_and(padded) THEN
  '  pattern: leading zeros stripped - looks like the key was cast to an integer' || chr(10) ELSE '' END ||
  {_lines("'  examples: [' || (SELECT t FROM examples) || ']'", "'  changed_rows: ' || format('{:,}', count(*))",
          "'  rows_now_unmatched_in_customers: ' || format('{:,}', (SELECT count(*) FROM o))", "'  by source_system:'",
          "(SELECT t FROM pair_segments)")} AS body FROM pairs
UNION ALL
SELECT 'row_count', {_one_segment('source_system')} || {_lines(
    "'  sample_unmatched_keys: [' || (SELECT t FROM samples) || ']'", "'  unmatched_rows: ' || format('{:,}', count(*))",
    "'  match_if_zero_padded: ' || format('{:,}', count(*) FILTER (WHERE lpad(customer_id, 8, '0') IN (SELECT customer_id FROM stg_customers)))",
    "'  loan_types_missing_from_final: [' || (SELECT t FROM missing) || ']'",
    "'  cause: loans whose customer_id has no match in staging.customers are dropped by the inner join'",
    "'  by source_system:'", "(SELECT t FROM orphan_segments)")} FROM o
UNION ALL
SELECT 'measure', {_lines("'  delta: ' || format('{:,.2f}', a - e)", "'  delta_pct: ' || format('{:,.2f}', 100.0::double * (a - e) / e)",
                          "'  by source_system:'", "(SELECT t FROM sum_segments)")} FROM steps WHERE ii = 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY {_step()}, {_priority()}, ci, ii) AS r,
  "table" || coalesce('.' || "column", '') AS place FROM found WHERE severity <> 'info'),
texts AS (SELECT ranked.* , '[' || category || '] at step ' || transition || ', ' || place || ': ' || message || chr(10) || '  expected: '
  || CASE "check" WHEN 'row_count' THEN format('{{:,}}', try_cast(expected AS bigint)) WHEN 'measure' THEN format('{{:,.2f}}', try_cast(expected AS double)) ELSE expected END
  || ' | actual: ' || CASE "check" WHEN 'row_count' THEN format('{{:,}}', try_cast(actual AS bigint)) WHEN 'measure' THEN format('{{:,.2f}}', try_cast(actual AS double))
  ELSE actual END || chr(10) || evidence.body AS body FROM ranked JOIN evidence USING ("check")),
root AS (SELECT * FROM texts WHERE r = 1)
SELECT 'dropped_join_key' AS run_id, 'FAILED' AS status, 'no draft - used template' AS note,
  '# Pipeline incident report - run dropped_join_key' || {GAP} || 'Status: **FAILED** | written by: template' || {GAP} || '## Summary' || chr(10) || message
  || '. The problem started at the ' || transition || ' step and is limited to source_system = ''CARD_PLATFORM''. It caused '
  || (SELECT count(*) FROM texts WHERE r > 1) || ' downstream issue(s) in later layers.' || {GAP}
  || '## Where it broke' || chr(10) || 'Step `' || transition || '`, column `' || place || '`.' || {GAP}
  || '## Root cause' || chr(10) || 'Join Key Mismatch: ' || message || '. Pattern: leading zeros stripped - looks like the key was cast to an integer.' || {GAP}
  || '## Downstream impact' || chr(10) || (SELECT string_agg('- ' || message || ' (' || transition || ')', chr(10) ORDER BY r) FROM texts WHERE r > 1) || {GAP}
  || '## Recommended fix' || chr(10) || (SELECT steps FROM {_playbook('numbered')} WHERE b.category = 'JOIN_KEY_MISMATCH') || {GAP}
  || '---' || chr(10) || '### Evidence from automated checks' || chr(10) || '```' || chr(10)
  || (SELECT string_agg(body, {GAP} ORDER BY r) FROM texts) || chr(10) || '```' AS markdown FROM root"""

# ---------------------------------------------------------------- the registry

ORACLES: dict[str, str] = {
    "clean_customers": over("clean", "SELECT * FROM stg_customers"),
    "clean_loans": over("clean", "SELECT * FROM stg_loans"),
    "clean_loans_text_balance": over("type_change", "SELECT loan_id, source_system, status, balance FROM stg_loans"),
    "loan_portfolio": over("clean", "SELECT * FROM portfolio"),
    "portfolio_summary": over("clean", """SELECT loan_type, count(*) AS loan_count, round(sum(balance), 2) AS total_balance,
  round(avg(interest_rate), 4) AS avg_interest_rate, round(avg(is_delinquent::int), 4) AS delinquency_rate,
  round(avg((risk_band = 'SUBPRIME')::int), 4) AS subprime_share FROM portfolio GROUP BY loan_type"""),
    "risk_band_distribution": over("null_spike", """SELECT risk_band, count(*) AS loans, count(*) FILTER (WHERE credit_score IS NULL) AS without_score,
  count(*) FILTER (WHERE is_delinquent) AS delinquent FROM portfolio GROUP BY risk_band"""),
    "unknown_share": over("null_spike", """SELECT count(*) AS "rows", count(*) FILTER (WHERE risk_band = 'UNKNOWN') AS category_rows,
  count(*) FILTER (WHERE risk_band = 'UNKNOWN' AND credit_score IS NULL) AS with_null_cause,
  round(100.0::double * count(*) FILTER (WHERE risk_band = 'UNKNOWN') / count(*), 1) AS share_pct FROM portfolio"""),
    "layer_row_counts": layer_counts(),
    "table_preview": over("clean", "SELECT * FROM stg_loans ORDER BY loan_id LIMIT 100"),
    "balance_by_source": over("type_change", BY_SOURCE),
    "balance_by_source_pivot": pivot("balance"),
    "loans_by_source_pivot": pivot("loans"),
    "profile_raw_loans": over("clean", RAW_LOANS_PROFILE),
    "profile_lineitem": LINEITEM_PROFILE,
    "profile_layers": over("type_change", f"""SELECT 'type_change' AS run_id, split_part("table", '.', 1) AS layer, * FROM ({all_profiles('type_change')})"""),
    "table_profiles": over("duplicate_rows", f"""SELECT DISTINCT 'duplicate_rows' AS run_id, split_part("table", '.', 1) AS layer, "table", row_count, duplicate_keys
  FROM ({all_profiles('duplicate_rows')})"""),
    "column_grid": over("clean", f"""SELECT 'clean' AS run_id, "table", "column", dtype, null_pct, distinct_count,
  coalesce(format('{{:,.2f}}', min_value), min_text, '') AS "min", coalesce(format('{{:,.2f}}', max_value), max_text, '') AS "max" FROM ({RAW_LOANS_PROFILE})"""),
    "duplicate_keys_lineitem": 'SELECT count(*) AS "rows", count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus FROM lineitem',
    "duplicate_groups_lineitem": """SELECT l_orderkey, l_linenumber, count(*) AS copies, cast(min(l_shipdate) AS date) AS first_date
  FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_spans": over("duplicate_rows", """SELECT count(*) AS duplicated_keys, cast(cast(min(d) AS date) AS varchar) AS date_from, cast(cast(max(d) AS date) AS varchar) AS date_to
  FROM (SELECT loan_id, min(origination_date) AS d FROM stg_loans GROUP BY loan_id HAVING count(*) > 1)"""),
    "surplus_by_segment": over("duplicate_rows", "SELECT source_system AS segment, count(*) - count(DISTINCT loan_id) AS extra_rows FROM stg_loans GROUP BY 1"),
    "surplus_by_flag_lineitem": "SELECT l_returnflag AS segment, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS extra_rows FROM lineitem GROUP BY 1",
    "exact_copies": over("duplicate_rows", "SELECT (SELECT count(*) FROM stg_loans) - (SELECT count(*) FROM (SELECT DISTINCT * FROM stg_loans)) AS exact_copies"),
    "first_row_per_key_lineitem": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "orphans": over("dropped_join_key", ORPHANS),
    "orphans_by_source": over("dropped_join_key", f"SELECT source_system AS segment, count(*) AS unmatched_rows FROM ({ORPHANS}) GROUP BY 1"),
    "orphans_zero_padded": over("dropped_join_key", f"""SELECT count(*) AS match_if_zero_padded FROM ({ORPHANS}) WHERE lpad(customer_id,
  (SELECT mode(length(customer_id)) FROM stg_customers)::int, '0') IN (SELECT customer_id FROM stg_customers)"""),
    "orphan_samples": over("dropped_join_key", f"SELECT DISTINCT customer_id AS value FROM ({ORPHANS}) ORDER BY 1 LIMIT 3"),
    "lost_loan_types": over("dropped_join_key", "SELECT DISTINCT loan_type FROM stg_loans EXCEPT SELECT loan_type FROM portfolio"),
    "modal_key_length": over("dropped_join_key", """SELECT cast(length(customer_id) AS int) AS key_length FROM stg_loans GROUP BY 1
  ORDER BY count(*) DESC, 1 LIMIT 1"""),
    "changed_keys": over("dropped_join_key", f"SELECT count(*) AS changed, count(*) FILTER (WHERE padded) AS zero_padded FROM ({PAIRS})"),
    "changed_keys_by_source": over("dropped_join_key", f"SELECT segment, count(*) AS changed, count(*) FILTER (WHERE padded) AS zero_padded FROM ({PAIRS}) GROUP BY 1"),
    "changed_key_samples": over("dropped_join_key", f"""SELECT '''' || raw_id || ''' -> ''' || stg_id || '''' AS value FROM
  (SELECT DISTINCT raw_id, stg_id FROM ({PAIRS}) ORDER BY 1, 2 LIMIT 3)"""),
    "changed_suppliers_lineitem": """WITH lines AS (SELECT l_orderkey, lpad(cast(l_suppkey AS varchar), 4, '0') AS padded, cast(l_suppkey AS varchar) AS plain, l_returnflag, l_linenumber FROM lineitem),
r AS (SELECT DISTINCT l_orderkey, padded AS raw_id, l_returnflag FROM lines WHERE l_linenumber % 2 = 0),
s AS (SELECT DISTINCT l_orderkey, CASE WHEN l_linenumber = 1 THEN padded ELSE plain END AS stg_id FROM lines WHERE l_linenumber % 2 = 1)
SELECT l_returnflag AS segment, count(*) AS changed, count(*) FILTER (WHERE lpad(stg_id, length(raw_id)::int, '0') = raw_id) AS zero_padded
FROM r JOIN s USING (l_orderkey) WHERE raw_id <> stg_id GROUP BY 1""",
    "non_numeric_segments": over("type_change", segment_flags("raw_loans", "balance", NOT_A_NUMBER)),
    "non_numeric_sole_segment": over("type_change", f"""SELECT 'balance' AS item, count(*) AS affected,
  CASE WHEN count(DISTINCT source_system) = 1 THEN 'source_system = ''' || min(source_system) || '''' END AS affected_segment FROM raw_loans WHERE {NOT_A_NUMBER}"""),
    "non_numeric_samples": over("type_change", f"SELECT DISTINCT balance AS value FROM raw_loans WHERE {NOT_A_NUMBER} ORDER BY 1 LIMIT 3"),
    "null_segments": over("null_spike", segment_flags("portfolio", "credit_score", "credit_score IS NULL") + " UNION ALL "
                          + segment_flags("portfolio", "state", "state IS NULL")),
    "schema_drift": over("type_change", f"""SELECT 'raw.loans' AS "table", 'balance' AS "column", 'DOUBLE' AS expected, 'VARCHAR' AS actual,
  count(*) FILTER (WHERE {NOT_A_NUMBER}) AS non_numeric_rows, round(100.0::double * count(*) FILTER (WHERE {NOT_A_NUMBER}) / count(*), 1) AS non_numeric_pct,
  CASE WHEN count(DISTINCT source_system) FILTER (WHERE {NOT_A_NUMBER}) = 1 THEN 'source_system = ''' || min(source_system) FILTER (WHERE {NOT_A_NUMBER}) || '''' END AS affected_segment,
  'values contain currency symbols / thousands separators' AS pattern FROM raw_loans"""),
    "null_spike_first_appearance": f"""WITH {findings_ctes('null_spike')}
SELECT f."table", f."column", f.severity, p.null_count AS null_rows, 1.0::double AS limit_pct,
  (SELECT string_agg(q."table", ', ' ORDER BY CASE q."table" WHEN 'final.loan_portfolio' THEN 1 ELSE 0 END) FROM prof q WHERE q."column" = f."column"
    AND q.null_pct > 1.0 AND q."table" IN ('staging.customers', 'final.loan_portfolio')) AS persists_in
FROM found f JOIN prof p USING ("table", "column") WHERE f."check" = 'null_rate'""",
    "lineage_closure": CLOSURE,
    "row_reconciliation": over("duplicate_rows", f"""SELECT 'staging.customers' AS "table", count(*) AS source_rows, count(DISTINCT {strip('customer_id')}) AS expected_rows,
  cast(0 AS bigint) AS excluded_keys, count(*) - count(DISTINCT {strip('customer_id')}) AS surplus_keys FROM raw_customers
UNION ALL SELECT 'staging.loans', count(*), count(DISTINCT loan_id) FILTER (WHERE {KEPT_RAW}), count(DISTINCT loan_id) FILTER (WHERE NOT {KEPT_RAW}),
  count(*) - count(DISTINCT loan_id) FROM raw_loans"""),
    "measure_reconciliation": f"""WITH {layers('dropped_join_key')}, {SEGMENT_SUMS}
SELECT 'raw->staging' AS transition, 'staging.loans' AS "table", segment, round(t0, 2) AS expected, round(t1, 2) AS actual, round(t1 - t0, 2) AS delta FROM seg
UNION ALL SELECT 'staging->final', 'final.loan_portfolio', segment, round(t1, 2), round(t2, 2), round(t2 - t1, 2) FROM seg""",
    "measure_drift": f"""WITH {findings_ctes('type_change')}
SELECT ii AS step, transition, "table", round(e, 2) AS expected_total, round(a, 2) AS actual_total,
  round(CASE WHEN e <> 0 THEN 100.0::double * (a - e) / e ELSE 0 END, 4) AS drift_pct FROM steps""",
    "mutate_type_change": over("type_change", "SELECT loan_id, source_system, balance FROM raw_loans"),
    "mutate_null": over("null_spike", "SELECT * FROM raw_customers"),
    "mutate_key": over("dropped_join_key", "SELECT loan_id, source_system, customer_id FROM stg_loans"),
    "mutate_duplicate": over("duplicate_rows", "SELECT * FROM stg_loans"),
    "mutate_messy_case": over("clean", """SELECT loan_id, CASE WHEN cast(substr(loan_id, 2) AS bigint) % 10 = 3 THEN lower(status) ELSE status END
  || CASE WHEN cast(substr(loan_id, 2) AS bigint) % 20 = 3 THEN ' ' ELSE '' END AS status FROM stg_loans"""),
    "mutation_truth": over("clean", """SELECT 'type_change' AS run_id, 'type_change' AS scenario, 'extract:loans' AS injected_at, 'balance' AS "column",
  'source_system = ''CORE_BANKING''' AS affected_segment, count(*) AS rows_affected FROM raw_loans WHERE source_system = 'CORE_BANKING'
UNION ALL SELECT 'duplicate_rows', 'duplicate_rows', 'staging:loans', 'loan_id', NULL, count(*) FROM stg_loans WHERE origination_date >= DATE '2000-08-01'"""),
    "finding_evidence": f"""WITH {layers('dropped_join_key')}, o AS ({ORPHANS}), pairs AS ({PAIRS}) SELECT * FROM (
SELECT 'key_integrity' AS "check", CASE WHEN count(DISTINCT segment) = 1 THEN 'source_system = ''' || min(segment) || '''' END AS affected_segment,
  CASE WHEN bool_and(padded) THEN 'leading zeros stripped - looks like the key was cast to an integer' END AS pattern, count(*) AS changed_rows,
  cast(NULL AS bigint) AS unmatched_rows, cast(NULL AS bigint) AS match_if_zero_padded, cast(NULL AS bigint) AS customer_key_length,
  (SELECT count(*) FROM o) AS rows_now_unmatched_in_customers, cast(NULL AS double) AS delta,
  cast(NULL AS varchar) AS sample_unmatched_keys, cast(NULL AS varchar) AS missing_types FROM pairs
UNION ALL
SELECT 'row_count', CASE WHEN count(DISTINCT source_system) = 1 THEN 'source_system = ''' || min(source_system) || '''' END, NULL, NULL, count(*),
  count(*) FILTER (WHERE lpad(customer_id, 8, '0') IN (SELECT customer_id FROM stg_customers)),
  (SELECT mode(length(customer_id)) FROM stg_customers), NULL, NULL,
  (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT DISTINCT customer_id AS k FROM o ORDER BY 1 LIMIT 3)),
  (SELECT string_agg(t, ', ' ORDER BY t) FROM (SELECT DISTINCT loan_type AS t FROM stg_loans EXCEPT SELECT loan_type FROM portfolio)) FROM o
UNION ALL
SELECT 'measure', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  round((SELECT sum(balance) FROM portfolio) - (SELECT sum(balance) FROM stg_loans), 2), NULL, NULL)""",
    "finding_segments": f"""WITH {layers('duplicate_rows')}, {SEGMENT_SUMS}
SELECT 'uniqueness' AS verdict, 'staging.loans' AS "table", source_system AS segment, count(*) - count(DISTINCT loan_id) AS extra_rows,
  cast(NULL AS double) AS expected, cast(NULL AS double) AS actual, cast(NULL AS double) AS delta FROM stg_loans GROUP BY source_system
UNION ALL SELECT 'measures', 'staging.loans', segment, NULL, round(t0, 2), round(t1, 2), round(t1 - t0, 2) FROM seg""",
    "ranked_findings": HIST + """SELECT run_id, cast(rank AS int) AS rank, CASE WHEN rank = 1 THEN 'root' ELSE 'symptom' END AS role, category,
  transition, "table", item_idx FROM ranked""",
    "root_causes": HIST + 'SELECT run_id, category, transition, "table", "column", message FROM roots',
    "check_verdicts": HIST + f"""SELECT r.run_id, v.verdict, CASE WHEN EXISTS (SELECT 1 FROM ranked f WHERE f.run_id = r.run_id AND f.verdict = v.verdict)
  THEN 'FAIL' ELSE 'PASS' END AS result FROM runs r, (VALUES {VERDICT_NAMES}) v(verdict)""",
    "run_status": HIST + "SELECT run_id, status, failures FROM statuses",
    "diagnosis_scores": HIST + "SELECT * FROM scores",
    "scores_by_scenario": HIST + "SELECT scenario, count(*) AS runs, round(avg(correct::int), 4) AS accuracy FROM scores GROUP BY scenario",
    "recent_runs": HIST + """SELECT run_id, scenario, started_at, status, root_cause FROM runs JOIN diagnoses USING (run_id)
  ORDER BY started_at DESC, run_id DESC LIMIT 20""",
    "latest_run": HIST + "SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1",
    "run_audit": HIST + """SELECT r.run_id, r.scenario, d.status, p.source AS report_by, coalesce(gate_failed, false) AS gate_failed,
  concat_ws('; ', CASE WHEN finished_at IS NULL THEN 'unfinished' END, CASE WHEN d.status IS NULL THEN 'no_diagnosis' END,
    CASE WHEN p.source IS NULL THEN 'no_report' END,
    CASE WHEN r.scenario = 'none' AND d.status <> 'HEALTHY' THEN 'sound_run_diagnosed' END,
    CASE WHEN r.scenario = 'none' AND gate_failed THEN 'sound_run_gated' END,
    CASE WHEN r.scenario <> 'none' AND d.status <> 'FAILED' THEN 'fault_not_diagnosed' END,
    CASE WHEN r.scenario <> 'none' AND NOT gate_failed THEN 'fault_not_gated' END) AS problems
  FROM runs r LEFT JOIN diagnoses d USING (run_id) LEFT JOIN reports p USING (run_id) LEFT JOIN gates g USING (run_id)""",
    "layer_flow": HIST + """, marks AS (SELECT run_id, transition, min(rank) AS best FROM ranked GROUP BY ALL),
sized AS (SELECT *, CASE layer WHEN 'raw' THEN 0 WHEN 'staging' THEN 1 ELSE 2 END AS layer_idx,
  CASE layer WHEN 'raw' THEN 'source->raw' WHEN 'staging' THEN 'raw->staging' ELSE 'staging->final' END AS transition FROM profiles)
SELECT s.run_id, layer_idx, layer, s.transition, row_count AS "rows",
  row_count - lag(row_count) OVER (PARTITION BY s.run_id ORDER BY layer_idx) AS delta, sum_value AS balance,
  CASE WHEN best = 1 THEN 'root' WHEN best > 1 THEN 'symptom' ELSE 'ok' END AS mark
FROM sized s LEFT JOIN marks m ON m.run_id = s.run_id AND m.transition = s.transition""",
    "impact_by_run": HIST + """SELECT run_id, max(row_count) FILTER (WHERE layer = 'final') AS final_loan_rows,
  max(row_count - duplicate_keys) FILTER (WHERE layer = 'final') AS final_distinct_loans, max(sum_value) FILTER (WHERE layer = 'final') AS final_total_balance,
  max(row_count) FILTER (WHERE layer = 'staging') AS staging_loan_rows FROM profiles GROUP BY run_id""",
    "truth_and_diagnosis": HIST + """SELECT s.run_id, s.scenario, k.injected_at, coalesce(k.rows_affected, 0) AS rows_affected, s.diagnosed_as,
  s.location_found, s.correct FROM scores s LEFT JOIN known k USING (run_id)""",
    "grounding": JUDGED + "SELECT run_id, grounded, md5(draft) AS draft_md5 FROM judged",
    "fill_sections": JUDGED + "SELECT run_id, cast(len(missing) AS int) AS missing_count, array_to_string(missing, ', ') AS missing FROM judged",
    "report_sources": NOTES,
    "report_markdown": REPORT_TEXT,
    "scenario_report": SCENARIO_NOTE,
    "fact_sheets": FACT_TEXT,
}
for _s in SCENARIOS:
    ORACLES[f"findings_{_s}"] = findings(_s)
    ORACLES[f"diagnosis_{_s}"] = diagnosis(_s)

TOTAL = "(SELECT sum(balance) FROM stg_loans)"
ORACLES |= {
    "clean_customers_blanks": ORACLES["clean_customers"],  # the blanks are all cut off
    "clean_loans_repeated_keys": over("clean", "SELECT loan_id, source_system, status, balance FROM stg_loans"),  # first arrivals stay
    "measure_drift_repeated_keys": over("clean", f"""SELECT transition, round({TOTAL}, 2) AS expected_total, round({TOTAL}, 2) AS actual_total,
  0.0::double AS drift_pct FROM (VALUES ('raw->staging'), ('staging->final')) t(transition)"""),
    "finding_values_dropped_join_key": over("dropped_join_key", """SELECT 'dropped_join_key' AS run_id, 'final.loan_portfolio' AS "table",
  'missing loan_type' AS kind, loan_type AS value FROM (SELECT loan_type FROM stg_loans EXCEPT SELECT loan_type FROM portfolio)"""),
    "findings_missing_column": """SELECT c AS run_id, 'SCHEMA_DRIFT' AS category, 'source->raw' AS transition, 'raw.loans' AS "table", c AS "column"
  FROM (VALUES ('balance'), ('source_system'), ('status'), ('customer_id')) t(c)""",
    "landed_then_cleaned": ORACLES["clean_loans"],
    "run_state": over("clean", """SELECT 'r1' AS run_id, 'none' AS scenario, true AS finished, layer, "table", n AS "rows" FROM (
  SELECT 'raw' AS layer, 'customers' AS "table", count(*) AS n FROM raw_customers UNION ALL SELECT 'raw', 'loans', count(*) FROM raw_loans
  UNION ALL SELECT 'staging', 'customers', count(*) FROM stg_customers UNION ALL SELECT 'staging', 'loans', count(*) FROM stg_loans
  UNION ALL SELECT 'final', 'loan_portfolio', count(*) FROM portfolio
  UNION ALL SELECT 'final', 'portfolio_summary', count(DISTINCT loan_type) FROM portfolio)"""),
    "layer_owner": "SELECT * FROM (VALUES ('raw', 'r2'), ('staging', 'r1'), ('final', 'r1')) t(layer, run_id)",
    "profiles_replaced": ORACLES["profile_raw_loans"],
    "report_roundtrip": ORACLES["diagnosis_null_spike"],
    "other_tables_run": f"WITH {supplies()} " + " UNION ALL ".join(
        f"""SELECT 'supplies' AS run_id, '{t.split(".")[0]}' AS layer, '{t.split(".")[1]}' AS "table", count(*) AS "rows" FROM {rel}""" for t, rel in SUPPLY_TABLES.items()),
    "other_tables_final": f"WITH {supplies()} SELECT * FROM revenue",
    "other_tables_findings": LOST_SUPPLIERS,
    "lost_customers_findings": LOST_CUSTOMERS,
    "landed_files_in_order": over("clean", f"""SELECT 'as_is' AS arrival, loan_id, balance FROM raw_loans WHERE {KEPT_RAW}
UNION ALL SELECT 'turned', loan_id, CASE WHEN cast(substr(loan_id, 2) AS bigint) % 5 = 0 THEN balance + 1000 ELSE balance END FROM raw_loans WHERE {KEPT_RAW}"""),
    "stored_profiles": f"""WITH {layers()} SELECT "table", "column", row_count, null_count, distinct_count, duplicate_keys FROM ({all_profiles('clean')})""",
    "summary_in_order": over("clean", """SELECT row_number() OVER (ORDER BY t DESC, loan_type)::int AS place, loan_type, t AS total_balance
FROM (SELECT loan_type, round(sum(balance), 2) AS t FROM portfolio GROUP BY loan_type)"""),
    "schema_scan": over("clean", " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", {i}::int AS position, '{c}' AS "column", '{k}' AS dtype, (SELECT count(*) FROM {TABLES[t][0]}) AS "rows" """
        for t in ("raw.loans", "staging.loans", "final.loan_portfolio") for i, (c, k) in enumerate(TABLES[t][1].items()))),
    "latest_run_flags": f"""WITH runs AS ({W.RUNS_SQL}) SELECT run_id, row_number() OVER (ORDER BY started_at DESC, run_id DESC) = 1 AS is_latest FROM runs""",
    "notes_stored": f"SELECT run_id, md5(markdown) AS markdown_md5 FROM ({NOTES_SQL})",
    "recorded_truth": over("clean", """SELECT 'r1' AS run_id, 'type_change' AS scenario, 'extract:loans' AS injected_at,
  count(*) FILTER (WHERE source_system = 'CORE_BANKING') AS rows_affected, 'source_system = ''CORE_BANKING''' AS description FROM raw_loans"""),
    "gate_in_plan": HIST + """, d AS (SELECT run_id FROM diagnosed), f AS (SELECT r.run_id, concat_ws(' ', r.run_id, r.category, r.transition,
  concat_ws('.', r."table", r."column"), r.message) AS line FROM ranked r JOIN d USING (run_id) WHERE r.rank = 1)
SELECT 'all' AS history, (SELECT count(*) FROM f) AS failures,
  (SELECT string_agg(line, '; ' ORDER BY run_id) FROM (SELECT * FROM f ORDER BY run_id LIMIT 3)) AS first_failures, cast(NULL AS varchar) AS status
UNION ALL SELECT 'sound', 0, '', 'HEALTHY'""",
    "mutate_null_hashed": over("clean", """SELECT loan_id, CASE WHEN ('0x' || substr(md5('42:' || loan_id), 1, 13))::bigint % 100 < 35 THEN NULL ELSE balance END AS balance
FROM raw_loans"""),
    "gate_summary": " UNION ALL ".join(
        f"""SELECT run_id, status, root_category AS category, root_transition AS transition, root_table AS "table", root_column AS "column",
  symptom_count AS symptoms, status = 'FAILED' AS stopped FROM ({ORACLES[f'diagnosis_{s}']}) AS {s}""" for s in ("clean", "null_spike")),
}
