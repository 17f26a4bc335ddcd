"""Layers derived from the benchmark tables.

The SQL texts run unchanged on Spark and on the oracle engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataudit.config import (
    AuditConfig,
    DistinctRule,
    Edge,
    Exclusion,
    KeyRule,
    MeasureRule,
    PassThroughRule,
    TableContract,
    Transform,
    columns,
    loan_config,
)
from strataudit.functions import exprs
from strataudit.operators import layers as L
from strataudit.operators import mutations as M
from strataudit.sources.layers import LayerStore, scratch_root
from strataudit.sources.local import together

RAW_CUSTOMERS_SQL = """
SELECT lpad(cast(c_custkey AS string), 8, '0') AS customer_id, c_name AS full_name,
  CASE WHEN c_custkey % 10 = 0 THEN lower(n_name) || ' ' ELSE n_name END AS state,
  cast(300 + floor((c_acctbal + 1000) / 20) AS bigint) AS credit_score,
  c_acctbal AS annual_income
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

RAW_LOANS_SQL = """
SELECT 'L' || lpad(cast(o_orderkey AS string), 9, '0') AS loan_id,
  lpad(cast(o_custkey AS string), 8, '0') AS customer_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MORTGAGE' WHEN '2-HIGH' THEN 'AUTO' WHEN '3-MEDIUM' THEN 'PERSONAL'
    WHEN '4-NOT SPECIFIED' THEN 'STUDENT' ELSE 'CREDIT_CARD' END AS loan_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'MORTGAGE_SVC' WHEN '5-LOW' THEN 'CARD_PLATFORM'
    ELSE 'CORE_BANKING' END AS source_system,
  o_totalprice AS principal, o_totalprice AS balance, cast(4 + o_orderkey % 25 AS double) / 100 AS interest_rate,
  cast(12 * (1 + o_orderkey % 30) AS bigint) AS term_months,
  CASE WHEN o_orderkey % 7 = 0 THEN lower(s0) || ' ' ELSE s0 END AS status, o_orderdate AS origination_date
FROM (SELECT *, CASE WHEN o_orderkey % 100 < 78 THEN 'CURRENT' WHEN o_orderkey % 100 < 85 THEN 'DELINQUENT_30'
        WHEN o_orderkey % 100 < 88 THEN 'DELINQUENT_90' WHEN o_orderkey % 100 < 90 THEN 'DEFAULT'
        WHEN o_orderkey % 100 < 97 THEN 'PAID_OFF' ELSE 'WITHDRAWN' END AS s0 FROM orders) o
"""

# the latest order date of the benchmark tables
AS_OF = "2001-08-01"

SCENARIOS = ("clean", "type_change", "null_spike", "dropped_join_key", "duplicate_rows")
SOURCES = ["CORE_BANKING", "CARD_PLATFORM", "MORTGAGE_SVC"]
LAYER_NAMES = ["raw", "staging", "final"]
LOAN_TABLES = {"raw": "raw.loans", "staging": "staging.loans", "final": "final.loan_portfolio"}

Tables = dict[str, DataFrame]


def config() -> AuditConfig:
    return loan_config(
        customer_columns="customer_id string, full_name string, state string, credit_score bigint, "
                         "annual_income double")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# 35 of every 100 customer numbers; the modulo form has a twin on the oracle engine, a hash has not
THIRD_OF_CUSTOMERS = "cast(customer_id AS bigint) % 100 < 35"


def raw_tables(spark: SparkSession, sf_dir: str, scenario: str = "clean") -> Tables:
    for name in ("customer", "nation", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    customers, loans = spark.sql(RAW_CUSTOMERS_SQL), spark.sql(RAW_LOANS_SQL)
    if scenario == "type_change":
        loans = M.number_to_text(loans, "balance", "source_system = 'CORE_BANKING'")
    if scenario == "null_spike":
        customers = M.null_out(customers, "credit_score", THIRD_OF_CUSTOMERS)
    return {"raw.customers": customers, "raw.loans": loans}


def repeated_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans of which every fifth arrives a second time, later and with a higher balance, as ``_ingest_seq`` tells."""
    loans = raw_tables(spark, sf_dir)["raw.loans"].selectExpr("*", "cast(substr(loan_id, 2) AS bigint) AS n")
    again = loans.filter("n % 5 = 0").selectExpr(*[c if c != "balance" else "balance + 1000 AS balance" for c in loans.columns])
    return loans.selectExpr("*", "2 * n AS _ingest_seq").unionByName(again.selectExpr("*", "2 * n + 1 AS _ingest_seq")).drop("n")


def staged_tables(raw: Tables, scenario: str = "clean") -> Tables:
    customers, loans = L.clean_customers(raw["raw.customers"]), L.clean_loans(raw["raw.loans"])
    if scenario == "dropped_join_key":
        loans = M.strip_leading_zeros(loans, "customer_id", "source_system = 'CARD_PLATFORM'")
    if scenario == "duplicate_rows":
        loans = M.repeat_recent(loans, "origination_date", AS_OF)
    return {"staging.customers": customers, "staging.loans": loans}


def layers(spark: SparkSession, sf_dir: str, scenario: str = "clean") -> Tables:
    """All layers as lazy frames."""
    raw = raw_tables(spark, sf_dir, scenario)
    staged = staged_tables(raw, scenario)
    final = L.loan_portfolio(staged["staging.loans"], staged["staging.customers"])
    return raw | staged | {"final.loan_portfolio": final}


def stored_layers(spark: SparkSession, sf_dir: str, scenario: str = "clean") -> Tables:
    """All layers, with staging and final written once: the audit reads them many times, and each column-pruned
    read of a table is far cheaper than repeating the de-duplication and the join. Raw is a projection of tables
    that are stored already."""
    store = LayerStore(spark, scratch_root(spark))
    raw = raw_tables(spark, sf_dir, scenario)
    lazy = staged_tables(raw, scenario)
    staged = dict(zip(lazy, together(*[lambda n=n: store.save(n, lazy[n]) for n in lazy])))
    final = L.loan_portfolio(staged["staging.loans"], staged["staging.customers"])
    return raw | staged | {"final.loan_portfolio": store.save("final.loan_portfolio", final)}


# ---------------------------------------------------------------- a second set of tables: what suppliers ship

RAW_SUPPLY_SQL = {
    "nations": "SELECT cast(n_nationkey AS bigint) AS nation_id, lower(n_name) || ' ' AS nation FROM nation",
    "suppliers": "SELECT 'S' || lpad(cast(s_suppkey AS string), 6, '0') AS supplier_id, cast(s_nationkey AS bigint) AS nation_id, s_acctbal AS account FROM supplier",
    "shipments": """SELECT concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string), cast(l_partkey AS string), cast(l_suppkey AS string)) AS line_id,
  'S' || lpad(cast(l_suppkey AS string), 6, '0') AS supplier_id, l_returnflag AS flag, l_extendedprice AS price, l_shipdate AS shipped FROM lineitem""",
}
SHIPMENTS = "line_id string, supplier_id string, flag string, price double, shipped timestamp_ntz"


def supply_config() -> AuditConfig:
    """Nations, suppliers and shipments, joined into supplies and summed up by nation. Returned lines (``A``) drop out."""
    nations, suppliers = columns("nation_id bigint, nation string"), columns("supplier_id string, nation_id bigint, account double")
    shipments, returned = columns(SHIPMENTS), Exclusion("flag", ("A",))
    supplies = columns("line_id string, supplier_id string, nation string, flag string, price double, shipped timestamp_ntz")

    def supply(t):
        home = t["staging.suppliers"].join(t["staging.nations"], "nation_id").select("supplier_id", "nation")
        return t["staging.shipments"].join(home, "supplier_id").select("line_id", "supplier_id", "nation", "flag", "price", "shipped")

    def by_nation(t):
        return t["final.supplies"].groupBy("nation").agg(*exprs("count(*) AS lines", "round(sum(price), 2) AS revenue"))

    return AuditConfig(
        contracts=(
            TableContract("raw.nations", nations, ("nation_id",)),
            TableContract("raw.suppliers", suppliers, ("supplier_id",)),
            TableContract("raw.shipments", shipments, ("line_id",)),
            TableContract("staging.nations", nations, ("nation_id",)),
            TableContract("staging.suppliers", suppliers, ("supplier_id",)),
            TableContract("staging.shipments", shipments, ("line_id",)),
            TableContract("final.supplies", supplies, ("line_id",)),
        ),
        edges=(
            Edge("raw.nations", "staging.nations"),
            Edge("raw.suppliers", "staging.suppliers"),
            Edge("raw.shipments", "staging.shipments"),
            Edge("staging.shipments", "final.supplies"),
            Edge("staging.suppliers", "final.supplies", "supplier_id"),
            Edge("staging.nations", "final.supplies", "nation"),
        ),
        segment_column="flag",
        date_column="shipped",
        key_rules=(KeyRule("raw.shipments", "staging.shipments", "line_id", "supplier_id", "staging.suppliers", "raw->staging", "lines"),),
        distinct_rules=(
            DistinctRule("raw.suppliers", "staging.suppliers", "supplier_id", "raw->staging", "suppliers"),
            DistinctRule("raw.shipments", "staging.shipments", "line_id", "raw->staging", "lines", exclusion=returned),
        ),
        pass_through_rules=(PassThroughRule("staging.shipments", "final.supplies", "staging->final", "supplier_id", "staging.suppliers",
                                            "flag", "lines"),),
        measure_rules=(MeasureRule("price", ("raw.shipments", "staging.shipments", "final.supplies"), ("raw->staging", "staging->final"),
                                   "line_id", returned),),
        # the last table first: a stage finds its own order
        transforms=(
            Transform("final.nation_revenue", ("final.supplies",), by_nation),
            Transform("final.supplies", ("staging.shipments", "staging.suppliers", "staging.nations"), supply),
            Transform("staging.nations", ("raw.nations",), lambda t: L.clean_table(t["raw.nations"], {"nation": "code"}, ["nation_id"])),
            Transform("staging.suppliers", ("raw.suppliers",), lambda t: L.clean_table(t["raw.suppliers"], {"supplier_id": "strip"}, ["supplier_id"])),
            Transform("staging.shipments", ("raw.shipments",),
                      lambda t: L.clean_table(t["raw.shipments"], {"supplier_id": "strip", "flag": "code"}, ["line_id"], returned)),
        ),
    )


def supply_sources(spark: SparkSession, sf_dir: str) -> Tables:
    for n in ("nation", "supplier", "lineitem"):
        table(spark, sf_dir, n).createOrReplaceTempView(n)
    return {n: spark.sql(text) for n, text in RAW_SUPPLY_SQL.items()}
