"""Derived inputs: altered copies, column sheets, audit logs, scripts, catalog tables.

Each is a projection of a whole given table, stated once as expressions that Spark and the
oracle both accept, so that its size grows with the table. The modulo conditions plant known
defects (lost, changed, repeated rows) into a full copy; they do not thin out the input.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from reconlake.operators.counts import stack

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# a column of each given table by which defects are planted
KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_partkey",
    "events": "event_id",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}
DATE_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. The lazy frame is kept, so its schema is read from the files once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Derived:
    """A table made from a given one: columns as SQL expressions, and an optional filter."""

    base: str
    columns: dict[str, str] = field(default_factory=dict)
    where: str | None = None

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, self.base)
        if self.where:
            df = df.where(self.where)
        if not self.columns:
            return df
        return df.selectExpr(*[f"{e} AS {n}" for n, e in self.columns.items()])

    def sql(self) -> str:
        select = ", ".join(f"{e} AS {n}" for n, e in self.columns.items()) or "*"
        where = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {select} FROM {self.base}{where}"


@dataclass(frozen=True)
class Stacked:
    parts: tuple[Derived, ...]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return stack(p.frame(spark, sf_dir) for p in self.parts)

    def sql(self) -> str:
        return " UNION ALL ".join(p.sql() for p in self.parts)


def ctes(**named: Derived | Stacked) -> str:
    return "WITH " + ", ".join(f"{n} AS ({d.sql()})" for n, d in named.items())


_PRIORITY = "CASE WHEN o_orderkey % 53 = 0 THEN CAST(NULL AS string) ELSE o_orderpriority END"
_ORDER = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "o_totalprice",
    "o_orderdate": "o_orderdate",
    "o_orderpriority": _PRIORITY,
}

# Orders and a copy with lost, changed, additional and repeated rows; some priorities are NULL.
ORDERS_SRC = Derived("orders", _ORDER)
ORDERS_TGT = Stacked(
    (
        Derived(
            "orders",
            {
                **_ORDER,
                "o_totalprice": "CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 "
                "ELSE o_totalprice END",
            },
            "o_orderkey % 97 <> 0",
        ),
        Derived(
            "orders",
            {
                **_ORDER,
                "o_orderkey": "o_orderkey + 10000000",
                "o_orderdate": "o_orderdate + INTERVAL 3650 DAY",
            },
            "o_orderkey % 89 = 0",
        ),
        Derived("orders", _ORDER, "o_orderkey % 211 = 0"),
    )
)
PAIR = ctes(orders_src=ORDERS_SRC, orders_tgt=ORDERS_TGT)


def orders_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ORDERS_SRC.frame(spark, sf_dir), ORDERS_TGT.frame(spark, sf_dir)


def altered(name: str) -> Stacked:
    """A copy of a given table that lost some rows and repeats others."""
    key = KEYS[name]
    return Stacked(
        (Derived(name, {}, f"{key} % 97 <> 3"), Derived(name, {}, f"{key} % 211 = 1"))
    )


def same_copy(name: str) -> Derived:
    return Derived(name)


# Column sheet: each order is a table of the sheet and each of its items a column.
_SHEET = {
    "schema_name": "'s_' || l_returnflag",
    "table_name": "'t_' || l_orderkey",
    "column_name": "CASE WHEN l_discount > 0.09 AND l_linenumber = 1 THEN 'created' "
    "WHEN l_discount > 0.09 AND l_linenumber = 2 THEN 'updatedAt' ELSE 'c_' || l_partkey END",
    "data_type": "CASE WHEN l_discount < 0.02 THEN 'date' WHEN l_tax < 0.01 THEN 'timestamp' "
    "WHEN l_tax < 0.02 THEN 'timestamp_ntz' WHEN l_tax < 0.03 THEN 'timestamptz' "
    "ELSE 'varchar' END",
    "ordinal_position": "l_linenumber",
}
SHEET = Derived("lineitem", _SHEET)
# The same sheet as another catalog shows it: other letter case, some types changed, some lost.
OTHER_SHEET = Derived(
    "lineitem",
    {
        **_SHEET,
        "column_name": f"upper({_SHEET['column_name']})",
        "data_type": f"CASE WHEN l_suppkey % 7 = 0 THEN 'text' ELSE {_SHEET['data_type']} END",
    },
    "l_partkey % 50 <> 7",
)

# Tables to look up in the sheet, written in capitals.
WANTED = Derived(
    "orders",
    {
        "schema_name": "CASE o_orderstatus WHEN 'P' THEN 'S_A' WHEN 'O' THEN 'S_N' ELSE 'S_R' END",
        "table_name": "'T_' || o_orderkey",
    },
)

# Audit events: one table per user, the kind of event stands for a status.
AUDIT = Derived(
    "events",
    {
        "run_id": "'r' || event_id",
        "table_name": "'sales.t_' || user_id",
        "event_time": "ts",
        "status": "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'IN_PROGRESS' "
        "WHEN 'signup' THEN 'SKIPPED' ELSE 'SUCCESS' END",
        "rows_processed": "event_id",
    },
)
TASKS = Derived("customer", {"table_name": "'sales.t_' || c_custkey", "segment": "c_mktsegment"})

# Scripts: each document is the leading comment of one.
SCRIPTS = Derived(
    "documents",
    {
        "file_path": "'jobs/' || lang || '/' || source || '/' || doc_id || '.sql'",
        "text": "'-- ' || text || chr(10) || 'INSERT INTO mart.' || lang || '_' || source || "
        "' SELECT d.* FROM raw.' || source || ' d' || chr(10) || '  join ref.' || lang || "
        "' l ON d.lang = l.code;' || chr(10) || '; merge into audit.' || source || "
        "' USING raw.' || lang || ' r LEFT JOIN raw.' || source || ' x ON true;' || chr(9) || "
        "'TRUNCATE TABLE stage.' || source || ' ; CREATE TABLE IF NOT EXISTS mart.extra(a int)'",
    },
)
SCRIPT_TABLES = Derived("documents", {"schema_name": "'raw'", "table_name": "source"})

# Jobs: one script per customer over order tables (dated) and customer tables (dateless).
JOBS = Derived(
    "customer",
    {
        "file_path": "'jobs/' || c_mktsegment || '/' || c_custkey || '.sql'",
        "text": "CASE WHEN c_nationkey < 3 THEN 'UPDATE mart.t_' || c_nationkey || ' SET a = 1' "
        "WHEN c_nationkey < 6 THEN 'INSERT INTO mart.t_' || c_nationkey || ' SELECT * FROM lost.t_' "
        "|| c_nationkey WHEN c_nationkey < 11 THEN 'INSERT INTO mart.t_' || c_nationkey || "
        "' SELECT * FROM crm.' || c_mktsegment WHEN c_acctbal < 2000 THEN 'INSERT INTO mart.t_' "
        "|| c_nationkey || ' SELECT * FROM sales.F_2' WHEN c_acctbal < 5000 THEN "
        "'INSERT INTO mart.t_' || c_nationkey || ' SELECT * FROM sales.O_1 a JOIN crm.' || "
        "c_mktsegment || ' b ON a.k = b.k' ELSE 'INSERT INTO mart.t_' || c_nationkey || "
        "' SELECT * FROM sales.P_3 a JOIN sales.O_4 b ON a.k = b.k' END",
    },
)
_ORDER_TABLE = "'sales.' || o_orderstatus || '_' || substr(o_orderpriority, 1, 1)"
JOB_ORDERS_SRC = Derived("orders", {"table_name": _ORDER_TABLE, "d": "o_orderdate"})
JOB_ORDERS_TGT = Derived(
    "orders",
    {"table_name": _ORDER_TABLE, "d": "o_orderdate"},
    "o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderkey % 97 <> 0) "
    "OR (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00')",
)
_CRM_TABLE = "'crm.' || c_mktsegment"
JOB_CUSTOMERS_SRC = Derived("customer", {"table_name": _CRM_TABLE})
JOB_CUSTOMERS_TGT = Derived(
    "customer", {"table_name": _CRM_TABLE}, "c_mktsegment <> 'MACHINERY' OR c_custkey % 97 <> 0"
)
_MART_TABLE = "'mart.t_' || c_nationkey"
JOB_MART_SRC = Derived("customer", {"table_name": _MART_TABLE})
JOB_MART_TGT = Derived("customer", {"table_name": _MART_TABLE}, "c_nationkey > 20 OR c_acctbal > 0")
JOBS_SINCE = "1998-01-01"

# Storage rows and catalog tables of a remote database.
STORAGE = Derived(
    "lineitem",
    {
        "schema_name": "'s_' || l_returnflag",
        "anchor_table_name": "'t_' || l_orderkey",
        "projection_id": "l_partkey",
        "is_super_projection": "l_linestatus = 'O'",
        "total_row_count": "CAST(l_quantity AS bigint) * 100",
        "deleted_row_count": "CAST(l_linenumber AS bigint)",
    },
)
INFO_TABLES = Derived(
    "lineitem",
    {
        "schema_name": "'s_' || l_returnflag",
        "table_name": "'t_' || l_orderkey",
        "row_count": "CAST(l_quantity AS bigint) * 100 - l_linenumber",
    },
    "l_linestatus = 'O'",
)
LISTED = Derived(
    "lineitem",
    {"schema_name": "'s_' || l_returnflag", "table_name": "'t_' || l_orderkey"},
)
CAT_TABLES = Derived(
    "orders",
    {
        "table_id": "o_orderkey",
        "table_schema": "'s_' || (o_orderkey % 7)",
        "table_name": "'t_' || o_orderkey",
        "is_temp_table": "o_totalprice < 50000",
        "is_flextable": "o_orderpriority = '5-LOW'",
        "owner_name": "'u_' || o_custkey",
        "is_system_table": "o_orderpriority = '1-URGENT'",
    },
)
CAT_VIEWS = Derived(
    "orders",
    {"table_id": "o_orderkey", "view_definition": "'select ' || o_custkey"},
    "o_totalprice > 400000",
)
CAT_STORAGE = Derived(
    "lineitem",
    {
        "anchor_table_schema": "'s_' || (l_orderkey % 7)",
        "anchor_table_name": "'t_' || l_orderkey",
        "used_bytes": "CAST(floor(l_extendedprice) AS bigint)",
        "row_count": "CAST(l_quantity AS bigint)",
    },
)
CAT_PROJECTIONS = Derived(
    "lineitem",
    {
        "anchor_table_id": "l_orderkey",
        "projection_id": "l_partkey",
        "is_segmented": "l_returnflag = 'A'",
        "segment_expression": "'hash(' || l_suppkey || ')'",
    },
)
_CONSTRAINT = "l_orderkey * 10 + l_linenumber"
CAT_CONSTRAINTS = Derived(
    "lineitem",
    {
        "constraint_id": _CONSTRAINT,
        "table_id": "l_orderkey",
        "constraint_type": "CASE WHEN l_linestatus = 'O' THEN 'p' ELSE 'f' END",
        "constraint_name": "'k_' || l_orderkey || '_' || l_linenumber || l_linestatus",
    },
    "l_linenumber < 5",
)
CAT_CONSTRAINT_COLUMNS = Derived(
    "lineitem",
    {"constraint_id": _CONSTRAINT, "table_id": "l_orderkey", "column_name": "'c_' || l_linenumber"},
    "l_linenumber < 5",
)
CAT_COLUMNS = Derived(
    "lineitem",
    {
        "table_id": "l_orderkey",
        "table_schema": "'s_' || (l_orderkey % 7)",
        "table_name": "'t_' || l_orderkey",
        "column_name": "'c_' || l_linenumber",
        "data_type": "CASE WHEN l_returnflag = 'A' THEN 'numeric(12,2)' ELSE 'varchar(40)' END",
        "is_nullable": "l_linestatus = 'O'",
        "column_default": "CASE WHEN l_discount > 0.05 THEN '0' END",
        "ordinal_position": "l_linenumber",
        "character_maximum_length": "CASE WHEN l_returnflag = 'A' THEN NULL ELSE 40 END",
        "numeric_precision": "CASE WHEN l_returnflag = 'A' THEN 12 END",
        "numeric_scale": "CASE WHEN l_returnflag = 'A' THEN 2 END",
    },
)
