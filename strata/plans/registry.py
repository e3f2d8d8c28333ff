"""Registered queries: one per operator, each run over the whole test tables.

Every query derives its inputs from the given tables with Spark, runs the operator (writing
to fresh folders and tables under the shared root where the operator does I/O) and returns
a DataFrame.  ``ORACLE_SQL`` holds the same result as plain SQL over the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ledger import LedgerTable
from strata.operators.sinks import export_csv, guarded_export, write_dataset
from strata.operators.tables import (append_load, clear_table, create_if_absent, drop_if_exists,
                                     footer_count_gate, full_refresh_load, row_count_gate)
from strata.operators.transforms import (classified_review, movie_analytics, review_logs,
                                         user_purchase)
from strata.plans import inputs
from strata.plans.jobs import (SILVER_USER_PURCHASE, FlowPaths, bronze_to_gold, run,
                               session_smoke, show_table)
from strata.plans.resume import resumable_flow
from strata.schemas import MOVIE_ANALYTICS, REVIEW_LOGS, USER_PURCHASE, USER_PURCHASE_VARCHAR
from strata.session import delete_path, scratch_path, scratch_table
from strata.sources.csv import naming_bad_csv_record, read_bronze_csv, read_csv_typed
from strata.sources.datasets import SCHEMA_NEEDED, read_dataset
from strata.sources.records import BadRecordError
from strata.sources.tables import read_table
from strata.streaming.arrival import arrival_load

# Word list for the classified-review queries.  The test prose is invented and holds no
# sentiment words, so the list names words that occur in it; "the" and "and" are English
# stop words and must therefore never make a review positive.
QUERY_POSITIVE_WORDS = ("der", "die", "que", "und", "the", "and")

ROUNDTRIP_FORMATS = ("parquet", "orc", "json", "csv", "xml")

SHOW_N = 20


# --- helpers -------------------------------------------------------------------

def _discard(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate outputs the returned DataFrame no longer reads."""
    for path in paths:
        delete_path(spark, path)


def _exported_purchases(spark: SparkSession, sf_dir: str, tag: str) -> str:
    path = scratch_path(spark, tag)
    export_csv(inputs.purchases(spark, sf_dir), path)
    return path


def _purchases_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase input computed once and written as parquet to the shared scratch folder,
    for queries that load it more than once (cuts the lineage; removed with the scratch)."""
    path = write_dataset(inputs.purchases(spark, sf_dir), scratch_path(spark, "purchases"), "parquet")
    return read_dataset(spark, path, "parquet", USER_PURCHASE)


def _loaded_table(spark: SparkSession, sf_dir: str, tag: str, source: DataFrame | None = None) -> str:
    name = scratch_table(spark, tag)
    create_if_absent(spark, name)
    append_load(spark, name, source if source is not None else inputs.purchases(spark, sf_dir))
    return name


def _bronze_reviews(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "movie_review_csv")
    export_csv(inputs.reviews(spark, sf_dir), path)
    return path


def _bronze_logs(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "log_reviews_csv")
    export_csv(inputs.review_log_xml(spark, sf_dir), path)
    return path


# --- sources -------------------------------------------------------------------

def q_csv_typed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_typed(spark, _exported_purchases(spark, sf_dir, "typed_read"), USER_PURCHASE)


MULTI_LINE_DETAIL = "\nsays \"{n}\",\r\nat length"  # added to a purchase's detail: quotes and newlines


def q_csv_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split_read")
    before, after = MULTI_LINE_DETAIL.split("{n}")
    rows = inputs.purchases(spark, sf_dir)
    export_csv(rows.withColumn("detail", F.concat("detail", F.lit(before), "country", F.lit(after))), path)
    return read_csv_typed(spark, path, USER_PURCHASE, multi_line="split")


def q_csv_bad_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The purchases of the first order get a quantity that is no number; the load must say so.
    path = scratch_path(spark, "bad_record")
    rows = inputs.purchases(spark, sf_dir)
    first = rows.agg(F.min(F.col("invoice_number").cast("long"))).first()[0]
    bad = F.col("invoice_number") == str(first)
    export_csv(rows.withColumn("quantity", F.when(bad, "many").otherwise(F.col("quantity").cast("string"))), path)
    try:
        with naming_bad_csv_record(spark, path):
            write_dataset(read_csv_typed(spark, path), scratch_path(spark, "never"))
    except BadRecordError as exc:
        return spark.createDataFrame([(exc.column, exc.value, exc.text.split(",")[0])],
                                     "column_name string, value string, invoice_number string")
    raise AssertionError("the bad record passed")


def q_bronze_csv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze_csv(spark, _bronze_reviews(spark, sf_dir), "movie_review")


def q_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _loaded_table(spark, sf_dir, "scan"))


def q_dataset_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first format is written from the joined input; the others from that written
    # copy, so the joins run once.  Text formats, several times the input's size, are compressed.
    source = inputs.purchases(spark, sf_dir)
    out = None
    for fmt in ROUNDTRIP_FORMATS:
        path = write_dataset(source, scratch_path(spark, f"dataset_{fmt}"), fmt,
                             compression="gzip" if fmt in SCHEMA_NEEDED else None)
        back = read_dataset(spark, path, fmt, USER_PURCHASE)
        if fmt == "parquet":
            source = back
        back = back.withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


def q_arrival_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _exported_purchases(spark, sf_dir, "landing")
    name = scratch_table(spark, "arrival")
    checkpoint = scratch_path(spark, "arrival_ckpt")
    first = arrival_load(spark, landing, name, checkpoint)
    second = arrival_load(spark, landing, name, checkpoint)
    if len(first.batches) != 1 or second.batches:
        raise AssertionError(f"expected one batch then none, got {first.batches} / {second.batches}")
    _discard(spark, landing, checkpoint)
    return read_table(spark, name)


def q_arrival_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two arrivals of the whole purchase export; append mode keeps both.
    landing = scratch_path(spark, "landing_append")
    name = scratch_table(spark, "arrival_append")
    checkpoint = scratch_path(spark, "arrival_append_ckpt")
    source = _purchases_once(spark, sf_dir)
    batches = []
    for arrival in ("first", "second"):
        export_csv(source, f"{landing}/{arrival}")
        batches += arrival_load(spark, f"{landing}/*", name, checkpoint, mode="append").batches
    if len(batches) != 2:
        raise AssertionError(f"expected one batch per arrival, got {batches}")
    _discard(spark, landing, checkpoint)
    return read_table(spark, name)


# --- table lifecycle -------------------------------------------------------------

def q_create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _loaded_table(spark, sf_dir, "create")
    create_if_absent(spark, name)  # already present: must keep the rows
    return read_table(spark, name)


def q_clear_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _purchases_once(spark, sf_dir)
    name = _loaded_table(spark, sf_dir, "clear", source)
    clear_table(spark, name)
    append_load(spark, name, source)
    return read_table(spark, name)


def q_drop_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _purchases_once(spark, sf_dir)
    name = _loaded_table(spark, sf_dir, "drop", source)
    drop_if_exists(spark, name)
    drop_if_exists(spark, name)
    create_if_absent(spark, name)
    append_load(spark, name, source)
    return read_table(spark, name)


def q_row_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "gate")
    create_if_absent(spark, name)
    # Materialise the empty-table gate (one row) before loading, since plans are lazy.
    empty = row_count_gate(read_table(spark, name)).first()
    append_load(spark, name, inputs.purchases(spark, sf_dir))
    empty_df = spark.createDataFrame(
        [("empty", empty.total_rows, empty.proceed)],
        "input string, total_rows bigint, proceed boolean")
    loaded = row_count_gate(read_table(spark, name)).select(
        F.lit("loaded").alias("input"), "total_rows", "proceed")
    return empty_df.unionByName(loaded)


def q_footer_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row a table, all of them rows of the footers.
    gates = []
    for name in inputs.TABLES:
        gate = footer_count_gate(spark, f"{sf_dir.rstrip('/')}/{name}.parquet").first()
        gates.append((name, gate.total_rows, gate.proceed))
    return spark.createDataFrame(gates, "name string, total_rows bigint, proceed boolean")


def q_append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _purchases_once(spark, sf_dir)
    name = _loaded_table(spark, sf_dir, "append", source)
    append_load(spark, name, source)
    return read_table(spark, name)


def q_full_refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = _exported_purchases(spark, sf_dir, "refresh_src")
    name = scratch_table(spark, "refresh")
    for _ in range(2):
        full_refresh_load(spark, name, read_csv_typed(spark, csv))
    _discard(spark, csv)
    return read_table(spark, name)


# --- ledger tables -----------------------------------------------------------------

def _ledger_table(spark: SparkSession, tag: str) -> LedgerTable:
    table = LedgerTable(spark, scratch_path(spark, tag))
    table.create(USER_PURCHASE, USER_PURCHASE_VARCHAR)
    return table


def q_ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two batches; the first is written once more by a load that never made its entry, and
    # both are loaded again.
    source = _purchases_once(spark, sf_dir)
    table = _ledger_table(spark, "ledger_append")
    table.stage(source)
    for batch in (0, 0, 1, 1):
        table.append(source, "loader", batch)
    return table.read()


def q_ledger_arrival_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two arrivals; the stream then forgets that it finished the second batch and runs it again.
    landing, checkpoint = scratch_path(spark, "landing_once"), scratch_path(spark, "arrival_once_ckpt")
    table = _ledger_table(spark, "arrival_once")
    source = _purchases_once(spark, sf_dir)
    for arrival in ("first", "second"):
        export_csv(source, f"{landing}/{arrival}")
        arrival_load(spark, f"{landing}/*", table, checkpoint, mode="append")
    delete_path(spark, f"{checkpoint}/commits/1")
    again = arrival_load(spark, f"{landing}/*", table, checkpoint, mode="append")
    if (again.batches, again.rows) != ([1], 0):
        raise AssertionError(f"expected batch 1 again without rows, got {again}")
    _discard(spark, landing, checkpoint)
    return table.read()


def q_ledger_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The count is the one that the entry states: no file is read for it.
    source = _purchases_once(spark, sf_dir)
    table = _ledger_table(spark, "ledger_refresh")
    for _ in range(2):
        table.stage(source)
        table.refresh(source)
    return table.read().withColumn("total_rows", F.lit(table.rows()).cast("long"))


def q_atomic_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _purchases_once(spark, sf_dir)
    path = scratch_path(spark, "atomic_export")
    statuses = [guarded_export(rows, path, atomic=True).status for rows in (source, source, source.where(F.lit(False)))]
    return read_dataset(spark, path, "csv").withColumn("statuses", F.lit(",".join(statuses)))


# --- sinks -------------------------------------------------------------------

def q_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _exported_purchases(spark, sf_dir, "export")
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in USER_PURCHASE])
    return read_csv_typed(spark, path, as_text, varchar_limits={})


def q_guarded_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = read_table(spark, _loaded_table(spark, sf_dir, "guarded"))  # gate on the loaded table
    path = scratch_path(spark, "guarded")
    first = guarded_export(up, path)
    second = guarded_export(up.where(F.lit(False)), path)  # empty input: old export stays
    statuses = f"{first.status},{second.status}"
    return read_csv_typed(spark, path).withColumn("statuses", F.lit(statuses))


# --- transforms and jobs -------------------------------------------------------

def q_review_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_logs(read_bronze_csv(spark, _bronze_logs(spark, sf_dir), "log_review"))


def q_classified_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_bronze_csv(spark, _bronze_reviews(spark, sf_dir), "movie_review")
    return classified_review(raw, QUERY_POSITIVE_WORDS)


def q_user_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_purchase(read_csv_typed(spark, _exported_purchases(spark, sf_dir, "up_src")))


def q_movie_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = inputs.table(spark, sf_dir, "events").select(*[f.name for f in REVIEW_LOGS])
    return movie_analytics(inputs.purchases(spark, sf_dir),
                           classified_review(inputs.reviews(spark, sf_dir), QUERY_POSITIVE_WORDS),
                           logs)


def q_movie_analytics_all_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = inputs.table(spark, sf_dir, "events").select(*[f.name for f in REVIEW_LOGS])
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return movie_analytics(inputs.purchases(spark, sf_dir),
                           classified_review(inputs.reviews(spark, sf_dir), QUERY_POSITIVE_WORDS),
                           logs, customers=customers)


def q_show_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = scratch_path(spark, "show_silver")
    write_dataset(review_logs(inputs.review_log_xml(spark, sf_dir)), silver, "parquet")
    return show_table(spark, silver, "parquet", str(SHOW_N), order_by=["event_id"],
                      schema=REVIEW_LOGS)


def q_session_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_smoke(spark, inputs.table(spark, sf_dir, "lineitem"))


def q_bronze_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = FlowPaths(
        landing=_exported_purchases(spark, sf_dir, "flow_landing"),
        purchase_table=scratch_table(spark, "flow_purchase"),
        export=scratch_path(spark, "flow_export"),
        movie_review_csv=_bronze_reviews(spark, sf_dir),
        log_reviews_csv=_bronze_logs(spark, sf_dir),
        silver_root=scratch_path(spark, "flow_silver"),
        gold_root=scratch_path(spark, "flow_gold"),
    )
    result = bronze_to_gold(spark, paths, "parquet", QUERY_POSITIVE_WORDS)
    _discard(spark, paths.landing, paths.export, paths.movie_review_csv, paths.log_reviews_csv,
             paths.silver_root)
    drop_if_exists(spark, paths.purchase_table)
    return read_dataset(spark, result.gold, "parquet", MOVIE_ANALYTICS)


def q_resumed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first run has no review logs to read and fails there; the second goes on from it.
    paths = FlowPaths(
        landing=_exported_purchases(spark, sf_dir, "resumed_landing"),
        purchase_table=scratch_path(spark, "resumed_purchase"),
        export=scratch_path(spark, "resumed_export"),
        movie_review_csv=_bronze_reviews(spark, sf_dir),
        log_reviews_csv=scratch_path(spark, "resumed_logs"),
        silver_root=scratch_path(spark, "resumed_silver"),
        gold_root=scratch_path(spark, "resumed_gold"),
    )
    state = scratch_path(spark, "resumed_state")
    try:
        resumable_flow(spark, paths, state, "parquet", QUERY_POSITIVE_WORDS)
        raise AssertionError("a flow without review logs passed")
    except AnalysisException:
        pass
    export_csv(inputs.review_log_xml(spark, sf_dir), paths.log_reviews_csv)
    flow = resumable_flow(spark, paths, state, "parquet", QUERY_POSITIVE_WORDS)
    if flow.ran != ["movie_analytics", "review_logs"]:
        raise AssertionError(f"expected the failed step and what depends on it, got {flow.ran}")
    _discard(spark, paths.landing, paths.export, paths.movie_review_csv, paths.log_reviews_csv, paths.silver_root, paths.purchase_table)
    return read_dataset(spark, flow.gold)


def q_job_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _exported_purchases(spark, sf_dir, "job_src")
    out = scratch_path(spark, "job_silver") + f"/{SILVER_USER_PURCHASE}"
    run(spark, "up", in_csv=src, out=out, fmt="parquet")
    _discard(spark, src)
    return read_dataset(spark, out, "parquet", USER_PURCHASE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_typed_read": q_csv_typed_read,
    "csv_split_read": q_csv_split_read,
    "csv_bad_record": q_csv_bad_record,
    "bronze_csv_read": q_bronze_csv_read,
    "table_scan": q_table_scan,
    "dataset_format_roundtrip": q_dataset_format_roundtrip,
    "arrival_load": q_arrival_load,
    "arrival_append": q_arrival_append,
    "create_if_absent": q_create_if_absent,
    "clear_table": q_clear_table,
    "drop_if_exists": q_drop_if_exists,
    "row_count_gate": q_row_count_gate,
    "footer_count_gate": q_footer_count_gate,
    "append_load": q_append_load,
    "full_refresh_load": q_full_refresh_load,
    "ledger_append": q_ledger_append,
    "ledger_arrival_append": q_ledger_arrival_append,
    "ledger_refresh": q_ledger_refresh,
    "atomic_export": q_atomic_export,
    "csv_export": q_csv_export,
    "guarded_export": q_guarded_export,
    "review_logs": q_review_logs,
    "classified_review": q_classified_review,
    "user_purchase": q_user_purchase,
    "movie_analytics": q_movie_analytics,
    "movie_analytics_all_customers": q_movie_analytics_all_customers,
    "show_table": q_show_table,
    "session_smoke": q_session_smoke,
    "bronze_to_gold": q_bronze_to_gold,
    "resumed_flow": q_resumed_flow,
    "job_by_name": q_job_by_name,
}


# --- oracle SQL ------------------------------------------------------------------

PURCHASES_SQL = """
select cast(o_orderkey as varchar) as invoice_number, cast(l_partkey as varchar) as stock_code,
       p_name as detail, cast(l_quantity as int) as quantity, o_orderdate as invoice_date,
       cast(p_retailprice as decimal(8,3)) as unit_price, cast(c_custkey as int) as customer_id,
       n_name as country
from lineitem join orders on l_orderkey = o_orderkey
     join customer on o_custkey = c_custkey
     join part on l_partkey = p_partkey
     join nation on c_nationkey = n_nationkey
"""

REVIEWS_SQL = """
select conv_id as customer_id, turn as review_id, text as review_text
from conversations
"""

# "the" and "and" of QUERY_POSITIVE_WORDS are English stop words, so only these can match.
CLASSIFIED_SQL = r"""
select customer_id, review_id,
       cast(list_has_any(
              list_filter(regexp_split_to_array(lower(coalesce(review_text, '')), '[^\p{L}\p{N}]+'),
                          lambda t: t <> ''),
              ['der', 'die', 'que', 'und']) as int) as positive_review
from (""" + REVIEWS_SQL + ")"

LOGS_SQL = "select event_id, ts, user_id, event_type, value from events"

# Joins of per-customer aggregates, unlike the union that the transform groups.
ANALYTICS_SQL = """
with p as (
  select cast(customer_id as bigint) as customer_id,
         sum(cast(quantity as decimal(10,0)) * unit_price) as amount
  from (""" + PURCHASES_SQL + """) where customer_id is not null group by 1
), r as (
  select customer_id, sum(positive_review) as score, count(*) as n
  from (""" + CLASSIFIED_SQL + """) where customer_id is not null group by 1
), l as (
  select user_id as customer_id, count(*) as n, max(ts) as last_log
  from (""" + LOGS_SQL + """) where user_id is not null group by 1
), k as (
  select customer_id from p union select customer_id from r union select customer_id from l {customers}
)
select k.customer_id, cast(coalesce(p.amount, 0) as decimal(38,3)) as amount_spent,
       cast(coalesce(r.score, 0) as bigint) as review_score, coalesce(r.n, 0) as review_count,
       coalesce(l.n, 0) as log_count, l.last_log
from k left join p on p.customer_id = k.customer_id left join r on r.customer_id = k.customer_id
     left join l on l.customer_id = k.customer_id
"""

ALL_CUSTOMERS_SQL = "union select c_custkey from customer"

CSV_EXPORT_SQL = """
select cast(invoice_number as varchar) as invoice_number, stock_code, detail,
       cast(quantity as varchar) as quantity,
       strftime(invoice_date, '%Y-%m-%d %H:%M:%S') as invoice_date,
       cast(unit_price as varchar) as unit_price, cast(customer_id as varchar) as customer_id,
       country
from (""" + PURCHASES_SQL + ")"

ROUNDTRIP_SQL = "\nunion all\n".join(
    f"select *, '{fmt}' as fmt from ({PURCHASES_SQL})" for fmt in ROUNDTRIP_FORMATS)

ORACLE_SQL: dict[str, str] = {
    "csv_typed_read": PURCHASES_SQL,
    "csv_split_read": (
        "select * replace (detail || chr(10) || 'says \"' || country || '\",' || chr(13) || chr(10) || 'at length' as detail)\n"
        f"from ({PURCHASES_SQL})"),
    "csv_bad_record": (
        "select 'quantity' as column_name, 'many' as value, cast(min(l_orderkey) as varchar) as invoice_number from lineitem"),
    "bronze_csv_read": REVIEWS_SQL,
    "table_scan": PURCHASES_SQL,
    "dataset_format_roundtrip": ROUNDTRIP_SQL,
    "arrival_load": PURCHASES_SQL,
    "arrival_append": f"select * from ({PURCHASES_SQL})\nunion all\nselect * from ({PURCHASES_SQL})",
    "create_if_absent": PURCHASES_SQL,
    "clear_table": PURCHASES_SQL,
    "drop_if_exists": PURCHASES_SQL,
    "row_count_gate": (
        "select 'empty' as input, cast(0 as bigint) as total_rows, false as proceed\n"
        "union all\n"
        "select 'loaded' as input, count(*) as total_rows, count(*) > 0 as proceed from ("
        + PURCHASES_SQL + ")"),
    "footer_count_gate": "\nunion all\n".join(
        f"select '{name}' as name, count(*) as total_rows, count(*) > 0 as proceed from {name}" for name in inputs.TABLES),
    "append_load": f"select * from ({PURCHASES_SQL})\nunion all\nselect * from ({PURCHASES_SQL})",
    "full_refresh_load": PURCHASES_SQL,
    "ledger_append": f"select * from ({PURCHASES_SQL})\nunion all\nselect * from ({PURCHASES_SQL})",
    "ledger_arrival_append": f"select * from ({PURCHASES_SQL})\nunion all\nselect * from ({PURCHASES_SQL})",
    "ledger_refresh": f"select *, count(*) over () as total_rows from ({PURCHASES_SQL})",
    "atomic_export": f"select *, 'exported,exported,skipped' as statuses from ({PURCHASES_SQL})",
    "csv_export": CSV_EXPORT_SQL,
    "guarded_export": f"select *, 'exported,skipped' as statuses from ({PURCHASES_SQL})",
    "review_logs": LOGS_SQL,
    "classified_review": CLASSIFIED_SQL,
    "user_purchase": PURCHASES_SQL,
    "movie_analytics": ANALYTICS_SQL.replace("{customers}", ""),
    "movie_analytics_all_customers": ANALYTICS_SQL.replace("{customers}", ALL_CUSTOMERS_SQL),
    "show_table": f"{LOGS_SQL} order by event_id limit {SHOW_N}",
    "session_smoke": "select count(*) as row_count, true as ok from lineitem",
    "bronze_to_gold": ANALYTICS_SQL.replace("{customers}", ""),
    "resumed_flow": ANALYTICS_SQL.replace("{customers}", ""),
    "job_by_name": PURCHASES_SQL,
}
