"""Registered queries over the benchmark tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLES[name]`` is an
independent SQL statement over the same parquet tables. Outputs are made
engine-neutral at the last step only (:func:`finalize`): decimals become
doubles, small integers bigints, timestamps text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, FloatType, IntegerType, ShortType,
                               TimestampNTZType, TimestampType)

from sheetlake.plans import reports as R
from sheetlake.plans import testdata as T
from sheetlake.plans.sqlbits import flexible_date_sql, ts_text
from sheetlake.operators.keys import exclude_keys, keep_keys
from sheetlake.operators.rollup import Measure, conditional_rollup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, TS_FORMAT)
        elif isinstance(t, (DecimalType, FloatType)):
            c = c.cast("double")
        elif isinstance(t, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: finalize(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


RULES = T.MAPPED_RULES
MAP = T.MAPPING_SQL
LIVE = """
live AS (FROM sales_revenue s ANTI JOIN cancellation_bills c ON s.ma_hoa_don = c.ma_hoa_don)"""
# Net revenue in whole cents and percents: no decimal rounding of the engine is involved.
PERCENT = """CASE WHEN loai_doanh_thu = 'ECONOMY' AND ten_doi_tuong_thanh_toan IN ('1-URGENT', '2-HIGH') THEN -85
       WHEN ten_doi_tuong_thanh_toan IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 0
       WHEN loai_doanh_thu = 'ECONOMY' THEN 15 ELSE 100 END"""
REVENUE = f"""(SELECT sign(v) * ((abs(v) + 5000) // 10000)
    FROM (SELECT CAST(so_tien_thuc_te_thu * 100 AS BIGINT) * ({PERCENT}) AS v))"""
PERIOD = "CAST(ngay_ghi AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-07-15'"


def _largest(key: str, columns: list[str], source: str, time: str) -> str:
    """The row of each key that is largest by (time, other columns): a maximum
    over structs, as the rows compared hold no NULL that the order decides."""
    fields = ", ".join(f"{c}: {c}" for c in [time, *[c for c in columns if c != time]])
    return f"SELECT {key}, unnest(max({{{fields}}})) FROM {source} GROUP BY {key}"


# ---------------------------------------------------------------- reports ---

_SPEND_BILL = ["id_khach_hang", "loai_du_lieu", "loai_doanh_thu", "san_pham", "ten_doi_tuong_thanh_toan",
               "so_tien_thuc_te_thu"]


@register("customer_spending", f"""{MAP}, {LIVE},
people AS ({_largest("id", R.SPENDING_CUSTOMER_COLUMNS[1:], "customer_data", "ngay_cuoi_cap_nhat")}),
bills AS ({_largest("ma_hoa_don", _SPEND_BILL, f"(FROM live WHERE {PERIOD})", "ngay_cap_nhat_hoa_don_cuoi")}),
spent AS (SELECT *, {REVENUE} AS r FROM bills),
totals AS (
  SELECT id_khach_hang AS id, sum(r) AS tongdt,
    count(*) FILTER (loai_doanh_thu = 'STANDARD') AS so_don_thuoc,
    count(*) FILTER (loai_du_lieu = 'F' AND loai_doanh_thu = 'MEDIUM' AND regexp_matches(san_pham, 'ring|bolt'))
      AS so_lan_len_goi,
    sum(r) FILTER (loai_doanh_thu = 'STANDARD') AS dt_thuoc,
    sum(r) FILTER (loai_doanh_thu = 'PROMO' OR loai_doanh_thu = 'LARGE') AS dt_bdvasp,
    sum(r) FILTER (loai_doanh_thu = 'SMALL') AS dt_fnb,
    sum(r) FILTER (loai_doanh_thu NOT SIMILAR TO 'STANDARD|PROMO|LARGE') AS dt_khongdungthuoc
  FROM spent GROUP BY ALL),
days AS (SELECT id_khach_hang AS id, min(ngay_ghi)::DATE AS "Ngay_dau_tien", max(ngay_ghi)::DATE AS "Ngay_cuoi_cung"
         FROM live GROUP BY ALL)
SELECT people.id, {", ".join(c for c in R.SPENDING_CUSTOMER_COLUMNS if c not in ("id", "ngay_sinh"))},
  {flexible_date_sql("ngay_sinh")} AS ngay_sinh_chuan, "Ngay_dau_tien", "Ngay_cuoi_cung", so_don_thuoc, so_lan_len_goi,
  {", ".join(f"ifnull({c}, 0)::DOUBLE AS {c}" for c in ("dt_thuoc", "dt_bdvasp", "dt_fnb", "dt_khongdungthuoc", "tongdt"))}
FROM people JOIN totals USING (id) LEFT JOIN days USING (id)
""")
def customer_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 (flagship): per-customer spending in the period."""
    return R.customer_spending(*T.report_inputs(spark, sf_dir), rules=RULES)


_REF_BILL = ["id_khach_hang", "loai_doanh_thu", "ten_doi_tuong_thanh_toan", "so_tien_thuc_te_thu"]


@register("referral_spending", f"""{MAP}, {LIVE},
people AS ({_largest("id", R.REFERRER, "customer_data", "ngay_cuoi_cap_nhat")}),
bills AS ({_largest("ma_hoa_don", _REF_BILL, f"(FROM live WHERE {PERIOD})", "ngay_cap_nhat_hoa_don_cuoi")}),
spent AS (SELECT id_khach_hang AS id, sum({REVENUE}) AS total FROM bills GROUP BY ALL)
SELECT {", ".join(R.REFERRER)}, count(*) AS slf1, sum(total)::DOUBLE AS dtf1
FROM spent JOIN people USING (id) GROUP BY ALL
""")
def referral_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period revenue of referred customers per referrer."""
    return R.referral_spending(*T.report_inputs(spark, sf_dir), rules=RULES)


_BILL_OUT = ", ".join(ts_text(c) if c in ("ngay_ghi", "ngay_cap_nhat_hoa_don_cuoi")
                      else f"{c}::DOUBLE AS {c}" if c == "so_tien_thuc_te_thu" else c for c in R.BILL_COLUMNS)
_CURRENT = f"""{MAP}, {LIVE},
tops AS (SELECT ma_hoa_don, max(ngay_cap_nhat_hoa_don_cuoi) AS top FROM live GROUP BY ma_hoa_don),
lines AS (SELECT DISTINCT live.* FROM live JOIN tops ON live.ma_hoa_don IS NOT DISTINCT FROM tops.ma_hoa_don
          AND ngay_cap_nhat_hoa_don_cuoi = top)"""


@register("current_bills", f"""{_CURRENT}
SELECT {_BILL_OUT}, 1::BIGINT AS "Rank_HD", {REVENUE}::DOUBLE AS revenue FROM lines
""")
def current_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current lines of every live bill with net revenue."""
    sales, _, cancel = T.report_inputs(spark, sf_dir)
    return R.current_bills(sales, cancel, RULES)


_VISIT_SQL = f"""{MAP}, {LIVE},
names AS (SELECT id, arg_max(ten_khach_hang, {{t: ngay_cuoi_cap_nhat, n: ten_khach_hang}}) AS ten_khach_hang
          FROM customer_data GROUP BY id)
SELECT id, ten_khach_hang, {{cols}}
FROM live LEFT JOIN names ON id = id_khach_hang GROUP BY ALL
"""
_FIRST, _LAST = 'min(ngay_ghi)::DATE AS "Ngay_dau_tien"', 'max(ngay_ghi)::DATE AS "Ngay_cuoi_cung"'


@register("visit_bounds", _VISIT_SQL.replace("{cols}", f"{_FIRST}, {_LAST}"))
def visit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 + R5: first and last visit per customer in one aggregate."""
    return R.visit_bounds(*T.report_inputs(spark, sf_dir))


@register("first_visit", _VISIT_SQL.replace("{cols}", _FIRST))
def first_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First visit day per customer."""
    return R.first_visit(*T.report_inputs(spark, sf_dir))


@register("last_visit", _VISIT_SQL.replace("{cols}", _LAST))
def last_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last visit day per customer."""
    return R.last_visit(*T.report_inputs(spark, sf_dir))


_CUST_OUT = ", ".join(ts_text(c) if c == "ngay_cuoi_cap_nhat" else c for c in R.CUSTOMER_COLUMNS)


@register("latest_customer", f"""{MAP},
newest AS ({_largest("id", R.CUSTOMER_COLUMNS[1:], "customer_data", "ngay_cuoi_cap_nhat")})
SELECT {_CUST_OUT}, newest.ngay_cuoi_cap_nhat::DATE AS "Ngayudpate", 1::BIGINT AS "Ngaymoinhat" FROM newest
""")
def latest_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of every customer."""
    return R.latest_customer(T.customers(spark, sf_dir))


@register("daily_revenue", f"""{MAP}
SELECT CAST(ngay_ghi AS DATE) AS ngay_ghi, CAST(sum(so_tien_thuc_te_thu) AS DOUBLE) AS doanh_thu
FROM sales_revenue GROUP BY 1 ORDER BY 1 DESC
""")
def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per entry day, newest first."""
    return R.daily_revenue(T.sales(spark, sf_dir), amount_col="so_tien_thuc_te_thu", rules=RULES)


@register("net_revenue", f"""{MAP}
SELECT ma_hoa_don, id_khach_hang, ten_doi_tuong_thanh_toan, loai_doanh_thu,
       so_tien_thuc_te_thu::DOUBLE AS so_tien_thuc_te_thu, {REVENUE}::DOUBLE AS revenue
FROM sales_revenue
""")
def net_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue rule on every sales line."""
    sales = T.sales(spark, sf_dir).select(
        "ma_hoa_don", "id_khach_hang", "ten_doi_tuong_thanh_toan", "loai_doanh_thu",
        "so_tien_thuc_te_thu")
    return R.with_revenue(sales, RULES)


@register("revenue_by_kind", f"""{_CURRENT}, priced AS (SELECT *, {REVENUE} AS r FROM lines)
SELECT loai_doanh_thu, loai_du_lieu, count(*) AS n_lines, sum(r)::DOUBLE AS tongdt,
  ifnull(sum(r) FILTER (loai_doanh_thu NOT SIMILAR TO 'STANDARD|PROMO|LARGE'), 0)::DOUBLE AS dt_khongdungthuoc,
  ifnull(sum(r) FILTER (regexp_matches(san_pham, 'ring|bolt')), 0)::DOUBLE AS dt_goi
FROM priced GROUP BY ALL
""")
def revenue_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional revenue measures of the current bills per type and data kind."""
    sales, _, cancel = T.report_inputs(spark, sf_dir)
    return R.revenue_by_kind(sales, cancel, RULES)


_LINE_COLS = ["ma_hoa_don", "id_khach_hang", "san_pham", "ngay_cap_nhat_hoa_don_cuoi", "so_tien_thuc_te_thu"]
_LINE_SQL = ", ".join(ts_text(c) if c == "ngay_cap_nhat_hoa_don_cuoi"
                      else f"{c}::DOUBLE AS {c}" if c == "so_tien_thuc_te_thu" else c for c in _LINE_COLS)


@register("cancelled_excluded", f"""{MAP}, {LIVE}
SELECT {_LINE_SQL} FROM live
""")
def cancelled_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: sales lines of bills that were not cancelled (anti join)."""
    sales, _, cancel = T.report_inputs(spark, sf_dir)
    return exclude_keys(sales.select(*_LINE_COLS), cancel, "ma_hoa_don")


@register("cancelled_only", f"""{MAP}
SELECT {_LINE_SQL} FROM sales_revenue SEMI JOIN cancellation_bills USING (ma_hoa_don)
""")
def cancelled_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: sales lines of cancelled bills (semi join)."""
    sales, _, cancel = T.report_inputs(spark, sf_dir)
    return keep_keys(sales.select(*_LINE_COLS), cancel, "ma_hoa_don")


@register("newest_line", f"""{MAP}
SELECT ma_hoa_don, id_khach_hang, {ts_text("ngay_ghi")} FROM sales_revenue
ORDER BY ngay_ghi DESC NULLS FIRST, ma_hoa_don DESC, id_khach_hang DESC LIMIT 1
""")
def newest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the newest sales line (ORDER BY ... LIMIT 1; a top-1 per task, no full sort)."""
    return (T.sales(spark, sf_dir).select("ma_hoa_don", "id_khach_hang", "ngay_ghi")
            .orderBy(F.col("ngay_ghi").desc_nulls_first(), F.col("ma_hoa_don").desc(), F.col("id_khach_hang").desc())
            .limit(1))


_SALE = {"herbal": "loai_doanh_thu = 'STANDARD'", "package":
         "loai_du_lieu = 'F' AND loai_doanh_thu = 'MEDIUM' AND (contains(san_pham, 'ring') OR contains(san_pham, 'bolt'))"}


@register("bill_measures", f"""{MAP}, {LIVE}, priced AS (SELECT *, {REVENUE} AS r FROM live WHERE {PERIOD})
SELECT id_khach_hang, count(DISTINCT CASE WHEN {_SALE["herbal"]} THEN ma_hoa_don END) AS so_don_thuoc,
  count(DISTINCT CASE WHEN {_SALE["package"]} THEN ma_hoa_don END) AS so_lan_len_goi,
  count(DISTINCT ma_hoa_don) AS so_hoa_don, count(DISTINCT CASE WHEN r > 0 THEN san_pham END) AS so_san_pham,
  count(*) AS so_dong, sum(CASE WHEN {_SALE["herbal"]} THEN r ELSE 0 END)::DOUBLE AS dt_thuoc, sum(r)::DOUBLE AS tongdt,
  max(CASE WHEN {_SALE["package"]} THEN r END)::DOUBLE AS goi_lon_nhat
FROM priced GROUP BY id_khach_hang
""")
def bill_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct bills and products and revenue per customer under
    conditions, over uncut sales lines (a bill repeats with every line)."""
    sales, _, cancel = T.report_inputs(spark, sf_dir)
    lines = R.with_revenue(exclude_keys(R.in_period(sales, RULES), cancel, "ma_hoa_don"), RULES)
    kind, product = F.col("loai_doanh_thu"), F.col("san_pham")
    herbal = kind == RULES.herbal_kind
    package = ((F.col("loai_du_lieu") == RULES.package_data_kind) & (kind == RULES.package_kind)
               & R.any_of([product.contains(w) for w in RULES.package_product_words]))
    return conditional_rollup(lines, ["id_khach_hang"], {
        "so_don_thuoc": Measure("count_distinct", "ma_hoa_don", herbal),
        "so_lan_len_goi": Measure("count_distinct", "ma_hoa_don", package),
        "so_hoa_don": Measure("count_distinct", "ma_hoa_don"),
        "so_san_pham": Measure("count_distinct", "san_pham", F.col("revenue") > 0),
        "so_dong": Measure("count", F.lit(1)),
        "dt_thuoc": Measure("sum", "revenue", herbal, default=0),
        "tongdt": Measure("sum", "revenue"),
        "goi_lon_nhat": Measure("max", "revenue", package)})


# ----------------------------------------------------------------- ledger ---
from sheetlake.operators import ledger as L  # noqa: E402
from sheetlake.operators import tables as TB  # noqa: E402

LMAP = T.LEDGER_MAPPING_SQL
# A file's newest row is the maximum of (undated, time, id); what it says decides the file's state.
_LATEST_OPS_SQL = """
latest AS (
  SELECT file_path, unnest(max({u: last_loaded_at IS NULL, t: last_loaded_at, i: id, r: {id: id, table_name: table_name,
    last_loaded_at: last_loaded_at, row_count: row_count, status: status, operation: operation}}).r)
  FROM ledger GROUP BY file_path
), active AS (
  FROM latest SELECT file_path, table_name
  WHERE CASE operation WHEN 'DELETED' THEN false WHEN 'INSERT' THEN status != 'failed' WHEN 'UPDATE' THEN status != 'failed'
        ELSE operation IS NULL AND status = 'success' END
)"""


@register("latest_ops", f"""{LMAP}, {_LATEST_OPS_SQL}
SELECT id, file_path, table_name, strftime(last_loaded_at, '%Y-%m-%d %H:%M:%S.%f') AS last_loaded_at,
       CAST(row_count AS BIGINT) AS row_count, status, operation,
       COALESCE(operation IN ('INSERT', 'UPDATE'), false)
         OR (operation IS NULL AND COALESCE(status = 'success', false)) AS is_loaded
FROM latest
""")
def latest_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2/F8: newest ledger row per file with its loaded flag."""
    return L.latest_ops(T.ledger(spark, sf_dir))


@register("ledger_state", f"""{LMAP}, {_LATEST_OPS_SQL}
SELECT file_path, table_name, strftime(last_loaded_at, '%Y-%m-%d %H:%M:%S.%f') AS last_loaded_at, status, operation FROM latest
""")
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F8: the compacted state of the older half of the log, merged with
    the rows that came after it, equals the newest rows of the whole log."""
    ledger = T.ledger(spark, sf_dir)
    middle = ledger.select(F.percentile_approx("id", 0.5)).scalar()
    state = L.latest_ops(ledger.filter(F.col("id") <= middle))
    newest = L.merge_latest(state, ledger.filter(F.col("id") > middle))
    return newest.select("file_path", "table_name", "last_loaded_at", "status", "operation")


@register("active_sources", f"""{LMAP}, {_LATEST_OPS_SQL}
SELECT file_path, table_name FROM active
""")
def active_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """files whose rows are live."""
    return L.active_files(T.ledger(spark, sf_dir))


_DELETED_SQL = f"""{LMAP}, {_LATEST_OPS_SQL}, gone AS (
  SELECT a.file_path, a.table_name FROM active a LEFT JOIN listing l ON a.file_path = l.rel_path
  WHERE l.rel_path IS NULL
)"""


@register("deleted_sources", f"""{_DELETED_SQL}
SELECT file_path, table_name FROM gone
""")
def deleted_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """active files missing from the folder listing."""
    return L.deleted_sources(L.active_files(T.ledger(spark, sf_dir)), T.listing(spark, sf_dir))


@register("classify_ops", f"""{LMAP}, {_LATEST_OPS_SQL}
SELECT l.rel_path,
       CASE WHEN COALESCE(COALESCE(t.operation IN ('INSERT', 'UPDATE'), false)
                 OR (t.operation IS NULL AND COALESCE(t.status = 'success', false)), false)
            THEN 'UPDATE' ELSE 'INSERT' END AS operation
FROM listing l LEFT JOIN latest t ON l.rel_path = t.file_path
""")
def classify_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT or UPDATE for each listed file."""
    return L.classify_ops(T.listing(spark, sf_dir), T.ledger(spark, sf_dir))


@register("run_log", f"""{LMAP}
SELECT run_id, mode, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
       strftime(finished_at, '%Y-%m-%d %H:%M:%S.%f') AS finished_at,
       files_processed, files_skipped, errors
FROM runs
""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per run folded from its start and finish events."""
    return L.run_log(T.run_events(spark, sf_dir))


@register("last_run_time", f"""{LMAP}
SELECT strftime(max(started_at), '%Y-%m-%d %H:%M:%S.%f') AS last_run_started_at
FROM runs WHERE finished_at IS NOT NULL
""")
def last_run_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """start of the newest finished run."""
    return L.last_run_time(L.run_log(T.run_events(spark, sf_dir)))


@register("run_summary", f"""{LMAP}
SELECT CAST(strftime(last_loaded_at, '%Y%m%d') AS BIGINT) AS run_id,
       count(*) FILTER (WHERE operation IN ('INSERT', 'UPDATE') AND status <> 'failed') AS files_processed,
       count(*) FILTER (WHERE status = 'failed') AS files_skipped,
       count(*) FILTER (WHERE operation = 'DELETED') AS files_deleted,
       count(*) FILTER (WHERE operation IS NULL) AS files_legacy
FROM ledger GROUP BY 1
""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processed / skipped / deleted counters per run."""
    led = T.ledger(spark, sf_dir).withColumn(
        "run_id", F.date_format("last_loaded_at", "yyyyMMdd").cast("bigint"))
    return L.run_summary(led, "run_id")


@register("row_count_audit", f"""{MAP}, {T.LEDGER_SQL}
SELECT 'sales_revenue' AS table_name, count(*) AS n_rows FROM sales_revenue
UNION ALL SELECT 'customer_data', count(*) FROM customer_data
UNION ALL SELECT 'cancellation_bills', count(*) FROM cancellation_bills
UNION ALL SELECT '_load_metadata', count(*) FROM ledger
""")
def row_count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count per table as a UNION ALL."""
    sales, cust, cancel = T.report_inputs(spark, sf_dir)
    return L.row_count_audit({"sales_revenue": sales, "customer_data": cust,
                              "cancellation_bills": cancel, "_load_metadata": T.ledger(spark, sf_dir)})


@register("rows_per_source", f"""{LMAP}
SELECT source_file, count(*) AS n_rows FROM events_table GROUP BY source_file
""")
def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows per source file."""
    return L.rows_per_source(T.events_table(spark, sf_dir))


_EV_OUT = ("event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props, "
           "source_file")


@register("replace_by_source", f"""{LMAP},
last_run AS (SELECT max(started_at) AS t FROM runs WHERE finished_at IS NOT NULL),
base AS (SELECT * FROM events_table WHERE ts <= (SELECT t FROM last_run)),
changed AS (SELECT DISTINCT source_file FROM events_table WHERE ts > (SELECT t FROM last_run)),
fresh AS (SELECT e.* FROM events_table e JOIN changed c ON e.source_file = c.source_file),
replaced AS (
  SELECT b.* FROM base b LEFT JOIN changed c ON b.source_file = c.source_file WHERE c.source_file IS NULL
  UNION ALL SELECT * FROM fresh)
SELECT {_EV_OUT} FROM replaced
""")
def replace_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files changed since the last finished run are re-read whole and
    replace their earlier rows (the result equals a full reload)."""
    ev = T.events_table(spark, sf_dir)
    since = L.last_run_time(L.run_log(T.run_events(spark, sf_dir))).scalar()
    base = ev.filter(F.col("ts") <= since)
    changed = ev.filter(F.col("ts") > since).select("source_file").distinct()
    fresh = keep_keys(ev, changed, "source_file")
    return TB.replace_by_source(base, fresh, sources=changed)


_ARCHIVE_SQL = f"""{_DELETED_SQL}
SELECT {_EV_OUT} FROM events_table e
WHERE {{cond}} (SELECT 1 FROM gone g WHERE g.file_path = e.source_file)
"""


@register("archive_kept", _ARCHIVE_SQL.replace("{cond}", "NOT EXISTS"))
def archive_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: rows that stay in the table after archiving vanished files."""
    gone = L.deleted_sources(L.active_files(T.ledger(spark, sf_dir)), T.listing(spark, sf_dir))
    kept, _ = TB.archive_split(T.events_table(spark, sf_dir), gone)
    return kept


@register("archive_moved", _ARCHIVE_SQL.replace("{cond}", "EXISTS"))
def archive_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows moved to the archive table (without the time stamp)."""
    gone = L.deleted_sources(L.active_files(T.ledger(spark, sf_dir)), T.listing(spark, sf_dir))
    _, moved = TB.archive_split(T.events_table(spark, sf_dir), gone)
    return moved.drop("deleted_at")


# ------------------------------------------------------ cleaning & typing ---
from sheetlake.functions import cleaning as C  # noqa: E402
from sheetlake.functions.dates import parse_flexible_date  # noqa: E402
from sheetlake.functions.keys import row_key as _row_key  # noqa: E402
from sheetlake.functions.names import fold_name as _fold_name  # noqa: E402
from sheetlake.operators import coerce as CO  # noqa: E402
from sheetlake.operators import typing_ as TY  # noqa: E402


def _strip_sql(x: str) -> str:
    # what Python calls blank, spelled as Unicode space classes
    blank = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
    return f"regexp_replace({x}, '^{blank}+|{blank}+$', '', 'g')"


def _ident_sql(x: str) -> str:
    s = _strip_sql(x)
    whole = f"ltrim(ltrim(split_part({s}, '.', 1), '+-'), '0')"
    return (f"CASE WHEN nullif(nullif({s}, ''), '.0') IS NULL THEN NULL"
            f" WHEN regexp_full_match({s}, '[-+]?\\d+([.]0+)?')"
            f" THEN CASE WHEN {whole} = '' THEN '0' WHEN starts_with({s}, '-') THEN '-' || {whole} ELSE {whole} END"
            f" ELSE {s} END")


def _contact_sql(x: str) -> str:
    s = _strip_sql(x)
    return f"CASE WHEN regexp_full_match({s}, '[0-9]+\\.0+') THEN regexp_extract({s}, '^([0-9]+)', 1) ELSE {s} END"


def _text_sql(x: str) -> str:
    return f"CASE WHEN {_strip_sql(x)} = '.0' THEN '' ELSE {x} END"


@register("clean_identifier", f"""WITH {T.IDENTIFIER_CELLS_SQL}
SELECT o_orderkey, id_khach_hang AS id_raw, {_ident_sql("id_khach_hang")} AS id_khach_hang FROM cells
""")
def clean_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier cells to canonical integer text."""
    cells = T.identifier_cells(spark, sf_dir)
    return cells.select("o_orderkey", F.col("id_khach_hang").alias("id_raw"),
                        C.clean_identifier(F.col("id_khach_hang")).alias("id_khach_hang"))


@register("clean_contact", f"""WITH {T.IDENTIFIER_CELLS_SQL}
SELECT o_orderkey, thong_tin_nguoi_than AS contact_raw,
       {_contact_sql("thong_tin_nguoi_than")} AS thong_tin_nguoi_than FROM cells
""")
def clean_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The free-text contact column."""
    cells = T.identifier_cells(spark, sf_dir)
    return cells.select("o_orderkey", F.col("thong_tin_nguoi_than").alias("contact_raw"),
                        C.clean_contact(F.col("thong_tin_nguoi_than")).alias("thong_tin_nguoi_than"))


@register("clean_text", f"""WITH {T.IDENTIFIER_CELLS_SQL}
SELECT o_orderkey, ly_do_huy AS text_raw, {_text_sql("ly_do_huy")} AS ly_do_huy FROM cells
""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: ``.0`` text cells to empty text."""
    cells = T.identifier_cells(spark, sf_dir)
    return cells.select("o_orderkey", F.col("ly_do_huy").alias("text_raw"),
                        C.clean_text(F.col("ly_do_huy")).alias("ly_do_huy"))


@register("clean_cells", f"""WITH {T.IDENTIFIER_CELLS_SQL}
SELECT o_orderkey, {_ident_sql("id_khach_hang")} AS id_khach_hang,
       {_contact_sql("thong_tin_nguoi_than")} AS thong_tin_nguoi_than,
       {_text_sql("ly_do_huy")} AS ly_do_huy FROM cells
""")
def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column cleaned by the rule its name selects."""
    return C.clean_cells(T.identifier_cells(spark, sf_dir))


_PROFILED = ["so_luong", "ty_le", "ngay_giao", "ngay_cap_nhat", "co", "so_dong", "ghi_chu", "ngay_loi"]


def _profile_sql(c: str) -> str:
    t = f"trim({c})"
    filled = f"{c} IS NOT NULL AND {t} <> ''"
    num = f"regexp_full_match({t}, '[-+]?(\\d+|\\d*[.]\\d+)')"
    ts = f"regexp_full_match({t}, '\\d{{4}}(-\\d\\d){{2}}([T ]\\d\\d(:\\d\\d){{2}}([.]\\d+)?)?')"
    return (f"SELECT '{c}' AS column_name,"
            f" count(*) FILTER (WHERE {filled}) AS non_blank,"
            f" count(*) FILTER (WHERE {c} IS NOT NULL AND {t} = '') AS blank_cells,"
            f" count(*) FILTER (WHERE {filled} AND NOT {num}) AS numeric_violations,"
            f" count(*) FILTER (WHERE {filled} AND NOT {ts}) AS timestamp_violations,"
            f" count(*) FILTER (WHERE {filled} AND {ts} AND TRY_CAST({t} AS TIMESTAMP) IS NULL)"
            f" AS timestamp_cast_failures,"
            f" CAST(max(CASE WHEN {filled} AND {num} THEN length(regexp_extract({t}, '^[+-]?0*([0-9]*)', 1)) END)"
            f" AS BIGINT) AS int_digits,"
            f" CAST(max(CASE WHEN {filled} AND {num} THEN length(regexp_extract({t}, '\\.([0-9]+)$', 1)) END)"
            f" AS BIGINT) AS scale FROM landing")


_PROFILE_SQL = f"""WITH {T.LANDING_SQL}, prof AS (
{" UNION ALL ".join(_profile_sql(c) for c in _PROFILED)}
)
SELECT *, CASE
  WHEN numeric_violations = 0 AND blank_cells = 0
       AND greatest(COALESCE(int_digits, 0) + COALESCE(scale, 0), 1) <= 38
    THEN printf('decimal(38,%d)', COALESCE(scale, 0))
  WHEN timestamp_violations = 0 AND timestamp_cast_failures = 0 AND blank_cells = 0 AND non_blank > 0
    THEN 'timestamp'
  ELSE 'string' END AS promoted_type
FROM prof
"""


@register("type_profile", _PROFILE_SQL)
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-pass profile of every text column and the type it earns."""
    return TY.decide_types(TY.type_profile(T.landing_text(spark, sf_dir)))


@register("merged_profile", _PROFILE_SQL)
def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of single files, added up, decide as one pass over the whole text does."""
    return TY.decide_types(TY.merge_profiles(TY.source_profiles(T.landing_text(spark, sf_dir))))


@register("promote_types", f"""WITH {T.LANDING_SQL}
SELECT source_file, ma_hoa_don, row_no,
       CAST(trim(so_luong) AS DOUBLE) AS so_luong, CAST(trim(ty_le) AS DOUBLE) AS ty_le,
       strftime(CAST(trim(ngay_giao) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS ngay_giao,
       strftime(CAST(trim(ngay_cap_nhat) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS ngay_cap_nhat,
       co, so_dong, CAST(NULL AS DOUBLE) AS ghi_chu, ngay_loi
FROM landing
""")
def promote_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table with its columns promoted."""
    return TY.promote_types(T.landing_text(spark, sf_dir))


@register("parse_flexible_date", f"""WITH {T.DATE_CELLS_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, ngay_sinh_raw,
       {flexible_date_sql("ngay_sinh_raw")} AS ngay_sinh FROM cells
""")
def flexible_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in any of the export layouts."""
    cells = T.date_cells(spark, sf_dir)
    return cells.withColumn("ngay_sinh", parse_flexible_date(F.col("ngay_sinh_raw")))


@register("row_key", f"""
SELECT {T.MONTH_FILE_SQL} AS source_file, l_orderkey * 8 + l_linenumber AS row_no,
       md5(concat_ws('|', {T.MONTH_FILE_SQL}, CAST(l_orderkey * 8 + l_linenumber AS VARCHAR))) AS row_key
FROM lineitem
""")
def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable row keys from file and row number."""
    li = T.table(spark, sf_dir, "lineitem")
    rows = li.select(T._month_file().alias("source_file"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_no"))
    return rows.withColumn("row_key", _row_key(F.col("source_file"), F.col("row_no")))


@register("fold_name", """
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE COALESCE(NULLIF(trim(
  regexp_replace(regexp_replace(replace(lower(strip_accents(replace(replace(text, 'Đ', 'D'), 'đ', 'd'))),
                 '%', 'per'), '[()]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'col') END AS folded
FROM documents
""")
def fold_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: the name-folding rule over whole document texts."""
    docs = T.table(spark, sf_dir, "documents")
    return docs.select("doc_id", _fold_name(F.col("text")).alias("folded"))


_COERCE_SQL = f"""WITH {T.TYPED_CELLS_SQL}, typed AS (
  SELECT source_file, l_orderkey, l_linenumber,
    CAST(CASE WHEN regexp_full_match({_strip_sql("so_luong")}, '[-+]?\\d+')
              THEN TRY_CAST({_strip_sql("so_luong")} AS INTEGER) END AS BIGINT) AS q,
    CASE WHEN regexp_full_match({_strip_sql("don_gia")},
              '(?i)[-+]?((\\d+[.]?|\\d*[.]\\d+)(e[-+]?\\d+)?|inf(inity)?|nan)')
         THEN TRY_CAST({_strip_sql("don_gia")} AS DOUBLE) END AS p,
    so_luong, don_gia
  FROM cells
)"""


@register("coerce_rejects", f"""{_COERCE_SQL}
SELECT source_file, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, q AS so_luong, p AS don_gia,
       (so_luong IS NULL OR q IS NOT NULL) AND (don_gia IS NULL OR p IS NOT NULL) AS _ok
FROM typed
""")
def coerce_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cells converted; rows with a cell that does not convert flagged."""
    return CO.coerce_or_reject(T.typed_cells(spark, sf_dir), {"so_luong": "integer", "don_gia": "float"})


@register("load_stats", f"""{_COERCE_SQL}, flagged AS (
  SELECT source_file, (so_luong IS NULL OR q IS NOT NULL) AND (don_gia IS NULL OR p IS NOT NULL) AS ok
  FROM typed)
SELECT source_file, count(*) FILTER (WHERE ok) AS loaded, count(*) FILTER (WHERE NOT ok) AS skipped,
       CASE WHEN count(*) FILTER (WHERE NOT ok) = 0 THEN 'success' ELSE 'partial' END AS status
FROM flagged GROUP BY source_file
""")
def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded / skipped rows and status per source file."""
    flagged = CO.coerce_or_reject(T.typed_cells(spark, sf_dir), {"so_luong": "integer", "don_gia": "float"})
    return CO.load_stats(flagged)


# ------------------------------------------------------------ file scan ---
import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402

from sheetlake.operators.schema import project_cells, union_schema  # noqa: E402
from sheetlake.plans import storage as ST  # noqa: E402
from sheetlake.plans.jobs import run_reports  # noqa: E402
from sheetlake.session import scratch_path  # noqa: E402
from sheetlake.sources.listing import list_reports  # noqa: E402
from sheetlake.sources.reports import data_records, header_records, scan_report_rows  # noqa: E402


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{_uuid.uuid4().hex}")


@register("header_offset_scan", T.REPORT_ROWS_SQL)
def header_offset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported as titled CSV report files (blank
    title rows, trailing delimiters), then listed, decoded with a header
    offset, folded, unioned and projected."""
    folder = T.write_report_files(spark, sf_dir, _scratch(spark, "reports"))
    # decode once: land the decoded records, then read headers and rows from them
    landed = _scratch(spark, "scan")
    scan_report_rows(spark, {folder: "don_hang"}, {"don_hang": 2}).write.parquet(landed)
    T.remove_folder(spark, folder)
    scan = spark.read.parquet(landed)
    cols = union_schema(header_records(scan), "don_hang")
    rows = C.clean_cells(project_cells(data_records(scan), cols))
    return rows.select(*cols, F.regexp_extract("source_file", r"/([0-9]{4}-[0-9]{2})_", 1).alias("report_month"))


@register("changed_files", f"""{T.REPLAY_SQL}
SELECT regexp_extract(file, 'f[0-9]+[.]csv$') AS file, count(*) AS n FROM named
WHERE kind IN (1, 2, 4, 5) GROUP BY ALL HAVING max(ts) > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: files modified strictly after an instant, by the file index alone."""
    folder = T.timed_sheets(spark, sf_dir, _scratch(spark, "sheets"))
    ev = T.table(spark, sf_dir, "events")
    since = ev.select((F.max("ts") - F.expr("INTERVAL 1 HOUR")).cast("timestamp")).first()[0].astimezone(_dt.timezone.utc)
    files = list_reports(spark, {folder: "events"}, since=since).select(F.regexp_extract("rel_path", r"f\d+\.csv$", 0).alias("file"))
    per_file = T.replay_events(spark, sf_dir).groupBy(F.concat("file", F.lit(".csv")).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.join(per_file, "file")


@register("daily_replay", f"""{T.REPLAY_SQL}
SELECT event_id::VARCHAR AS ma_su_kien, event_type AS loai, file AS source_file,
       CASE WHEN kind IN (0, 5) THEN floor(abs(value)) ELSE floor(abs(value) * 100) / 100 END AS gia_tri
FROM named WHERE kind IN (0, 1, 4, 5)
""")
def daily_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after init and a daily run over
    changed, emptied, vanished, new and broken files equals a full reload (a
    broken re-export keeps the rows it had); whole numbers grew fractions."""
    stored = ST.read(spark, ST.path(T.replay(spark, sf_dir, _scratch(spark, "replay")), "events"))
    return stored.select("ma_su_kien", "loai", "source_file", "gia_tri")


@register("replay_ledger", f"""{T.REPLAY_SQL}
SELECT file AS file_path,
  CASE WHEN kind IN (0, 4) THEN 'INSERT' WHEN kind = 3 THEN 'DELETED' ELSE 'UPDATE' END AS operation,
  CASE WHEN kind = 5 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN kind IN (2, 5) THEN 0 ELSE count(*) END::BIGINT AS row_count
FROM named GROUP BY file, kind
""")
def replay_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ledger row of every file after the replay."""
    ledger = ST.read(spark, ST.path(T.replay(spark, sf_dir, _scratch(spark, "replay")), ST.LEDGER))
    return L.latest_ops(ledger).select("file_path", "operation", "status", "row_count")


@register("clean_number", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_quantity = floor(l_quantity) THEN l_quantity::BIGINT::VARCHAR END AS id_khach_hang,
  CASE WHEN l_returnflag <> 'R' THEN l_extendedprice::DOUBLE END AS don_gia
FROM lineitem
""")
def clean_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 and the numeric branches of C2: NaN to NULL, whole identifiers to text (floor)."""
    li = T.table(spark, sf_dir, "lineitem")
    nan = F.col("l_returnflag") == "R"
    return C.clean_cells(li.select("l_orderkey", "l_linenumber", *[
        F.when(nan, F.lit(float("nan"))).otherwise(F.col(c).cast("double")).alias(n)
        for c, n in (("l_quantity", "id_khach_hang"), ("l_extendedprice", "don_gia"))]))


@register("report_export", """
SELECT o_orderstatus, count(*) AS n_orders, min(o_orderkey) AS first_order FROM orders GROUP BY ALL
""")
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL script over stored tables, written by the export job and read back."""
    scripts, out = _scratch(spark, "scripts"), _scratch(spark, "export")
    ST.put_text(spark, f"{scripts}/orders.sql", "SELECT o_orderstatus, count(*) AS n_orders, "
                "min(o_orderkey) AS first_order FROM stored_orders GROUP BY 1;")
    result = run_reports(spark, scripts, out, views={"stored_orders": T.table(spark, sf_dir, "orders")})
    return spark.read.parquet(result["ok"][0])


@register("workbook_round_trip", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS khach_hang, c_mktsegment AS nhom,
       CAST(c_acctbal AS DOUBLE) AS so_du, count(o_orderkey) AS so_don,
       strftime(max(o_orderdate), '%Y-%m-%d 00:00:00') AS ngay_cuoi
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_mktsegment, c_acctbal
""")
def workbook_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over stored tables exported as workbooks and read
    back by the report scan; numbers, dates and empty cells survive."""
    scripts, out = _scratch(spark, "scripts"), _scratch(spark, "export")
    ST.put_text(spark, f"{scripts}/khach.sql", """SELECT c_custkey AS `ID`, c_name AS `Khách hàng`,
        c_mktsegment AS `Nhóm`, c_acctbal AS `Số dư`, count(o_orderkey) AS `Số đơn`, max(o_orderdate) AS `Ngày cuối`
        FROM stored_customer LEFT JOIN stored_orders ON o_custkey = c_custkey
        GROUP BY c_custkey, c_name, c_mktsegment, c_acctbal""")
    views = {f"stored_{t}": T.table(spark, sf_dir, t) for t in ("customer", "orders")}
    result = run_reports(spark, scripts, out, "xlsx", views=views)
    landed = _scratch(spark, "scan")
    scan_report_rows(spark, {result["ok"][0]: "khach"}, {"khach": 0}, "*.xlsx", "xlsx").write.parquet(landed)
    scan = spark.read.parquet(landed)
    rows = project_cells(data_records(scan), union_schema(header_records(scan), "khach"))
    return rows.select("id", "khach_hang", "nhom", F.col("so_du").cast("double").alias("so_du"),
                       F.col("so_don").cast("long").alias("so_don"), "ngay_cuoi")


# ---------------------------------------------------------- schema drift ---
from sheetlake.operators.schema import (drift_between, evolve_union as _evolve_union, header_state,  # noqa: E402
                                        schema_drift as _schema_drift)


@register("evolve_union", T.UNION_SQL)
def evolve_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of differently shaped files by column name."""
    return _evolve_union(T.order_file_rows(spark, sf_dir), T.line_file_rows(spark, sf_dir))


@register("schema_drift", T.DRIFT_SQL)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file, columns new to the table and stored columns it lacks."""
    return _schema_drift(T.event_headers(spark, sf_dir), list(T.DRIFT_EXISTING))


@register("header_drift", T.HEADER_DRIFT_SQL)
def header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that files gained or lost between two runs, from the
    stored header index (runs are days, a file's columns the event types of a day)."""
    place = _scratch(spark, "headers")
    ST.replace_partitions(T.daily_headers(spark, sf_dir), place, partition_by=("run_id", "table_name"))
    headers = ST.read(spark, place)
    last = headers.select(F.max("run_id")).scalar()
    return drift_between(header_state(headers.filter(F.col("run_id") < last)), header_state(headers))


@register("stored_replace", f"""{_DELETED_SQL},
late AS (SELECT max(ts) - INTERVAL 1 DAY AS t FROM events_table),
changed AS (SELECT DISTINCT source_file FROM events_table, late WHERE ts > t)
SELECT {_EV_OUT}, CASE WHEN source_file IN (FROM changed) THEN event_type || '!' END AS note
FROM events_table ANTI JOIN gone ON file_path = source_file
""")
def stored_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1, E2, E5 stored: a bucketed table written in full, then files read
    anew replace their rows (with a column more), then vanished files go."""
    ev, place = T.events_table(spark, sf_dir), _scratch(spark, "stored")
    ST.overwrite(ev, place, sources=ev.select("source_file").distinct().count())
    late = ev.select(F.max("ts") - F.expr("INTERVAL 1 DAY")).scalar()
    changed = ev.filter(F.col("ts") > late).select("source_file").distinct()
    again = keep_keys(ev, changed, "source_file").withColumn("note", F.concat("event_type", F.lit("!")))
    ST.replace_sources(again, place, changed)
    gone = L.deleted_sources(L.active_files(T.ledger(spark, sf_dir)), T.listing(spark, sf_dir))
    ST.drop_sources(spark, place, gone, "file_path")
    return ST.read(spark, place)
