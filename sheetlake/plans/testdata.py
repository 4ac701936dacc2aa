"""Mapping of the generated benchmark tables onto the report tables.

The reports read three landed tables. The benchmark folder holds TPC-H-like
tables instead, so each logical table is a plan over them:

* ``sales_revenue``  = lineitem ⋈ orders ⋈ part (one row per line item)
* ``customer_data``  = orders ⋈ customer ⋈ nation (one customer version per order)
* ``cancellation_bills`` = orders with status ``P``

The same mapping is written in SQL (``*_SQL``) for the DuckDB oracle.
Everything scales with the input tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from sheetlake.functions.revenue import RevenueRules

MONEY = DecimalType(18, 2)

# --- Fixed values: the report constants translated onto the benchmark values. ---
MAPPED_RULES = RevenueRules(
    rebate_payers=("1-URGENT", "2-HIGH"),
    zero_payers=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    other_kind="ECONOMY",
    herbal_kind="STANDARD",
    drug_and_product_kinds=("PROMO", "LARGE"),
    fnb_kind="SMALL",
    package_data_kind="F",
    package_kind="MEDIUM",
    package_product_words=("ring", "bolt"),
    period_after="1996-12-31",
    period_before="1997-07-16",
    amount_type=MONEY,
)
# ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_text(name: str):
    return F.lit(None).cast("string").alias(name)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
           .join(p, li["l_partkey"] == p["p_partkey"]))
    return j.select(
        F.col("l_linestatus").alias("loai_du_lieu"),
        F.col("o_custkey").alias("id_khach_hang"),
        F.concat(F.lit("KH"), F.col("o_custkey").cast("string")).alias("khach_hang"),
        _null_text("pid"),
        F.col("p_type").alias("loai_doanh_thu"),
        F.col("o_orderstatus").alias("loai_hoa_don"),
        F.col("o_orderkey").alias("ma_hoa_don"),
        F.col("p_name").alias("san_pham"),
        F.col("l_quantity").alias("so_luong"),
        F.col("o_orderdate").alias("ngay_ghi"),
        F.col("l_shipdate").alias("ngay_cap_nhat_hoa_don_cuoi"),
        F.col("l_extendedprice").cast(MONEY).alias("so_tien_thuc_te_thu"),
        F.col("o_orderpriority").alias("ten_doi_tuong_thanh_toan"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = (o.join(c, o["o_custkey"] == c["c_custkey"])
          .join(n, c["c_nationkey"] == n["n_nationkey"]))
    birth_serial = F.concat(
        F.datediff(F.add_months(F.to_date("o_orderdate"), -360),
                   F.lit("1899-12-30").cast("date")).cast("string"),
        F.lit(".0"))
    return j.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("ten_khach_hang"),
        _null_text("pid"),
        _null_text("gioi_tinh"),
        birth_serial.alias("ngay_sinh"),
        _null_text("chuyen_vien_tu_van"),
        F.col("o_orderpriority").alias("muc_do"),
        F.col("c_mktsegment").alias("nguon_1"),
        F.col("c_nationkey").cast("bigint").alias("nguoi_gioi_thieu_id"),
        F.col("n_regionkey").cast("bigint").alias("nguoi_gioi_thieu_khach_hang_pid"),
        F.col("n_name").alias("nguoi_gioi_thieu_khach_hang"),
        _null_text("nguoi_gioi_thieu_noi_bo"),
        _null_text("co_phuc_loi_tap_doan"),
        _null_text("cap_quyen_loi_ap_dung"),
        _null_text("cong_ty_1"),
        _null_text("ten_bao_hiem_thanh_toan"),
        _null_text("quan_he_voi_cap_quyen_loi_ap_dung"),
        F.col("o_orderdate").alias("ngay_cuoi_cap_nhat"),
    )


def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("ma_hoa_don"))


def report_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return sales(spark, sf_dir), customers(spark, sf_dir), cancellations(spark, sf_dir)


SALES_SQL = """
sales_revenue AS (
  SELECT l.l_linestatus AS loai_du_lieu, o.o_custkey AS id_khach_hang,
         'KH' || CAST(o.o_custkey AS VARCHAR) AS khach_hang, CAST(NULL AS VARCHAR) AS pid,
         p.p_type AS loai_doanh_thu, o.o_orderstatus AS loai_hoa_don, o.o_orderkey AS ma_hoa_don,
         p.p_name AS san_pham, l.l_quantity AS so_luong, o.o_orderdate AS ngay_ghi,
         l.l_shipdate AS ngay_cap_nhat_hoa_don_cuoi,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS so_tien_thuc_te_thu,
         o.o_orderpriority AS ten_doi_tuong_thanh_toan
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
)"""

CUSTOMERS_SQL = """
customer_data AS (
  SELECT c.c_custkey AS id, c.c_name AS ten_khach_hang, CAST(NULL AS VARCHAR) AS pid,
         CAST(NULL AS VARCHAR) AS gioi_tinh,
         CAST(date_diff('day', DATE '1899-12-30',
                        CAST(CAST(o.o_orderdate AS DATE) - INTERVAL 360 MONTH AS DATE)) AS VARCHAR) || '.0'
           AS ngay_sinh,
         CAST(NULL AS VARCHAR) AS chuyen_vien_tu_van, o.o_orderpriority AS muc_do,
         c.c_mktsegment AS nguon_1, CAST(c.c_nationkey AS BIGINT) AS nguoi_gioi_thieu_id,
         CAST(n.n_regionkey AS BIGINT) AS nguoi_gioi_thieu_khach_hang_pid,
         n.n_name AS nguoi_gioi_thieu_khach_hang, CAST(NULL AS VARCHAR) AS nguoi_gioi_thieu_noi_bo,
         CAST(NULL AS VARCHAR) AS co_phuc_loi_tap_doan, CAST(NULL AS VARCHAR) AS cap_quyen_loi_ap_dung,
         CAST(NULL AS VARCHAR) AS cong_ty_1, CAST(NULL AS VARCHAR) AS ten_bao_hiem_thanh_toan,
         CAST(NULL AS VARCHAR) AS quan_he_voi_cap_quyen_loi_ap_dung,
         o.o_orderdate AS ngay_cuoi_cap_nhat
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

CANCELLATIONS_SQL = """
cancellation_bills AS (
  SELECT o_orderkey AS ma_hoa_don FROM orders WHERE o_orderstatus = 'P'
)"""

MAPPING_SQL = "WITH " + ",".join([SALES_SQL, CUSTOMERS_SQL, CANCELLATIONS_SQL])


# ------------------------------------------------------------------ ledger ---
# ``events`` plays the file ledger: one file per user, one operation per event.
#   signup -> INSERT, click -> UPDATE, purchase -> DELETED, view -> legacy row
#   without operation, error -> INSERT that failed.
# The folder listing holds the files touched in the last day of the log; the
# others count as gone. Runs are the days of the log.

def _file_path(user: str = "user_id"):
    return F.concat(F.lit("events/"), F.col(user).cast("string"), F.lit(".csv"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("id"),
        _file_path().alias("file_path"),
        F.lit("events").alias("table_name"),
        F.col("ts").alias("last_loaded_at"),
        F.get_json_object("props", "$.k").cast("int").alias("row_count"),
        F.when(et == "error", F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(et == "signup", F.lit("INSERT")).when(et == "click", F.lit("UPDATE"))
         .when(et == "purchase", F.lit("DELETED")).when(et == "error", F.lit("INSERT"))
         .alias("operation"),
    )


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events rows as a landed table whose rows come from per-user files."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", "event_type", "value", "props",
                     _file_path().alias("source_file"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    cutoff = ev.select(F.max("ts") - F.expr("INTERVAL 1 DAY")).scalar()
    return ev.filter(F.col("ts") > cutoff).select(_file_path().alias("rel_path")).distinct()


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``started`` and ``finished`` events of one run per log day; a day whose
    last event is an error never finished."""
    ev = table(spark, sf_dir, "events")
    day = F.date_format(F.col("ts"), "yyyyMMdd").cast("bigint")
    per_day = ev.groupBy(day.alias("run_id")).agg(
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_event"),
        F.count_if(F.col("event_type").isin("signup", "click")).alias("files_processed"),
        F.count_if(F.col("event_type") == "error").alias("files_skipped"),
        F.count_if(F.col("event_type") == "purchase").alias("errors"),
    )
    started = per_day.select("run_id", F.lit("started").alias("event"), F.col("first_at").alias("at"),
                             F.lit("daily").alias("mode"), F.lit(None).cast("bigint").alias("files_processed"),
                             F.lit(None).cast("bigint").alias("files_skipped"),
                             F.lit(None).cast("bigint").alias("errors"))
    finished = per_day.filter(F.col("last_event") != "error").select(
        "run_id", F.lit("finished").alias("event"), F.col("last_at").alias("at"),
        F.lit(None).cast("string").alias("mode"), "files_processed", "files_skipped", "errors")
    return started.unionByName(finished)


FILE_PATH_SQL = "'events/' || CAST(user_id AS VARCHAR) || '.csv'"

LEDGER_SQL = f"""
ledger AS (
  SELECT event_id AS id, {FILE_PATH_SQL} AS file_path, 'events' AS table_name, ts AS last_loaded_at,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS row_count,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'UPDATE'
                         WHEN 'purchase' THEN 'DELETED' WHEN 'error' THEN 'INSERT' END AS operation
  FROM events
)"""

EVENTS_TABLE_SQL = f"""
events_table AS (
  SELECT event_id, ts, user_id, event_type, value, props, {FILE_PATH_SQL} AS source_file FROM events
)"""

LISTING_SQL = f"""
listing AS (
  SELECT DISTINCT {FILE_PATH_SQL} AS rel_path FROM events
  WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
)"""

RUNS_SQL = """
per_day AS (
  SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS run_id, min(ts) AS first_at, max(ts) AS last_at,
         arg_max(event_type, struct_pack(t := ts, i := event_id)) AS last_event,
         count(*) FILTER (WHERE event_type IN ('signup', 'click')) AS files_processed,
         count(*) FILTER (WHERE event_type = 'error') AS files_skipped,
         count(*) FILTER (WHERE event_type = 'purchase') AS errors
  FROM events GROUP BY 1
), runs AS (
  SELECT run_id, 'daily' AS mode, first_at AS started_at,
         CASE WHEN last_event <> 'error' THEN last_at END AS finished_at,
         CASE WHEN last_event <> 'error' THEN files_processed END AS files_processed,
         CASE WHEN last_event <> 'error' THEN files_skipped END AS files_skipped,
         CASE WHEN last_event <> 'error' THEN errors END AS errors
  FROM per_day
)"""

LEDGER_MAPPING_SQL = "WITH " + ",".join([LEDGER_SQL, EVENTS_TABLE_SQL, LISTING_SQL, RUNS_SQL])


# ------------------------------------------------------------ text cells ---
# Raw text cells derived row by row from the benchmark tables, spelled the way
# exported sheets spell them (padding, ``.0`` tails, signs, blanks, junk).

def identifier_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_custkey").cast("string")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    raw = (F.when(pr == "1-URGENT", F.concat(k, F.lit(".0")))
            .when(pr == "2-HIGH", F.concat(F.lit(" "), k, F.lit(" ")))
            .when(pr == "3-MEDIUM", F.concat(F.lit("+00"), k, F.when(st == "P", F.lit("7" * 40)).otherwise("")))
            .when(pr == "4-NOT SPECIFIED", F.when(st == "P", F.lit(".0")).otherwise(F.concat(k, F.lit(".000"))))
            .otherwise(F.when(st == "P", F.lit(" ")).otherwise(F.concat(F.lit("KH-"), k))))
    contact = (F.when(pr == "1-URGENT", F.concat(F.lit("0"), k, F.lit(".0")))
                .when(pr == "2-HIGH", F.concat(F.lit(" "), k, F.lit(".000 ")))
                .when(pr == "3-MEDIUM", F.concat(F.lit("Chong: KH"), k, F.lit(" - SDT: 09"),
                                                 F.col("o_orderkey").cast("string")))
                .when(pr == "4-NOT SPECIFIED", F.concat(k, F.lit(".5")))
                .otherwise(F.concat(F.lit(" "), st)))
    text = (F.when(pr == "1-URGENT", F.lit(".0")).when(pr == "2-HIGH", F.lit(" .0 "))
             .when(pr == "3-MEDIUM", F.lit(" x ")).when(pr == "4-NOT SPECIFIED", F.lit("0.0"))
             .otherwise(F.concat(st, F.lit(" "))))
    return o.select("o_orderkey", raw.alias("id_khach_hang"), contact.alias("thong_tin_nguoi_than"),
                    text.alias("ly_do_huy"))


IDENTIFIER_CELLS_SQL = """
cells AS (
  SELECT o_orderkey,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN CAST(o_custkey AS VARCHAR) || '.0'
      WHEN '2-HIGH' THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
      WHEN '3-MEDIUM' THEN '+00' || CAST(o_custkey AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN repeat('7', 40) ELSE '' END
      WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'P' THEN '.0' ELSE CAST(o_custkey AS VARCHAR) || '.000' END
      ELSE CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'KH-' || CAST(o_custkey AS VARCHAR) END
    END AS id_khach_hang,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN '0' || CAST(o_custkey AS VARCHAR) || '.0'
      WHEN '2-HIGH' THEN ' ' || CAST(o_custkey AS VARCHAR) || '.000 '
      WHEN '3-MEDIUM' THEN 'Chong: KH' || CAST(o_custkey AS VARCHAR) || ' - SDT: 09' || CAST(o_orderkey AS VARCHAR)
      WHEN '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) || '.5'
      ELSE ' ' || o_orderstatus
    END AS thong_tin_nguoi_than,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN '.0' WHEN '2-HIGH' THEN ' .0 ' WHEN '3-MEDIUM' THEN ' x '
      WHEN '4-NOT SPECIFIED' THEN '0.0' ELSE o_orderstatus || ' '
    END AS ly_do_huy
  FROM orders
)"""


def _month_file(ts: str = "l_shipdate"):
    return F.concat(F.lit("sales/"), F.date_format(F.col(ts), "yyyy-MM"), F.lit(".csv"))


MONTH_FILE_SQL = "'sales/' || strftime(l_shipdate, '%Y-%m') || '.csv'"


def landing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as an all-text landing table, as the loader stores it."""
    li = table(spark, sf_dir, "lineitem")
    d = F.date_format("l_shipdate", "yyyy-MM-dd")
    return li.select(
        _month_file().alias("source_file"),
        F.col("l_orderkey").cast("string").alias("ma_hoa_don"),
        F.col("l_linenumber").cast("bigint").alias("row_no"),
        F.col("l_quantity").cast("bigint").cast("string").alias("so_luong"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".5")).alias("ty_le"),
        d.alias("ngay_giao"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ngay_cap_nhat"),
        F.col("l_returnflag").alias("co"),
        F.when(F.col("l_linestatus") == "O", F.lit(" "))
         .otherwise(F.col("l_linenumber").cast("string")).alias("so_dong"),
        F.lit(None).cast("string").alias("ghi_chu"),
        F.when(F.col("l_returnflag") == "R",
               F.concat(F.date_format("l_shipdate", "yyyy-MM"), F.lit("-31"))).otherwise(d).alias("ngay_loi"),
    )


LANDING_SQL = f"""
landing AS (
  SELECT {MONTH_FILE_SQL} AS source_file, CAST(l_orderkey AS VARCHAR) AS ma_hoa_don,
         CAST(l_linenumber AS BIGINT) AS row_no,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS so_luong,
         CAST(l_linenumber AS VARCHAR) || '.5' AS ty_le,
         strftime(l_shipdate, '%Y-%m-%d') AS ngay_giao,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ngay_cap_nhat,
         l_returnflag AS co,
         CASE WHEN l_linestatus = 'O' THEN ' ' ELSE CAST(l_linenumber AS VARCHAR) END AS so_dong,
         CAST(NULL AS VARCHAR) AS ghi_chu,
         CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m') || '-31'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ngay_loi
  FROM lineitem
)"""


def date_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ymd = F.date_format("l_shipdate", "yyyyMMdd")
    n = F.col("l_linenumber")
    serial = F.concat(F.datediff(F.col("l_shipdate"), F.lit("1899-12-30").cast("date")).cast("string"),
                      F.lit(".0"))
    raw = (F.when(n == 1, ymd)
            .when(n == 2, F.date_format("l_shipdate", "dd/MM/yyyy"))
            .when(n == 3, F.when(F.col("l_returnflag") == "A", F.concat(F.lit("00"), serial)).otherwise(serial))
            .when(n == 4, F.when(F.col("l_returnflag") == "A", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
                           .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")))
            .when(n == 5, F.concat(F.lit(" "), ymd, F.lit(" ")))
            .when(n == 6, F.concat(F.lit("2"), F.substring(ymd, 2, 7)))
            .otherwise(F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("30"))))
    return li.select("l_orderkey", "l_linenumber", raw.alias("ngay_sinh_raw"))


DATE_CELLS_SQL = """
cells AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber
      WHEN 1 THEN strftime(l_shipdate, '%Y%m%d')
      WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y')
      WHEN 3 THEN CASE WHEN l_returnflag = 'A' THEN '00' ELSE '' END
        || CAST(date_diff('day', DATE '1899-12-30', CAST(l_shipdate AS DATE)) AS VARCHAR) || '.0'
      WHEN 4 THEN CASE WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
                       ELSE strftime(l_shipdate, '%Y-%m-%d') END
      WHEN 5 THEN ' ' || strftime(l_shipdate, '%Y%m%d') || ' '
      WHEN 6 THEN '2' || substr(strftime(l_shipdate, '%Y%m%d'), 2, 7)
      ELSE strftime(l_shipdate, '%Y%m') || '30'
    END AS ngay_sinh_raw
  FROM lineitem
)"""


def typed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells bound for typed columns; some do not convert."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("bigint").cast("string")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    price = F.concat(F.col("l_partkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    qty = (F.when((rf == "R") & (ls == "F"), F.concat(q, F.lit("x")))
            .when(rf == "N", F.concat(F.lit(" "), q)).otherwise(q))
    unit = (F.when((rf == "A") & (ls == "O"), F.lit("n/a"))
             .when((rf == "N") & (ls == "O"), F.concat(price, F.lit("e1")))
             .otherwise(price))
    return li.select(_month_file().alias("source_file"), "l_orderkey", "l_linenumber",
                     qty.alias("so_luong"), unit.alias("don_gia"))


TYPED_CELLS_SQL = f"""
cells AS (
  SELECT {MONTH_FILE_SQL} AS source_file, l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'x'
         WHEN l_returnflag = 'N' THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS so_luong,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'n/a'
         WHEN l_returnflag = 'N' AND l_linestatus = 'O'
           THEN CAST(l_partkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) || 'e1'
         ELSE CAST(l_partkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) END AS don_gia
  FROM lineitem
)"""


# ------------------------------------------------------------ report files ---
# ``orders`` written out as exported report files: one CSV per order month,
# a title row above a header with display names (one near-duplicate column),
# so the file scan, header offset, name folding and first-wins rule run on
# data derived from the tables.

# --- Fixed values: display header of the exported order reports. ---
REPORT_HEADER = ["Mã hóa đơn", "ID Khách hàng", "Trạng thái", "Ngày ghi", "Ưu tiên", "Ưu tiên "]
# ---------------------------------------------------------------------


def write_sheets(spark: SparkSession, lines: DataFrame, folder: str) -> str:
    """Write text ``lines`` (file, line_no, value) as ``<folder>/<file>.csv``.
    Files have stable names, so writing one again is a re-export. ``file``
    names few files of bounded size; each is written by one task."""
    scratch = f"{folder.rstrip('/')}__lines"
    (lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", "value")
          .write.mode("overwrite").partitionBy("file").text(scratch))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for part in fs.globStatus(path(f"{scratch}/file=*/part-*")) or []:
        target = path(f"{folder}/{part.getPath().getParent().getName()[5:]}.csv")
        fs.delete(target, False)
        fs.rename(part.getPath(), target)
    fs.delete(path(scratch), True)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


ORDERS_PER_FILE = 20_000


def write_report_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Orders as report files of bounded size: a month's orders are dealt over
    as many files as its count needs. A blank row stands between title and
    header, and every row ends in a delimiter."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    o = table(spark, sf_dir, "orders").withColumn("month", month)
    parts = o.groupBy("month").agg(F.ceil(F.count(F.lit(1)) / ORDERS_PER_FILE).alias("parts"))
    o = o.join(parts, "month").withColumn(
        "file", F.concat_ws("_", "month", F.pmod(F.xxhash64("o_orderkey"), "parts").cast("string")))
    body = o.select(
        "file", F.col("o_orderkey").alias("line_no"),
        F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                    "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority",
                    F.lit("x"), F.lit("")).alias("value"))
    files = o.select("file").distinct()
    head = F.array(F.struct(F.lit(-3).cast("bigint").alias("line_no"),
                            F.concat(F.lit("Báo cáo đơn hàng "), F.col("file")).alias("value")),
                   F.struct(F.lit(-2).cast("bigint").alias("line_no"), F.lit("").alias("value")),
                   F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.lit(",".join(REPORT_HEADER) + ",").alias("value")))
    return write_sheets(spark, files.select("file", F.inline(head)).unionByName(body), folder)


REPORT_ROWS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS ma_hoa_don, CAST(o_custkey AS VARCHAR) AS id_khach_hang,
       o_orderstatus AS trang_thai, strftime(o_orderdate, '%Y-%m-%d') AS ngay_ghi,
       o_orderpriority AS uu_tien, strftime(o_orderdate, '%Y-%m') AS report_month
FROM orders
"""


# ---------------------------------------------------------------- replays ---
# ``events`` as sheets by user, cut into slices of bounded size, exported twice.
# By file number modulo 6: unchanged,
# changed (first the older rows only), emptied, vanished, new, and re-exported
# with a broken last row. The first export shows whole numbers, the second
# one fractions.

REPLAY_FILES = 24
EVENTS_PER_FILE = 50_000


def replay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the number ``k`` and the name ``file`` of its sheet: more
    slices of a user's sheet as the table grows, so a hot user fills many."""
    ev = table(spark, sf_dir, "events")
    slices = max(1, -(-ev.count() // (REPLAY_FILES * EVENTS_PER_FILE)))
    of_user, slice_ = F.pmod("user_id", F.lit(REPLAY_FILES)), F.floor(F.col("event_id") / 2) % slices
    return ev.withColumn("k", of_user + REPLAY_FILES * slice_).withColumn("file", F.format_string("f%06d", "k"))


def replay_lines(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    ev = replay_events(spark, sf_dir)
    kind = F.col("k") % 6
    name = F.col("file")
    cents = F.floor(F.abs("value") * 100).cast("bigint")
    whole = F.floor(F.abs("value")).cast("bigint").cast("string")
    exact = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    if second:
        rows, shown, files = kind.isin(1, 4, 5), exact, kind.isin(1, 2, 4, 5)
    else:
        rows = kind.isin(0, 2, 3, 5) | ((kind == 1) & (F.col("event_id") % 2 == 0))
        shown, files = whole, kind != 4
    body = ev.filter(rows).select(name.alias("file"), F.col("event_id").alias("line_no"), F.concat_ws(
        ",", F.col("event_id").cast("string"), "event_type", shown).alias("value"))
    heads = ev.filter(files).select("k", name.alias("file")).distinct()
    title = heads.select("file", F.inline(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("line_no"), F.lit("Nhật ký").alias("value")),
        F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.lit("Mã sự kiện,Loại,Giá trị").alias("value")))))
    lines = title.unionByName(body)
    if second:
        broken = heads.filter(kind == 5).select("file", F.lit(1 << 62).alias("line_no"), F.lit("1,2,3,4").alias("value"))
        lines = lines.unionByName(broken)
    return lines


def replay(spark: SparkSession, sf_dir: str, root: str) -> str:
    """First export and init, second export and daily run; returns the warehouse."""
    from sheetlake.plans.jobs import init
    from sheetlake.streaming.incremental import daily

    folder, warehouse = f"{root}/replay", f"{root}/warehouse"
    routes, headers = {folder: "events"}, {"events": 1}
    write_sheets(spark, replay_lines(spark, sf_dir, False), folder)
    init(spark, routes, headers, warehouse)
    write_sheets(spark, replay_lines(spark, sf_dir, True), folder)
    gone = replay_events(spark, sf_dir).filter("k % 6 = 3").select("file").distinct()
    for r in gone.toLocalIterator():
        remove_folder(spark, f"{folder}/{r['file']}.csv")
    daily(spark, routes, headers, warehouse)
    return warehouse


REPLAY_SQL = f"""
WITH size AS (SELECT greatest(1, (count(*) + {REPLAY_FILES * EVENTS_PER_FILE - 1}) // {REPLAY_FILES * EVENTS_PER_FILE}) AS slices
  FROM events),
e AS (SELECT events.*, user_id % {REPLAY_FILES} + {REPLAY_FILES} * ((event_id // 2) % (SELECT slices FROM size)) AS k,
  (user_id % {REPLAY_FILES}) % 6 AS kind FROM events),
named AS (SELECT *, 'replay/' || format('f{{:06d}}', k::BIGINT) || '.csv' AS file FROM e)"""


def timed_sheets(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The second export with every file's time set to its newest event."""
    write_sheets(spark, replay_lines(spark, sf_dir, True), folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest = replay_events(spark, sf_dir).groupBy("file").agg(F.unix_millis(F.max("ts").cast("timestamp")).alias("at"))
    for r in newest.toLocalIterator():
        target = path(f"{folder}/{r['file']}.csv")
        if fs.exists(target):
            fs.setTimes(target, r["at"], -1)
    return folder


# ---------------------------------------------------------- schema drift ---
# Two exports of differently shaped files (orders-like and lineitem-like) for
# the schema union; and per-file headers taken from ``events``: every user is
# a file whose columns are the event types it recorded.

# --- Fixed values: the stored schema the drift report compares against. ---
DRIFT_EXISTING = ("click", "signup", "view", "refund")
# ---------------------------------------------------------------------------


def order_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("ma_hoa_don"),
                    F.col("o_custkey").cast("string").alias("id_khach_hang"),
                    F.col("o_orderstatus").alias("loai_hoa_don"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("ngay_ghi"),
                    F.concat(F.lit("orders/"), F.col("o_orderpriority"), F.lit(".csv")).alias("source_file"))


def line_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("ma_hoa_don"),
                     F.col("l_partkey").cast("string").alias("san_pham"),
                     F.col("l_linestatus").alias("loai_du_lieu"),
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("ngay_ghi"),
                     F.concat(F.lit("lines/"), F.col("l_linestatus"), F.lit(".csv")).alias("source_file"))


def event_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(_file_path().alias("source_file"), F.col("event_type").alias("column_name")).distinct()


def daily_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header index of one run per log day."""
    ev = table(spark, sf_dir, "events")
    return ev.select(_file_path().alias("source_file"), F.col("event_type").alias("column_name"),
                     F.date_format("ts", "yyyyMMdd").cast("bigint").alias("run_id"),
                     F.lit("events").alias("table_name")).distinct()


HEADER_DRIFT_SQL = f"""
WITH h AS (SELECT DISTINCT {FILE_PATH_SQL} AS source_file, event_type AS column_name, ts::DATE AS run FROM events),
ends AS (SELECT max(run) AS last FROM h),
was AS (SELECT source_file, list(column_name) AS cols FROM h, ends WHERE run < last
        AND run = (SELECT max(run) FROM h x WHERE x.source_file = h.source_file AND x.run < last) GROUP BY source_file),
now AS (SELECT source_file, list(column_name) AS cols FROM h, ends WHERE run = last GROUP BY source_file)
SELECT source_file, unnest(list_filter(now.cols, lambda c: NOT list_contains(was.cols, c))) AS column_name, 'added' AS drift
FROM was JOIN now USING (source_file)
UNION ALL
SELECT source_file, unnest(list_filter(was.cols, lambda c: NOT list_contains(now.cols, c))), 'dropped'
FROM was JOIN now USING (source_file)
"""


UNION_SQL = """
SELECT id_khach_hang, loai_du_lieu, loai_hoa_don, ma_hoa_don, ngay_ghi, san_pham, source_file FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS ma_hoa_don, CAST(o_custkey AS VARCHAR) AS id_khach_hang,
         o_orderstatus AS loai_hoa_don, strftime(o_orderdate, '%Y-%m-%d') AS ngay_ghi,
         'orders/' || o_orderpriority || '.csv' AS source_file FROM orders
  UNION ALL BY NAME
  SELECT CAST(l_orderkey AS VARCHAR) AS ma_hoa_don, CAST(l_partkey AS VARCHAR) AS san_pham,
         l_linestatus AS loai_du_lieu, strftime(l_shipdate, '%Y-%m-%d') AS ngay_ghi,
         'lines/' || l_linestatus || '.csv' AS source_file FROM lineitem
)"""

DRIFT_SQL = f"""
WITH h AS (SELECT DISTINCT {FILE_PATH_SQL} AS source_file, event_type AS column_name FROM events),
known AS (SELECT unnest([{", ".join(f"'{c}'" for c in DRIFT_EXISTING)}]) AS column_name),
files AS (SELECT DISTINCT source_file FROM h)
SELECT source_file, column_name, 'new' AS drift FROM h
WHERE column_name NOT IN (SELECT column_name FROM known)
UNION ALL
SELECT f.source_file, k.column_name, 'missing' AS drift FROM files f, known k
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.source_file = f.source_file AND h.column_name = k.column_name)
"""
