"""The revenue and customer reports as DataFrame plans.

Inputs are the three landed tables with normalised column names:
``sales`` (sales_revenue), ``customers`` (customer_data, several versions
per customer id) and ``cancellations`` (cancellation_bills, only
``ma_hoa_don`` is used). Every function returns a lazy DataFrame.

Shuffle shape: one-row-per-key ranking (per bill, per customer) uses window
partitions with a map-side ``WindowGroupLimit``; the ties-kept ranking of
the current bills is one such window, with a way of its own for the NULL
bill; every rollup is a partial + final hash aggregate; the per-customer pieces are
keyed on the customer id, so their joins meet on one hash partitioning.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetlake.functions.dates import parse_flexible_date
from sheetlake.functions.revenue import RevenueRules, amount_value, net_revenue
from sheetlake.operators.keys import exclude_keys
from sheetlake.operators.latest import latest_by_key, newest_first, newest_rows

BILL = "ma_hoa_don"
CUSTOMER = "id_khach_hang"
ENTRY_DATE = "ngay_ghi"
BILL_UPDATED = "ngay_cap_nhat_hoa_don_cuoi"
AMOUNT = "so_tien_thuc_te_thu"
PAYER = "ten_doi_tuong_thanh_toan"
KIND = "loai_doanh_thu"
VERSION_UPDATED = "ngay_cuoi_cap_nhat"

# --- Fixed values: required column names of the reports, in report order. ---
# Columns of the current-bills report.
BILL_COLUMNS = [
    "loai_du_lieu", "id_khach_hang", "khach_hang", "pid", "loai_doanh_thu",
    "loai_hoa_don", "ma_hoa_don", "san_pham", "so_luong", "ngay_ghi",
    "ngay_cap_nhat_hoa_don_cuoi", "so_tien_thuc_te_thu", "ten_doi_tuong_thanh_toan",
]
# Customer attributes of the newest-customer report.
CUSTOMER_COLUMNS = [
    "id", "ten_khach_hang", "pid", "gioi_tinh", "ngay_sinh", "chuyen_vien_tu_van",
    "muc_do", "nguon_1", "nguoi_gioi_thieu_id", "nguoi_gioi_thieu_khach_hang_pid",
    "nguoi_gioi_thieu_khach_hang", "nguoi_gioi_thieu_noi_bo", "co_phuc_loi_tap_doan",
    "cap_quyen_loi_ap_dung", "cong_ty_1", "ten_bao_hiem_thanh_toan",
    "quan_he_voi_cap_quyen_loi_ap_dung", "ngay_cuoi_cap_nhat",
]
# Customer attributes carried into the spending report.
SPENDING_CUSTOMER_COLUMNS = [
    "id", "ten_khach_hang", "pid", "ngay_sinh", "chuyen_vien_tu_van", "nguon_1",
    "nguoi_gioi_thieu_id", "nguoi_gioi_thieu_khach_hang", "nguoi_gioi_thieu_khach_hang_pid",
    "co_phuc_loi_tap_doan", "quan_he_voi_cap_quyen_loi_ap_dung", "cap_quyen_loi_ap_dung",
    "cong_ty_1", "ten_bao_hiem_thanh_toan",
]
REFERRER = ["nguoi_gioi_thieu_id", "nguoi_gioi_thieu_khach_hang", "nguoi_gioi_thieu_khach_hang_pid"]
# -----------------------------------------------------------------------------


def any_of(conditions: list[Column]) -> Column:
    """OR of several conditions (``a LIKE x OR a LIKE y``)."""
    return reduce(operator.or_, conditions)


def with_revenue(df: DataFrame, rules: RevenueRules, name: str = "revenue") -> DataFrame:
    """Append the rule-based net revenue of each line."""
    amount = amount_value(F.col(AMOUNT), df.schema[AMOUNT].dataType, rules.amount_type)
    return df.withColumn(name, net_revenue(F.col(PAYER), F.col(KIND), amount, rules))


def in_period(df: DataFrame, rules: RevenueRules, col: str = ENTRY_DATE) -> DataFrame:
    """``col::date > after AND col::date < before`` (both ends exclusive).

    Written on the raw column so the bounds reach the Parquet scan.
    """
    d = F.to_date(F.col(col))
    return df.filter((d > F.lit(rules.period_after).cast("date"))
                     & (d < F.lit(rules.period_before).cast("date")))


def newest_customers(customers: DataFrame, columns: list[str]) -> DataFrame:
    """Newest version of every non-NULL customer id (``DISTINCT ON (id)``)."""
    cols = list(dict.fromkeys(columns + [VERSION_UPDATED]))
    base = customers.filter(F.col("id").isNotNull()).select(*cols)
    return latest_by_key(base, ["id"], [newest_first(VERSION_UPDATED)], ties="one")


def valid_period_bills(sales: DataFrame, cancellations: DataFrame, columns: list[str],
                       rules: RevenueRules) -> DataFrame:
    """One line per bill inside the period (newest update), cancelled bills
    removed, with net revenue.

    Cancellation is decided per bill, the ranking key, so removing cancelled
    bills before ranking gives the same rows and ranks less data.
    """
    cols = list(dict.fromkeys(columns + [BILL, BILL_UPDATED]))
    period = in_period(sales, rules).select(*cols)
    live = exclude_keys(period, cancellations, BILL)
    newest = latest_by_key(live, [BILL], [newest_first(BILL_UPDATED)], ties="one")
    return with_revenue(newest, rules)


def current_bills(sales: DataFrame, cancellations: DataFrame,
                  rules: RevenueRules = RevenueRules()) -> DataFrame:
    """All distinct lines carrying the newest update of their bill (ties
    kept, ``Rank_HD`` = 1), cancelled bills removed, with net revenue.

    Cancellation is decided per bill, so cancelled bills go first. Distinct
    runs after the rank: rank 1 does not depend on duplicates.
    """
    live = exclude_keys(sales.select(*BILL_COLUMNS), cancellations, BILL)
    newest = newest_rows(live, [BILL], BILL_UPDATED, rank_col="Rank_HD", distinct=True)
    return with_revenue(newest, rules).select(*BILL_COLUMNS, "Rank_HD", "revenue")


def customer_spending(sales: DataFrame, customers: DataFrame, cancellations: DataFrame,
                      rules: RevenueRules = RevenueRules()) -> DataFrame:
    """R2: spending of each customer in the period, newest customer data.

    Package visits and the revenue sums come from one aggregate. After the
    per-bill rank every bill occurs once, so ``count(DISTINCT bill)`` is a
    plain conditional count and needs no second shuffle.
    """
    lc = newest_customers(customers, SPENDING_CUSTOMER_COLUMNS)
    bills = valid_period_bills(
        sales, cancellations,
        [CUSTOMER, BILL, "loai_du_lieu", KIND, "san_pham", PAYER, AMOUNT], rules)
    kind, rev, bill = F.col(KIND), F.col("revenue"), F.col(BILL)
    herbal = kind == rules.herbal_kind
    drugs = kind.isin(*rules.drug_and_product_kinds)
    product = F.col("san_pham")
    package = ((F.col("loai_du_lieu") == rules.package_data_kind)
               & (kind == rules.package_kind)
               & any_of([product.contains(w) for w in rules.package_product_words]))
    zero = F.lit(0)
    spend = bills.groupBy(CUSTOMER).agg(
        F.count(F.when(herbal, bill)).alias("so_don_thuoc"),
        F.coalesce(F.sum(F.when(herbal, rev).otherwise(zero)), zero).alias("dt_thuoc"),
        F.coalesce(F.sum(F.when(drugs, rev).otherwise(zero)), zero).alias("dt_bdvasp"),
        F.coalesce(F.sum(F.when(kind == rules.fnb_kind, rev).otherwise(zero)), zero).alias("dt_fnb"),
        F.count(F.when(package, bill)).alias("so_lan_len_goi"),
        F.coalesce(F.sum(F.when(~kind.isin(rules.herbal_kind, *rules.drug_and_product_kinds), rev)
                         .otherwise(zero)), zero).alias("dt_khongdungthuoc"),
        F.coalesce(F.sum(rev), zero).alias("tongdt"),
    )
    first_last = first_last_day(sales, cancellations)
    out = (lc.join(spend, lc["id"] == spend[CUSTOMER], "inner").drop(CUSTOMER)
             .join(first_last, lc["id"] == first_last[CUSTOMER], "left"))
    ngay_sinh_type = customers.schema["ngay_sinh"].dataType
    return out.select(
        "id", "ten_khach_hang", "pid",
        parse_flexible_date(F.col("ngay_sinh"), ngay_sinh_type).alias("ngay_sinh_chuan"),
        *SPENDING_CUSTOMER_COLUMNS[4:],
        "Ngay_dau_tien", "Ngay_cuoi_cung", "so_don_thuoc", "dt_thuoc", "dt_bdvasp", "dt_fnb",
        "so_lan_len_goi", "dt_khongdungthuoc", "tongdt",
    )


def first_last_day(sales: DataFrame, cancellations: DataFrame) -> DataFrame:
    """First and last entry date per customer id over all time, cancelled
    bills removed (partial aggregation first: a hot customer is reduced on
    the map side)."""
    live = exclude_keys(sales.select(CUSTOMER, BILL, ENTRY_DATE), cancellations, BILL)
    d = F.to_date(F.col(ENTRY_DATE))
    return live.groupBy(CUSTOMER).agg(F.min(d).alias("Ngay_dau_tien"),
                                      F.max(d).alias("Ngay_cuoi_cung"))


def referral_spending(sales: DataFrame, customers: DataFrame, cancellations: DataFrame,
                      rules: RevenueRules = RevenueRules()) -> DataFrame:
    """Period revenue of referred customers rolled up to their referrer.

    Customers without a stored version drop out (inner join); a NULL
    referrer triple is one group.
    """
    lc = newest_customers(customers, ["id"] + REFERRER)
    bills = valid_period_bills(sales, cancellations, [CUSTOMER, BILL, KIND, PAYER, AMOUNT], rules)
    per_customer = bills.groupBy(CUSTOMER).agg(F.sum("revenue").alias("dtf1"))
    joined = lc.join(per_customer, lc["id"] == per_customer[CUSTOMER], "inner")
    return joined.groupBy(*REFERRER).agg(F.count(F.lit(1)).alias("slf1"),
                                         F.sum("dtf1").alias("dtf1"))


def visit_bounds(sales: DataFrame, customers: DataFrame, cancellations: DataFrame) -> DataFrame:
    """R4 + R5: first and last visit day per (id, name) of the newest
    customer version, over all time, cancelled bills removed.

    Sales whose customer has no stored version form one (NULL, NULL) group.
    Sales are reduced to one row per customer id before the join, so the
    join sees customers, not sales lines.
    """
    lc = latest_by_key(customers.select("id", "ten_khach_hang", VERSION_UPDATED), ["id"],
                       [newest_first(VERSION_UPDATED)], ties="one")
    per_id = first_last_day(sales, cancellations)
    joined = per_id.join(lc, per_id[CUSTOMER] == lc["id"], "left")
    return joined.groupBy("id", "ten_khach_hang").agg(
        F.min("Ngay_dau_tien").alias("Ngay_dau_tien"),
        F.max("Ngay_cuoi_cung").alias("Ngay_cuoi_cung"))


def first_visit(sales: DataFrame, customers: DataFrame, cancellations: DataFrame) -> DataFrame:
    """R4 alone."""
    return visit_bounds(sales, customers, cancellations).drop("Ngay_cuoi_cung")


def last_visit(sales: DataFrame, customers: DataFrame, cancellations: DataFrame) -> DataFrame:
    """R5 alone."""
    return visit_bounds(sales, customers, cancellations).drop("Ngay_dau_tien")


def latest_customer(customers: DataFrame) -> DataFrame:
    """Newest version of each customer id with its update date
    (``Ngayudpate``) and rank (``Ngaymoinhat`` = 1). The NULL id is one key."""
    ranked = latest_by_key(customers.select(*CUSTOMER_COLUMNS), ["id"],
                           [newest_first(VERSION_UPDATED)], ties="one", rank_col="Ngaymoinhat")
    return ranked.select(*CUSTOMER_COLUMNS,
                         F.to_date(VERSION_UPDATED).alias("Ngayudpate"), "Ngaymoinhat")


def daily_revenue(sales: DataFrame, amount_col: str = "doanh_thu_thuc_hien",
                  rules: RevenueRules = RevenueRules()) -> DataFrame:
    """Revenue summed per entry day, newest day first."""
    amount = amount_value(F.col(amount_col), sales.schema[amount_col].dataType, rules.amount_type)
    return (sales.groupBy(F.to_date(ENTRY_DATE).alias(ENTRY_DATE))
                 .agg(F.sum(amount).alias("doanh_thu"))
                 .orderBy(F.col(ENTRY_DATE).desc_nulls_first()))


def revenue_by_kind(sales: DataFrame, cancellations: DataFrame,
                    rules: RevenueRules = RevenueRules()) -> DataFrame:
    """Net revenue of the current bills per revenue type and data kind with
    the spending report's conditional measures (``<> ALL``, ``LIKE``)."""
    bills = current_bills(sales, cancellations, rules)
    kind, rev = F.col(KIND), F.col("revenue")
    product = F.col("san_pham")
    words = any_of([product.contains(w) for w in rules.package_product_words])
    zero = F.lit(0)
    return bills.groupBy(KIND, "loai_du_lieu").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.sum(F.when(~kind.isin(rules.herbal_kind, *rules.drug_and_product_kinds), rev)
                         .otherwise(zero)), zero).alias("dt_khongdungthuoc"),
        F.coalesce(F.sum(F.when(words, rev).otherwise(zero)), zero).alias("dt_goi"),
        F.sum(rev).alias("tongdt"),
    )
