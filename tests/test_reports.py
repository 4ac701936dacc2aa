"""Report semantics on hand-written rows (NULL order, ties, cancellations,
the revenue rule and its rounding)."""

import datetime as dt
from decimal import Decimal

from sheetlake.functions.revenue import RevenueRules
from sheetlake.plans import reports as R

SALES = ", ".join(f"{c} string" for c in R.BILL_COLUMNS).replace(
    "ngay_ghi string", "ngay_ghi timestamp").replace(
    "ngay_cap_nhat_hoa_don_cuoi string", "ngay_cap_nhat_hoa_don_cuoi timestamp")
CUST = ", ".join(f"{c} string" for c in R.CUSTOMER_COLUMNS).replace(
    "ngay_cuoi_cap_nhat string", "ngay_cuoi_cap_nhat timestamp")
D = dt.datetime


def sale(bill, cust, kind, payer, amount, entry, upd, data_kind="Thông tin thanh toán", product="x"):
    row = dict.fromkeys(R.BILL_COLUMNS)
    row.update(ma_hoa_don=bill, id_khach_hang=cust, loai_doanh_thu=kind, ten_doi_tuong_thanh_toan=payer,
               so_tien_thuc_te_thu=amount, ngay_ghi=entry, ngay_cap_nhat_hoa_don_cuoi=upd,
               loai_du_lieu=data_kind, san_pham=product)
    return tuple(row[c] for c in R.BILL_COLUMNS)


def cust(cid, name, upd, ref=None, birth=None):
    row = dict.fromkeys(R.CUSTOMER_COLUMNS)
    row.update(id=cid, ten_khach_hang=name, ngay_cuoi_cap_nhat=upd, nguoi_gioi_thieu_id=ref, ngay_sinh=birth)
    return tuple(row[c] for c in R.CUSTOMER_COLUMNS)


IN = D(2026, 3, 1)


def frames(spark, sales, customers=(), cancelled=()):
    return (spark.createDataFrame(list(sales), SALES),
            spark.createDataFrame(list(customers), CUST),
            spark.createDataFrame([(c,) for c in cancelled], "ma_hoa_don string"))


def test_revenue_rule_branches_and_rounding(spark):
    s, _, c = frames(spark, [
        sale("b1", "k", "Khác", "SPĐ", "10", IN, IN),          # -8.5 -> -9
        sale("b2", "k", "Khác", "VinID", "10", IN, IN),        # zero payer -> 0
        sale("b3", "k", "Khác", None, "10", IN, IN),           # 1.5 -> 2
        sale("b4", "k", "FnB", "Prepaid", "10", IN, IN),       # zero payer -> 0
        sale("b5", "k", "FnB", None, "2.5", IN, IN),           # 2.5 -> 3
        sale("b6", "k", "FnB", None, "", IN, IN),              # blank -> NULL
        sale("b7", "k", "Khác", "SPD - Prepaid", "-10", IN, IN),  # 8.5 -> 9
    ])
    got = {r.ma_hoa_don: r.revenue for r in R.with_revenue(s, RevenueRules()).collect()}
    assert got == {"b1": Decimal(-9), "b2": 0, "b3": 2, "b4": 0, "b5": 3, "b6": None, "b7": 9}


def test_current_bills_null_first_ties_kept_cancel(spark):
    s, _, c = frames(spark, [
        sale("b1", "k", "FnB", None, "1", IN, D(2026, 1, 1)),
        sale("b1", "k", "FnB", None, "2", IN, D(2026, 1, 2)),
        sale("b1", "k", "FnB", None, "3", IN, D(2026, 1, 2)),   # tie on newest: both kept
        sale("b1", "k", "FnB", None, "3", IN, D(2026, 1, 2)),   # exact duplicate: once
        sale("b2", "k", "FnB", None, "4", IN, D(2026, 1, 5)),
        sale("b2", "k", "FnB", None, "5", IN, None),            # NULL update ranks first
        sale("b3", "k", "FnB", None, "6", IN, IN),              # cancelled
        sale(None, "k", "FnB", None, "7", IN, IN),              # NULL bill: never cancelled
        sale(None, "k", "FnB", None, "8", IN, D(2026, 1, 1)),
    ], cancelled=["b3", None])
    got = sorted((r.ma_hoa_don or "-", r.so_tien_thuc_te_thu) for r in R.current_bills(s, c).collect())
    assert got == [("-", "7"), ("b1", "2"), ("b1", "3"), ("b2", "5")]


def test_customer_spending(spark):
    rules = RevenueRules()
    s, cu, c = frames(spark, [
        sale("b1", "k1", "Thuốc đông y", None, "100", IN, IN),
        sale("b1", "k1", "Thuốc đông y", None, "999", IN, D(2020, 1, 1)),   # older line of b1
        sale("b2", "k1", "Biệt dược", None, "50", IN, IN),
        sale("b3", "k1", "Gói trị liệu", None, "30", IN, IN, product="Xoa bóp 10 lần"),
        sale("b4", "k1", "FnB", None, "20", D(2025, 12, 31), IN),          # on the bound: outside
        sale("b5", "k1", "FnB", None, "20", D(2024, 5, 1), IN),            # first day, outside
        sale("b6", "k2", "Khác", None, "10", IN, IN),
        sale("b7", "k3", "FnB", None, "10", IN, IN),                       # customer unknown
        sale("b8", "k1", "FnB", None, "10", IN, IN),                       # cancelled
    ], [cust("k1", "old", D(2025, 1, 1)), cust("k1", "new", D(2026, 1, 1), birth="32290.0"),
        cust("k2", "two", D(2026, 1, 1)), cust("k4", "no sales", D(2026, 1, 1))], ["b8"])
    out = {r.id: r for r in R.customer_spending(s, cu, c, rules).collect()}
    assert set(out) == {"k1", "k2"}
    k1 = out["k1"]
    assert k1.ten_khach_hang == "new" and k1.ngay_sinh_chuan == dt.date(1988, 5, 27)
    assert (k1.so_don_thuoc, k1.dt_thuoc, k1.dt_bdvasp, k1.dt_fnb) == (1, 100, 50, 0)
    assert (k1.so_lan_len_goi, k1.dt_khongdungthuoc, k1.tongdt) == (1, 30, 180)
    assert (k1.Ngay_dau_tien, k1.Ngay_cuoi_cung) == (dt.date(2024, 5, 1), dt.date(2026, 3, 1))
    assert out["k2"].tongdt == 2   # 0.15 * 10 = 1.5 -> 2


def test_referral_and_visits(spark):
    s, cu, c = frames(spark, [
        sale("b1", "k1", "FnB", None, "10", IN, IN), sale("b2", "k2", "FnB", None, "5", IN, IN),
        sale("b3", "k3", "FnB", None, "7", IN, IN), sale("b4", "k9", "FnB", None, "1", D(2024, 1, 1), IN),
        sale("b5", "k8", "FnB", None, "1", D(2023, 1, 1), IN),
    ], [cust("k1", "a", IN, ref="r1"), cust("k2", "b", IN, ref="r1"), cust("k3", "c", IN, ref=None)])
    ref = {r.nguoi_gioi_thieu_id: (r.slf1, r.dtf1) for r in R.referral_spending(s, cu, c).collect()}
    assert ref == {"r1": (2, 15), None: (1, 7)}
    visits = {r.id: (r.Ngay_dau_tien, r.Ngay_cuoi_cung) for r in R.visit_bounds(s, cu, c).collect()}
    assert visits[None] == (dt.date(2023, 1, 1), dt.date(2024, 1, 1))   # unmatched sales: one row
    assert visits["k1"] == (dt.date(2026, 3, 1), dt.date(2026, 3, 1))


def test_latest_customer_and_daily_revenue(spark):
    s, cu, c = frames(spark, [sale("b1", "k", "FnB", None, "10", IN, IN),
                              sale("b2", "k", "FnB", None, "5", IN, IN)],
                      [cust("k1", "old", D(2025, 1, 1)), cust("k1", "null-date", None), cust(None, "x", IN)])
    latest = {r.id: (r.ten_khach_hang, r.Ngaymoinhat) for r in R.latest_customer(cu).collect()}
    assert latest == {"k1": ("null-date", 1), None: ("x", 1)}
    day = R.daily_revenue(s, amount_col="so_tien_thuc_te_thu").collect()
    assert [(r.ngay_ghi, r.doanh_thu) for r in day] == [(dt.date(2026, 3, 1), 15)]
