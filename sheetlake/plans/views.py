"""The reports as named DataFrames, for SQL scripts (run_script mode)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sheetlake.functions.revenue import RevenueRules
from sheetlake.plans import reports as R


def report_views(sales: DataFrame, customers: DataFrame, cancellations: DataFrame,
                 rules: RevenueRules = RevenueRules()) -> dict[str, DataFrame]:
    """Lazy report plans by name; nothing runs until a script selects one."""
    views = {
        "current_bills": R.current_bills(sales, cancellations, rules),
        "customer_spending": R.customer_spending(sales, customers, cancellations, rules),
        "referral_spending": R.referral_spending(sales, customers, cancellations, rules),
        "first_visit": R.first_visit(sales, customers, cancellations),
        "last_visit": R.last_visit(sales, customers, cancellations),
        "latest_customer": R.latest_customer(customers),
    }
    if "doanh_thu_thuc_hien" in sales.columns:
        views["daily_revenue"] = R.daily_revenue(sales, rules=rules)
    return views
