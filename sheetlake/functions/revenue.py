"""Net revenue rule and the constants of the revenue reports."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType

# --- Fixed values: they must equal the source system's report definitions. ---
# Payers whose "other" revenue is booked as a rebate of -85 %.
REBATE_PAYERS = ("SPĐ", "SPD - Prepaid", "Ưu đãi nội bộ")
# Payers whose revenue counts as zero (the rebate payers come first).
ZERO_PAYERS = ("SPĐ", "SPD - Prepaid", "Ưu đãi nội bộ", "KHKD SPĐ",
               "Giảm VinClub", "Tích điểm VinClub", "VinID", "Prepaid")
# Revenue type "other": counted at 15 % unless the payer is listed above.
OTHER_KIND = "Khác"
REBATE_FACTOR = Decimal("-0.85")
OTHER_FACTOR = Decimal("0.15")
# Revenue types of the customer-spending report.
HERBAL_KIND = "Thuốc đông y"
DRUG_AND_PRODUCT_KINDS = ("Biệt dược", "Sản phẩm")
FNB_KIND = "FnB"
# A treatment-package visit: payment line, package type, and a product name
# containing one of these words.
PACKAGE_DATA_KIND = "Thông tin thanh toán"
PACKAGE_KIND = "Gói trị liệu"
PACKAGE_PRODUCT_WORDS = ("Xoa bóp", "Hào châm")
# Reporting period of the half-year reports (exclusive on both ends).
PERIOD_AFTER = "2025-12-31"
PERIOD_BEFORE = "2026-07-16"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class RevenueRules:
    """Parameters of the revenue rule and of the spending report."""

    rebate_payers: tuple[str, ...] = REBATE_PAYERS
    zero_payers: tuple[str, ...] = ZERO_PAYERS
    other_kind: str = OTHER_KIND
    rebate_factor: Decimal = REBATE_FACTOR
    other_factor: Decimal = OTHER_FACTOR
    herbal_kind: str = HERBAL_KIND
    drug_and_product_kinds: tuple[str, ...] = DRUG_AND_PRODUCT_KINDS
    fnb_kind: str = FNB_KIND
    package_data_kind: str = PACKAGE_DATA_KIND
    package_kind: str = PACKAGE_KIND
    package_product_words: tuple[str, ...] = PACKAGE_PRODUCT_WORDS
    period_after: str = PERIOD_AFTER
    period_before: str = PERIOD_BEFORE
    # 20 whole and 14 fraction digits: times a two-digit factor this still fits
    # 38 digits, so the rule's only rounding is the last one
    amount_type: DecimalType = DecimalType(34, 14)


def amount_value(c: Column, dtype: DataType, amount_type: DecimalType) -> Column:
    """``NULLIF(x::text, '')::numeric``: blank text is NULL, the rest decimal. A
    decimal column narrow enough for the rule's factors keeps its own type."""
    if isinstance(dtype, StringType):
        return F.nullif(c, F.lit("")).cast(amount_type)
    if isinstance(dtype, DecimalType) and dtype.precision <= amount_type.precision:
        return c
    return c.cast(amount_type)


def net_revenue(payer: Column, kind: Column, amount: Column,
                rules: RevenueRules = RevenueRules()) -> Column:
    """Revenue of one line, rounded half away from zero to a whole number.

    ``amount`` must already be decimal (see :func:`amount_value`); rounding a
    decimal is exact, rounding a double is not. A NULL payer falls through
    both payer branches.
    """
    rebate = F.lit(rules.rebate_factor)
    other = F.lit(rules.other_factor)
    value = (
        F.when(payer.isin(*rules.rebate_payers) & (kind == rules.other_kind), amount * rebate)
        .when(payer.isin(*rules.zero_payers), F.lit(Decimal(0)))
        .when(kind == rules.other_kind, other * amount)
        .otherwise(amount)
    )
    return F.round(value, 0)
