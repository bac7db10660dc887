"""Scalar column functions: dates, tenors, amounts, codes (all native Spark expressions)."""

from .amounts import (AMOUNT, WIDE, comma_decimal, empty_exposure, fx_exposure,
                      fx_exposure_entries, isin_qualifier, nominal, placeholder_product_id,
                      product_key, scale_by_vol, vol_currency)
from .dates import (business_date_key, date_parts, effective_filter_date, iso_date_text,
                    parse_business_date)
from .tenors import pillar_days, recode, tenor_code_days, tenor_days

__all__ = [
    "AMOUNT", "WIDE", "comma_decimal", "empty_exposure", "fx_exposure", "fx_exposure_entries",
    "isin_qualifier", "nominal", "placeholder_product_id", "product_key", "scale_by_vol",
    "vol_currency", "business_date_key", "date_parts", "effective_filter_date", "iso_date_text",
    "parse_business_date", "pillar_days", "recode", "tenor_code_days", "tenor_days",
]
