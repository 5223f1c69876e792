"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from .text import (base_code, clean_text, collapse_ws, concat_blank, phone_digits,
                   split_part, title_case, two_decimals, zero_pad)
from .rules import case_map, price_band, floor_zero

__all__ = [
    "base_code", "clean_text", "collapse_ws", "concat_blank", "phone_digits", "split_part",
    "title_case", "two_decimals", "case_map", "price_band", "floor_zero", "zero_pad",
]
