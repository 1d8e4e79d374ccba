from lakemart.functions.dates import date_key, minus_millis, order_number, truncate
from lakemart.functions.keys import (normalize_expr, normalize_str, surrogate_key,
                                     surrogate_key_expr)

__all__ = ["date_key", "minus_millis", "order_number", "truncate", "normalize_expr",
           "normalize_str", "surrogate_key", "surrogate_key_expr"]
