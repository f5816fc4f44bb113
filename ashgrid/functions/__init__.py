"""Column expressions.  Every function returns a ``Column`` built from
Spark's own functions, so it compiles into whole-stage codegen; there is no
Python UDF anywhere in the package."""

from ashgrid.functions.numeric import component_sum, percent_of, round_half_up
from ashgrid.functions.text import (category, clean_text, null_if, split_known,
                                    split_values, unit_key)
from ashgrid.functions.dates import parse_date

__all__ = ["component_sum", "percent_of", "round_half_up", "category",
           "clean_text", "null_if", "split_known", "split_values", "unit_key",
           "parse_date"]
