"""Column masks as built-in expressions (no UDF: they stay in codegen).

Mask types follow the public policy-engine names; the transforms use the
public SQL mask-function semantics (Spark's ``mask``) (letters and digits -> 'x' for the
show-first/last kinds, other characters kept).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Supported mask type names.
MASK_TYPES = ["MASK", "MASK_SHOW_LAST_4", "MASK_SHOW_FIRST_4", "MASK_HASH", "MASK_NULL",
              "MASK_NONE", "MASK_DATE_SHOW_YEAR", "CUSTOM"]


def _xx(c: Column) -> Column:
    return F.mask(c, F.lit("x"), F.lit("x"), F.lit("x"), F.lit(None).cast("string"))


def show_first_4(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 4), _xx(F.substring(c, 5, 1 << 30)))


def show_last_4(c: Column) -> Column:
    n = F.length(c)
    return F.when(n <= 4, c).otherwise(F.concat(_xx(F.substring(c, 1, n - 4)), F.substring(c, -4, 4)))


def custom_value(name: str, value_expr: str) -> str:
    """The expression of a CUSTOM mask with ``{col}`` as the quoted column."""
    return value_expr.replace("{col}", "`" + name.replace("`", "``") + "`")


def mask_column(name: str, dtype: T.DataType, mask_type: str | None, value_expr: str | None,
                condition_expr: str | None = None) -> Column:
    """The masked value of column ``name`` (keeps the column name).

    With ``condition_expr`` only rows for which it is FALSE show the raw value; where it is NULL the mask holds.
    """
    c = F.col(name)
    is_str = isinstance(dtype, T.StringType)
    is_time = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if mask_type in (None, "MASK_NONE"):
        out = c
    elif mask_type == "MASK_NULL":
        out = F.lit(None).cast(dtype)
    elif mask_type == "MASK_HASH":
        out = F.sha2(c.cast("string"), 256) if is_str else F.lit(None).cast(dtype)
    elif mask_type == "MASK" and is_str:
        out = F.mask(c)
    elif mask_type == "MASK_SHOW_FIRST_4" and is_str:
        out = show_first_4(c)
    elif mask_type == "MASK_SHOW_LAST_4" and is_str:
        out = show_last_4(c)
    elif mask_type == "MASK_DATE_SHOW_YEAR" and is_time:
        out = F.make_date(F.year(c), F.lit(1), F.lit(1)).cast(dtype)
    elif mask_type == "CUSTOM" and value_expr:
        out = F.expr(custom_value(name, value_expr)).cast(dtype)
    else:
        # A string mask on a non-string column shows nothing.
        out = F.lit(None).cast(dtype)
    if condition_expr and condition_expr.strip():
        out = F.when(~F.coalesce(F.expr(condition_expr), F.lit(True)), c).otherwise(out)
    return out.alias(name)
