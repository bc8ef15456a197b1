"""Column-level rules that keep results identical to the source semantics
under Spark's ANSI mode.

Each helper returns a ``Column``; all of them are built-in expressions and
stay inside whole-stage codegen.

Rules (see README, "semantic rules"):
  * division by zero yields NULL, never an error or NaN/Inf  (try_divide)
  * a null-skipping sum of only missing values is 0            (sum0)
  * rounding is half-to-even                                   (rround)
  * "white space" is space, tab, CR and LF                      (trim_ws)
  * text that is not a number becomes NULL                     (to_number)
  * correlation of a constant series is NULL, not an error     (safe_corr)
  * missing values render as the text "NA" in string building  (na_text)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col_(num), col_(den))


def sum0(c) -> Column:
    """Null-skipping sum that is 0 (not NULL) when every input is missing."""
    return F.coalesce(F.sum(col_(c)), F.lit(0))


def money_sum(c, scale: int = 6) -> Column:
    """Exact, order-independent sum of values with at most ``scale``
    decimals, as double.

    Doubles summed in different orders differ in the last bits; summing the
    decimal form is exact, so every partitioning gives the same answer."""
    return F.sum(col_(c).cast(f"decimal(28,{scale})")).cast("double")


def rround(c, scale: int = 0) -> Column:
    """Round half to even (the rounding rule of the source)."""
    return F.bround(col_(c), scale)


def trim_ws(c) -> Column:
    """Strip spaces, tabs, CR and LF at both ends."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def empty_if_null(c) -> Column:
    """Text keys keep empty text as '' (a CSV reader turns it into NULL)."""
    return F.coalesce(col_(c), F.lit(""))


def to_number(c, strip_pattern: str = ",|%| ") -> Column:
    """'1,439,323,776' -> 1439323776.0, '0.39 %' -> 0.39, 'N.A.' -> NULL."""
    return F.regexp_replace(col_(c).cast("string"), strip_pattern, "").try_cast("double")


INTEGRAL_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


def to_type(c, data_type) -> Column:
    """A cell as ``data_type``.  For integral types the number is parsed
    first ('12.0' is 12); text that is no number is missing, but a number
    that does not fit the type (a fraction, or too large) is an error: it
    must not turn into a missing value unnoticed."""
    name = data_type if isinstance(data_type, str) else data_type.simpleString()
    c = col_(c)
    if name not in INTEGRAL_BITS:
        return c.try_cast(name)
    number, wide = c.try_cast("decimal(38,6)"), c.try_cast("double")
    # the double tells digits that the decimal would round off, or cannot hold
    whole = (number == F.floor(number)) & (wide == F.floor(wide))
    fits = number.isNotNull() & whole & (F.abs(number) <= F.lit(2 ** INTEGRAL_BITS[name] - 1))
    return F.when(wide.isNull() | F.isnan(wide) | fits, number.try_cast(name)).otherwise(
        F.raise_error(F.concat(F.lit(f"does not fit {name}: "), c.cast("string"))).cast(name))


def safe_corr(a, b) -> Column:
    """Pearson correlation; NULL for a constant or too-short series.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column, so the
    ratio is written out with try_divide; like ``corr`` it uses the rows
    where both values are present."""
    a, b = col_(a), col_(b)
    both = a.isNotNull() & b.isNotNull()          # pairwise-complete rows only
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))


def na_text(c) -> Column:
    """String form of a value with NULL shown as 'NA'."""
    return F.coalesce(col_(c).cast("string"), F.lit("NA"))


def _strip_zeros(c: Column) -> Column:
    """'7.00000000000000' -> '7', '1.50000000000000e+05' -> '1.5e+05'."""
    c = F.regexp_replace(c, r"(\.\d*?)0+(e.*)?$", "$1$2")
    return F.regexp_replace(c, r"\.(e|$)", "$1")


def num_text(c, digits: int = 15) -> Column:
    """A number as the source prints it inside text: ``digits`` significant
    digits, no trailing zeros, scientific notation only when it is shorter
    than the fixed form (7.000000000000001 -> '7', 50.0 -> '50',
    100000 -> '1e+05', 0.0001 -> '1e-04'); NULL -> 'NA'.  Integral values
    keep all their digits in fixed form."""
    d = col_(c).cast("double")
    sci = _strip_zeros(F.format_string(f"%.{digits - 1}e", d))
    gen = _strip_zeros(F.format_string(f"%.{digits}g", d))
    integral = F.coalesce((d == F.floor(d)) & (F.abs(d) < F.lit(1e15)), F.lit(False))
    # integer digits are never dropped; a half is rounded to even, as in the source
    whole = (F.abs(d) >= F.lit(10.0 ** (digits - 1))) & (F.abs(d) < F.lit(1e15))
    fixed = (F.when(integral, F.format_string("%.0f", d)).when(whole, F.format_string("%.0f", rround(d)))
             .when(~gen.contains("e"), gen))
    txt = F.when(F.length(fixed) <= F.length(sci), fixed).otherwise(sci)
    return F.when(d.isNull(), F.lit("NA")).when(d == F.lit(0.0), F.lit("0")).otherwise(txt)


# thousands separators: a digit followed by whole groups of three digits up
# to the decimal point or the end, not inside the fraction
_GROUPS = r"(?<!\.\d{0,30})(\d)(?=(\d{3})+(\.|$))"


def pretty_num(c, digits: int = 7) -> Column:
    """A number for display with thousands separators, as the source's
    ``prettyNum(x, big.mark=',')``: ``digits`` significant digits (integer
    digits are never dropped), separators on the integer part only,
    scientific form left as is; NULL -> 'NA'."""
    return F.regexp_replace(num_text(c, digits), _GROUPS, "$1,")


def flag(cond: Column) -> Column:
    """Boolean condition as an integer 0/1 flag."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
