"""Column builders shared by every layer.

Money is summed exactly: the result does not depend on the order in which tasks deliver their
partial sums, so a retried task cannot change a report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the ones existing tables were built with.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
EMAIL_MASK_PATTERN = "(?<=.{2}).(?=.*@)"
EMAIL_MASK_CHAR = "*"
RAW_DATE_FORMAT = "yyyy-MM-dd"

WHOLE_BITS = 20
PART_BITS = 17
#: Decimals that an exact sum keeps of each value unless told otherwise.
SUM_SCALE = 10
#: Decimals of a total. What lies beyond is what doubles of a million and more cannot tell.
TOTAL_SCALE = 6
MAX_SUMMAND = 1e18


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_money(c: Column | str) -> Column:
    return _col(c).cast("decimal(18,4)")


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding on decimal digits, returned as double."""
    return F.round(_col(c).cast("decimal(28,10)"), digits).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; null for a zero or null denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def known_value(c: Column) -> Column:
    """Values that count: NaN is missing, in sums, counts and means alike."""
    return F.when(~F.isnan(c.cast("double")), c)


def money_limbs(c: Column | str, scale: int = SUM_SCALE) -> list[Column]:
    """Five integers of at most 20 bits each that make up a number rounded to ``scale`` decimals (half up).

    Three hold the integer part, two the fraction. Their BIGINT sums cannot overflow below 2**43 rows, and
    limb sums of parts of a group add up to those of the whole.
    """
    value = known_value(_col(c)).cast("double")
    value = F.when(
        F.abs(value) >= MAX_SUMMAND, F.raise_error(F.lit("value out of range for an exact sum"))
    ).otherwise(value)
    whole = F.floor(value)
    part = F.floor((value - whole) * 10**scale + 0.5)
    mask = 2**WHOLE_BITS - 1
    return [
        F.shiftright(whole, 2 * WHOLE_BITS),
        F.shiftright(whole, WHOLE_BITS).bitwiseAND(mask),
        whole.bitwiseAND(mask),
        F.shiftright(part, PART_BITS),
        part.bitwiseAND(2**PART_BITS - 1),
    ]


def limbs_total(limbs: list[Column], scale: int = SUM_SCALE) -> Column:
    """The number that summed limbs stand for, rounded to TOTAL_SCALE decimals, as DECIMAL(38, scale)."""
    high, middle, low, upper, lower = (c.cast("decimal(19,0)") for c in limbs)
    # Every step is cast to what it can need: beyond 38 digits Spark would give up decimals.
    base = F.lit(2**WHOLE_BITS).cast("decimal(7,0)")
    whole = ((high * base + middle).cast("decimal(28,0)") * base + low).cast(f"decimal(36,{scale})")
    units = (upper * F.lit(2**PART_BITS).cast("decimal(6,0)") + lower).cast("decimal(27,0)")
    part = units * F.lit(f"1e-{scale}").cast(f"decimal({scale},{scale})")
    total = whole + part.cast(f"decimal(36,{scale})")
    return F.round(total, TOTAL_SCALE).cast(f"decimal(38,{scale})")


def money_sum(c: Column | str, scale: int = SUM_SCALE) -> Column:
    """Exact sum of numbers rounded to ``scale`` decimals each (half up), as DECIMAL(38, scale).

    Added up limb by limb: independent of the order of tasks, cheaper than adding DECIMAL values, and
    good for 2**43 rows a group. The total is rounded to TOTAL_SCALE decimals. A value of 1e18 or more in size, infinity included, is an error; so is
    a total of 1e26 or more. NaN counts as null.
    """
    return limbs_total([F.sum(limb) for limb in money_limbs(c, scale)], scale)


def money_count(c: Column | str) -> Column:
    """How many values ``money_sum`` adds up."""
    return F.count(known_value(_col(c)))


def mean_money(c: Column | str, scale: int = SUM_SCALE) -> Column:
    """The exact sum by the number of values, nulls and NaN left out of both."""
    return ratio(money_sum(c, scale), money_count(c))


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def email_mask(c: Column | str) -> Column:
    """Star out everything between the second character and the last '@'."""
    return F.regexp_replace(_col(c), EMAIL_MASK_PATTERN, EMAIL_MASK_CHAR)


def to_day(c: Column | str) -> Column:
    """Raw text to DATE; text that is not a date becomes null instead of failing the job."""
    return F.try_to_date(_col(c), RAW_DATE_FORMAT)


def to_bool(c: Column | str) -> Column:
    return _col(c).try_cast("boolean")


def row_hash(columns: list[str]) -> Column:
    """Order-independent of partitioning; used only to break ties between equal timestamps."""
    return F.xxhash64(*[F.col(c) for c in columns])
