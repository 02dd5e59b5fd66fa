"""Number functions. Amounts of the settlement formulas are doubles; the ``bd_`` family is decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,4)"
# Decimals of an operand, and of the product of two.
SCALE, PRODUCT_SCALE = 4, 8
# Digits of a quotient found at a time; a remainder with so many zeros behind it is still a decimal.
DIGITS = 4
# Below these, an amount and a divisor are divided in one step.
SHORT, SHORT_DIVISOR = 10**16, 10**5


def smul(k, c: Column) -> Column:
    return c.cast("double") * k


def absolute(c: Column) -> Column:
    return F.abs(c.cast("double"))


def bd_literal(value) -> Column:
    """A decimal constant, given as a number or as text."""
    return F.lit(str(value)).cast(DECIMAL)


def big_decimal(c: Column) -> Column:
    return c.cast(DECIMAL)


def bd_zero() -> Column:
    return bd_literal(0)


def bd_one() -> Column:
    return bd_literal(1)


def bd_add(a: Column, b: Column) -> Column:
    return a + b


def bd_subtract(a: Column, b: Column) -> Column:
    return a - b


# The functions below name a value as often as they read it: a projection computes what repeats once, in compiled code.
# A lambda that binds the value (``transform`` of an array) is interpreted row by row, at several times the cost.
def _rounded(negative: Column, whole: Column, fraction: Column, scale: int) -> Column:
    """``whole + fraction`` (a small one) rounded half up to ``scale``, with its sign; too many digits end the job."""
    wide = 38 if scale <= 6 else 37  # what a sum may have so that it keeps its scale
    sign = F.when(negative, -1).otherwise(1).cast("decimal(1,0)")
    total = (whole * sign).cast(f"decimal({wide},{scale})") + F.round(fraction, scale) * sign
    return total.cast(f"decimal(38,{scale})")


def _minus(c: Column) -> Column:
    """The other sign, by a product: a plain minus rounds decimals of more than 34 digits."""
    return c * F.lit(-1).cast("decimal(1,0)")


def _size(c: Column) -> Column:
    return F.when(c < 0, _minus(c)).otherwise(c).cast(DECIMAL)


def bd_multiply(a: Column, b: Column, scale: int = PRODUCT_SCALE) -> Column:
    """Product of two amounts, exact; with a smaller ``scale`` rounded half up to it, once.

    Whole parts and decimals are multiplied apart, as a product of two wide decimals would be cut. A product has up to 29
    whole digits (32 for a scale up to 6); a larger one ends the job.
    """
    if not 0 <= scale <= PRODUCT_SCALE:
        raise ValueError(f"a product has 0 to {PRODUCT_SCALE} decimals")

    a, b = a.cast(DECIMAL), b.cast(DECIMAL)
    whole, part = lambda c: F.floor(_size(c)).cast("decimal(34,0)"), lambda c: (_size(c) - F.floor(_size(c))).cast("decimal(4,4)")
    crossed = (whole(a) * part(b)).cast(DECIMAL) + (whole(b) * part(a)).cast(DECIMAL)
    carried = F.floor(crossed).cast("decimal(38,0)")
    fraction = (crossed - carried).cast("decimal(4,4)") + part(a) * part(b)
    return _rounded((a < 0) != (b < 0), (whole(a) * whole(b)).cast("decimal(38,0)") + carried, fraction, scale)


def bd_negate(a: Column) -> Column:
    return _minus(a.cast(DECIMAL)).cast(DECIMAL)


def bd_abs(a: Column) -> Column:
    return _size(a.cast(DECIMAL))


def bd_divide(a: Column, b: Column, scale: int) -> Column:
    """Quotient rounded half up to ``scale`` (0 to 8), once; NULL for a zero divisor.

    Short amounts are divided at once. Others by a long division: the whole part, then ``DIGITS`` decimals at a time from the remainder, so amounts of any size
    give true digits. A divisor has up to 30 whole digits and a quotient up to 29 (32 for a scale up to 6); larger ones
    end the job.
    """
    if not 0 <= scale <= PRODUCT_SCALE:
        raise ValueError(f"a quotient has 0 to {PRODUCT_SCALE} decimals")
    a, b = a.cast(DECIMAL), b.cast(DECIMAL)
    steps = scale // DIGITS + 1  # one digit more than asked for, at least
    # Most amounts are short: the quotient of the types below has ten decimals more than asked for, and as the divisor has up to nine
    # digits, one that is no tie differs from it by more than those leave open. It is rounded at once; the others are NULL there.
    short = (a > bd_literal(-SHORT)) & (a < bd_literal(SHORT)) & (b > bd_literal(-SHORT_DIVISOR)) & (b < bd_literal(SHORT_DIVISOR))
    decimals = max(scale, SCALE)
    direct = F.when(short & (b != 0), F.round(a.cast(f"decimal({16 + decimals},{decimals})") / b.cast("decimal(9,4)"), scale).cast(f"decimal(38,{scale})"))
    size, by = F.when(~short, _size(a)), F.when(~short & (b != 0), _size(b))

    def parted(x: Column) -> tuple[Column, Column]:
        """Quotient and remainder: the quotient of two decimals has six decimals, its whole part is at most one too large, and the remainder then below 0."""
        near = F.floor(x / by).cast("decimal(38,0)")
        return near, (x - (near * by).cast(DECIMAL)).cast(DECIMAL)

    near, rest = parted(size)
    whole = (near - F.when(rest < 0, 1).otherwise(0)).cast("decimal(38,0)")
    rest = F.when(rest < 0, rest + by).otherwise(rest).cast(DECIMAL)
    # Decimals one too large are left so: those after them, of a remainder below 0, take it back, and the last ones are set right.
    places = DIGITS * steps
    kind = f"decimal({places + 1},{places})"
    fraction = F.lit(0).cast(kind)
    for i in range(1, steps + 1):
        digits, rest = parted((rest * 10**DIGITS).cast(DECIMAL))
        if i == steps:
            digits = digits - F.when(rest < 0, 1).otherwise(0)
        fraction = (fraction + digits.cast(f"decimal({DIGITS + 1},0)") * F.lit("1e-" + str(DIGITS * i)).cast(f"decimal({places},{places})")).cast(kind)
    # One of the two is NULL. Both are always computed (unlike under a condition), so that what repeats in them is found and computed once.
    return F.greatest(direct, _rounded((a < 0) != (b < 0), whole, fraction, scale))


def set_scale(a: Column, scale: int) -> Column:
    """Round half up."""
    return F.round(a, scale)


def compare_to(a: Column, b: Column) -> Column:
    """-1, 0 or 1, NULL when either side is."""
    return F.when(a < b, -1).when(a == b, 0).when(a > b, 1)


def to_text(a: Column) -> Column:
    return a.cast("string")
