"""Settlement formulas. Amounts are doubles; a direction decides which side bears a cost."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Record types, directions and century codes.
RECEIVE_SIDE = ("2", "5")
PAY_SIDE = ("1", "4")
CENTURY_CODES = ("121", "122", "123", "124", "125", "126", "127", "128", "129")
ORIGIN_MARKS = {"2": "O", "3": "P"}
OTHER_MARK = "X"


def _amount(c: Column) -> Column:
    return c.cast("double")


def _by_direction(direction: Column, receive: Column, pay: Column) -> Column:
    return (
        F.when(direction.isin(*RECEIVE_SIDE), receive)
        .when(direction.isin(*PAY_SIDE), pay)
        .otherwise(F.lit(0.0))
    )


def rt2_negate(rt: Column, value: Column) -> Column:
    return F.when(rt == "2", -_amount(value)).otherwise(_amount(value))


def share_of_fx_usd(direction: Column, rec: Column, pay: Column, fx: Column) -> Column:
    gain = _amount(rec) - _amount(pay) - _amount(fx)
    return _by_direction(direction, gain, -_amount(fx))


def share_of_fx_loc_rec(direction: Column, rec: Column, pay: Column, fx: Column) -> Column:
    gain = _amount(rec) - _amount(pay) - _amount(fx)
    return _by_direction(direction, -_amount(fx), gain)


def share_of_charges(direction: Column, rec: Column, clear: Column) -> Column:
    return _by_direction(direction, -_amount(clear), _amount(rec) - _amount(clear))


def clear_principal(sendpay: Column, direction: Column, value: Column) -> Column:
    paid = (sendpay == "P") & direction.isin(*PAY_SIDE)
    return F.when(paid, -_amount(value)).otherwise(_amount(value))


def origpay_ind(rt: Column) -> Column:
    out = F
    for record_type, mark in ORIGIN_MARKS.items():
        out = out.when(rt == record_type, F.lit(mark))
    return out.otherwise(F.lit(OTHER_MARK))


def century_date_fix(setdate: Column) -> Column:
    value = setdate.cast("string")
    fixed = F.concat(F.lit("20"), F.substr(value, F.lit(2)))
    return F.when(F.left(value, F.lit(3)).isin(*CENTURY_CODES), fixed).otherwise(value)


def basicha(rt: Column, basic: Column) -> Column:
    value = _amount(basic)
    return F.when((rt == "2") & (value >= 0), -value).otherwise(value)


def shacha(total: Column, clear: Column) -> Column:
    return _amount(total) - _amount(clear)


def entry_id(stamp: Column, source: Column, grp: Column, number: Column) -> Column:
    """Stamp, source, group and a running number of at least six digits; no digit is ever cut."""
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(6), F.char_length(digits)), F.lit("0"))
    return F.concat(stamp, source.cast("string"), grp.cast("string"), padded)
