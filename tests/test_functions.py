"""Tables of inputs for the scalar functions, with NULL, empty, boundary and bad values."""

import datetime as d
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from settleflow.functions import conditions as cd
from settleflow.functions import dates as dt
from settleflow.functions import numeric as nm
from settleflow.functions import settlement as st
from settleflow.functions import text as tx

A, B = F.col("a"), F.col("b")


def values(spark, kind, inputs, column):
    """The results of ``column`` over ``a`` in input order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)]
    return [r["v"] for r in spark.createDataFrame(rows, f"i int, {kind}").select("i", column.alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "column, inputs, expected",
    [
        (tx.trim(A), ["  x ", "", None], ["x", "", None]),
        (tx.right(A, 2), ["abc", "a", "", None], ["bc", "a", "", None]),
        (tx.left(A, 2), ["abc", "a", "", None], ["ab", "a", "", None]),
        (tx.length(A), ["é€", "", None], [2, 0, None]),
        (tx.substr(A, 2, 3), ["abcdef", "a", None], ["bcd", "", None]),
        (tx.index(A, "b"), ["abcb", "xyz", None], [2, 0, None]),
        (tx.change(A, ".", "-"), ["a.b.c", "", None], ["a-b-c", "", None]),
        (tx.contains(A, "%"), ["50%", "50", None], [True, False, None]),
        (tx.replace_all(A, "[0-9]", "#"), ["a1b22", "", None], ["a#b##", "", None]),
        (tx.is_empty(A), ["", " ", None], [True, False, None]),
        (tx.lpad(A, 3, "0"), ["7", "12345", "", None], ["007", "123", "000", None]),
        (tx.split(A, "|"), ["a|b||", "", "a.b", None], [["a", "b", "", ""], [""], ["a.b"], None]),
        (tx.split(A, "\\E."), ["x\\E.y"], [["x", "y"]]),
        (tx.element(tx.split(A, ","), 2), ["a,b", "a", None], ["b", None, None]),
        (tx.network_id(A), ["STLMTP_1234_x.txt", "ACTIV_12.txt", "A_1234567_b", "A_999.ST", None], ["1234", None, None, "999", None]),
        (tx.strip_prefix(A), ["12.a.txt", "a.txt", "3.4.b", None], ["a.txt", "a.txt", "4.b", None]),
        (tx.mask_match(A, "*.ST"), ["x.ST", "x.STX", "xST", None], [True, False, False, None]),
        (tx.mask_match(A, "a?[!0-9]*"), ["abc", "ab1", "abx.y"], [True, False, True]),
        (tx.mask_match(A, "[]x]b"), ["]b", "xb", "yb"], [True, True, False]),
        (tx.json_property(A, "Kind"), ['{"Kind":"a","kind":"b"}', '{"kind":2}', "{}", "{bad", None], ["a", "2", "", "", ""]),
        (cd.parse_double(A, lenient=True), ["1.5", "x", "", None], [1.5, None, None, None]),
        (cd.parse_int(A, lenient=True), ["12", "-3", "x", None], [12, -3, None, None]),
        (cd.nvl(A, "z"), ["a", None], ["a", "z"]),
        (cd.ternary(A == "a", "yes", "no"), ["a", "b", None], ["yes", "no", "no"]),
        (cd.literal(""), ["a"], [None]),
        (dt.try_to_timestamp(A, "YYYYMMDD"), ["20240229", "20230229", "x", None], [d.datetime(2024, 2, 29), None, None, None]),
        (st.origpay_ind(A), ["1", "2", "3", None], ["X", "O", "P", "X"]),
        (st.century_date_fix(A), ["1210203", "1290203", "1300203", "1200203", "12", "", None],
         ["20210203", "20290203", "1300203", "1200203", "12", "", None]),
    ],
)
def test_text_column(spark, column, inputs, expected):
    assert values(spark, "a string", inputs, column) == expected


@pytest.mark.parametrize(
    "column, inputs, expected",
    [
        (st.rt2_negate(A, B), [("2", 5.0), ("1", 5.0), (None, 5.0), ("2", None)], [-5.0, 5.0, 5.0, None]),
        (st.share_of_fx_usd(A, B, F.lit(3), F.lit(1)), [("2", 10.0), ("5", 10.0), ("1", 10.0), ("4", 10.0), ("3", 10.0), (None, 1.0)],
         [6.0, 6.0, -1.0, -1.0, 0.0, 0.0]),
        (st.share_of_fx_loc_rec(A, B, F.lit(3), F.lit(1)), [("2", 10.0), ("1", 10.0), ("9", 10.0)], [-1.0, 6.0, 0.0]),
        (st.share_of_charges(A, B, F.lit(4)), [("5", 10.0), ("4", 10.0), ("7", 10.0)], [-4.0, 6.0, 0.0]),
        (st.clear_principal(F.lit("P"), A, B), [("1", 5.0), ("4", 5.0), ("2", 5.0)], [-5.0, -5.0, 5.0]),
        (st.clear_principal(F.lit("S"), A, B), [("1", 5.0)], [5.0]),
        (st.basicha(A, B), [("2", 5.0), ("2", -5.0), ("1", 5.0), ("3", -5.0), (None, 5.0), ("2", None)], [-5.0, -5.0, 5.0, -5.0, 5.0, None]),
        (st.shacha(B, F.lit(1.5)), [("", 5.0), ("", None)], [3.5, None]),
    ],
)
def test_formula(spark, column, inputs, expected):
    assert values(spark, "a string, b double", inputs, column) == expected


def test_decimals(spark):
    pairs = [(Decimal(10), Decimal(3)), (Decimal("2.675"), Decimal(1)), (Decimal("-2.675"), Decimal(1)), (Decimal(1), Decimal(0)), (None, Decimal(1))]
    kind = "a decimal(38,4), b decimal(38,4)"
    cents = lambda *texts: [None if t is None else Decimal(t) for t in texts]
    assert values(spark, kind, pairs, nm.bd_divide(A, B, 2)) == cents("3.33", "2.68", "-2.68", None, None)
    assert values(spark, kind, pairs, nm.set_scale(A, 2)) == cents("10.00", "2.68", "-2.68", "1.00", None)
    assert values(spark, kind, pairs, nm.compare_to(A, B)) == [1, 1, -1, 1, None]
    assert values(spark, kind, pairs[:2], nm.bd_multiply(A, B)) == cents("30", "2.675")
    assert values(spark, kind, pairs[:2], nm.bd_subtract(A, nm.bd_one())) == cents("9", "1.675")
    assert values(spark, kind, pairs[2:3], nm.bd_abs(nm.bd_negate(A))) == cents("2.675")


def test_strict_casts_raise(spark):
    for column in (cd.parse_double(A), cd.parse_int(A), dt.parse_date("yyyy", A), dt.to_date(A, "YYYY-MM-DD")):
        with pytest.raises(PySparkException):
            values(spark, "a string", ["bad"], column)


def test_dates(spark):
    at = d.datetime(2024, 1, 31, 23, 5, 9)
    kind = "a timestamp_ntz"
    assert values(spark, kind, [at], dt.to_char(A, "DD.MM.YY HH24:MI:SS")) == ["31.01.24 23:05:09"]
    assert values(spark, kind, [at], dt.format_date("yyyyMMdd", A)) == ["20240131"]
    assert values(spark, kind, [at], dt.convert_tz("UTC", "America/New_York", A)) == [d.datetime(2024, 1, 31, 18, 5, 9)]
    assert values(spark, kind, [at, None], dt.run_stamp(A)) == ["20240131230509", None]
    assert values(spark, kind, [at], dt.file_stamp(A)) == ["01312024230509"]
    assert dt.java_pattern("YYYY-MM-DDTHH24") == "yyyy-MM-dd'T'HH"


def test_entry_id_keeps_all_digits(spark):
    made = st.entry_id(F.lit("S"), F.lit("x"), F.lit(3), A)
    assert values(spark, "a bigint", [7, 999999, 1234567], made) == ["Sx3000007", "Sx3999999", "Sx31234567"]


def test_products_and_quotients_are_exact(spark):
    """Against exact decimals: amounts of every size, rounded once, half up."""
    rng = random.Random(1)
    size = lambda most: rng.randrange(-(10 ** rng.randrange(1, most)), 10 ** rng.randrange(1, most))
    rows = [(Decimal(size(24)) / 10_000, Decimal(size(15)) / 10_000) for _ in range(1500)]
    rows += [
        (Decimal(a), Decimal(b))
        for a, b in (
            ("0.1234", "0.1234"), ("1e15", "7"), ("0", "3"), ("0.0001", "1e29"), ("99999999999999999999999999999", "1e29"), ("9999.9999", "0.0001"),
            ("0.9999", "0.9999"), ("2", "3"), ("-2", "3"), ("1", "8"), ("0.0005", "0.5"), ("-0.0005", "0.5"), ("1", "0"),
        )
    ]
    rows += [(None, Decimal(1)), (Decimal(1), None)]
    df = spark.createDataFrame(rows, "a decimal(38,4), b decimal(38,4)")
    a, b = F.col("a"), F.col("b")
    fits = F.abs(a.cast("double") * b.cast("double")) < 1e28
    with localcontext() as context:
        context.prec = 90
        for scale in (0, 2, 4, 6, 8):
            at = Decimal(1).scaleb(-scale)
            for r in df.select("a", "b", nm.bd_divide(a, b, scale).alias("q"), F.when(fits, nm.bd_multiply(a, b, scale)).alias("p")).collect():
                known = r["a"] is not None and r["b"] is not None
                assert r["q"] == ((r["a"] / r["b"]).quantize(at, ROUND_HALF_UP) if known and r["b"] else None), (r, scale)
                if r["p"] is not None or known and abs(r["a"] * r["b"]) < 10**27:
                    assert r["p"] == (r["a"] * r["b"]).quantize(at, ROUND_HALF_UP), (r, scale)
    large = spark.createDataFrame([(Decimal("1e30"), Decimal("7"))], "a decimal(38,4), b decimal(38,4)")
    q, p = large.select(nm.bd_divide(a, b, 4), nm.bd_multiply(a, b, 4)).first()
    assert (q, p) == (Decimal("142857142857142857142857142857.1429"), Decimal("7e30"))
    with pytest.raises(Exception, match="cannot be represented"):
        large.select(nm.bd_multiply(a, b)).collect()


def test_products_and_quotients_are_compiled(spark):
    """No value is bound by a lambda, which Spark interprets row by row, and what a quotient repeats is computed once."""
    df = spark.range(3).select(F.col("id").cast("decimal(38,4)").alias("a"), (F.col("id") + 7).cast("decimal(38,4)").alias("b"))
    for column in (nm.bd_multiply(A, B), nm.bd_multiply(A, B, 4), nm.bd_divide(A, B, 8), nm.bd_divide(A, B, 2)):
        assert "lambda" not in df.select(column)._jdf.queryExecution().optimizedPlan().toString()


def test_quotients_near_ties_and_limits(spark):
    """A hair beside a tie, and on both sides of what is divided in one step."""
    pairs = [
        (Decimal(a), Decimal(b))
        for b in ("99999.9999", "99999.9998", "100000", "0.0002", "3.0007", "-99999.9999")
        for a in ("9999999999999999.9999", "10000000000000000", "-9999999999999999.9999", "0.0001", "-0.0001", "49999.9999", "50000", "5000000000000000.0001")
    ]
    pairs += [(Decimal(1), Decimal(0)), (Decimal("1e20"), Decimal(0)), (None, Decimal("1e20")), (Decimal("1e20"), None), (Decimal("1e20"), Decimal("1e20"))]
    with localcontext() as context:
        context.prec = 90
        for scale in (0, 2, 4, 5, 8):
            exact = [(a / b).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP) if a is not None and b else None for a, b in pairs]
            assert values(spark, "a decimal(38,4), b decimal(38,4)", pairs, nm.bd_divide(A, B, scale)) == exact
