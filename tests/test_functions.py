from datetime import date, datetime

from pyspark.sql import functions as F

from starloom.contracts import COUNTRY_ALIASES
from starloom.functions import dates, keys, repair, text


def values(spark, column, **inputs):
    """Evaluate a column over one row of typed inputs."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or ["id"])
    return df.select(column).first()[0]


def test_text_cleaning(spark):
    assert values(spark, text.clean_text(F.col("x")), x="  a b ") == "a b"
    assert values(spark, text.clean_text(F.col("x")), x="   ") is None
    assert values(spark, text.clean_email(F.col("x")), x=" A@B.Com ") == "a@b.com"
    assert values(spark, text.clean_phone(F.col("x")), x="(1) 2-3.4") == "1234"
    assert values(spark, text.clean_phone(F.col("x")), x=" - ") is None
    assert len(values(spark, text.clean_text(F.col("x")), x="y" * 500)) == 500
    assert len(values(spark, text.clean_text(F.col("x"), 400), x="y" * 500)) == 400


def test_conform_and_flags(spark):
    for raw, want in {" u.s.a. ": "UNITED STATES", "England": "UNITED KINGDOM", "peru": "PERU"}.items():
        assert values(spark, text.conform(F.col("x"), COUNTRY_ALIASES), x=raw) == want
    for raw, want in {"a@b.co": True, "a@b.c": False, "ab.co": False}.items():
        assert values(spark, text.valid_email(F.col("x")), x=raw) is want
    assert values(spark, text.valid_email(F.lit(None).cast("string"))) is False
    assert values(spark, text.effective_sale(F.col("x")), x=" Completed ") is True
    assert values(spark, text.effective_sale(F.lit(None).cast("string"))) is False
    assert values(spark, text.is_active(F.lit(None).cast("boolean"))) is True


def test_alias_table_equals_constant_aliases(spark):
    labels = spark.createDataFrame([("usa",), (" UK ",), ("chile",), (None,)], "country string")
    aliases = spark.createDataFrame(list(COUNTRY_ALIASES.items()), "alias string, label string")
    by_table = [r.country for r in text.conform_by_table(labels, "country", aliases).collect()]
    constant = [r[0] for r in labels.select(text.conform(F.col("country"), COUNTRY_ALIASES)).collect()]
    assert sorted(by_table, key=str) == sorted(constant, key=str)


def test_keys(spark):
    assert values(spark, keys.surrogate_key(F.col("x")), x="CUST-1") == 6252539264518104123
    assert values(spark, keys.surrogate_key(F.col("x"), utf16=True), x="CUST-1") == 6441115390314321721
    null = F.lit(None).cast("string")
    assert values(spark, keys.surrogate_key(null)) == values(spark, keys.surrogate_key(F.lit("<null>")))
    # Parts are closed one by one, so moving text between parts changes the key.
    assert values(spark, keys.surrogate_key(F.lit("ab"), F.lit("c"))) != values(
        spark, keys.surrogate_key(F.lit("a"), F.lit("bc")))
    assert values(spark, keys.date_key(F.col("d")), d=date(2024, 3, 9)) == 20240309
    assert values(spark, keys.month_of_key(F.lit(20240309))) == 202403
    assert values(spark, keys.month_of_key(F.lit(-1))) == 0
    assert len(values(spark, keys.attribute_hash(F.lit("x")))) == 64


def test_calendar_conventions(spark):
    for day, week in {date(2023, 1, 1): 1, date(2023, 1, 8): 2, date(2024, 12, 31): 53}.items():
        assert values(spark, dates.week_of_year(F.col("d")), d=day) == week
    a, b = datetime(2024, 1, 1, 10, 0, 59), datetime(2024, 1, 1, 10, 1, 1)
    assert values(spark, dates.minutes_between(F.lit(a), F.lit(b))) == 1


def test_date_repairs(spark):
    def repaired(order, ship, invoice, swap=True):
        args = [F.lit(x).cast("date") for x in (order, ship, invoice)]
        return values(spark, repair.repair_order_date(*args, swap))
    d = date
    assert repaired(d(2024, 1, 1), d(2024, 1, 5), d(2024, 1, 2)) == d(2024, 1, 1)
    assert repaired(d(2024, 9, 3), d(2024, 3, 20), d(2024, 3, 1)) == d(2024, 3, 9)  # day and month exchanged
    assert repaired(d(2024, 9, 3), d(2024, 3, 20), d(2024, 3, 1), swap=False) == d(2024, 3, 1)
    assert repaired(d(2024, 9, 25), d(2024, 3, 20), d(2024, 3, 1)) == d(2024, 3, 1)  # no such month
    assert repaired(None, d(2024, 3, 20), d(2024, 3, 1)) == d(2024, 3, 1)
    assert repaired(None, d(2024, 3, 20), None) == d(2024, 3, 20)
    assert repaired(d(2024, 9, 25), d(2024, 3, 20), None) == d(2024, 3, 20)


def test_amount_repairs(spark):
    null = F.lit(None).cast("double")
    assert values(spark, repair.repair_quantity(F.lit(None).cast("int"), F.lit(25.0), F.lit(10.0))) == 3
    assert values(spark, repair.repair_quantity(F.lit(None).cast("int"), F.lit(25.0), F.lit(0.0))) is None
    assert values(spark, repair.repair_discount(null, F.lit(200.0), null)) == 0.0
    assert values(spark, repair.repair_rate(null, F.lit(5.0), F.lit(0.0))) is None
    assert values(spark, repair.repair_unit_cost(F.lit(500.0), F.lit(2), F.lit(10.0))) == 5.0
    assert values(spark, repair.repair_unit_cost(F.lit(5.0), F.lit(2), F.lit(10.0))) == 5.0
    money = lambda x: F.lit(x).cast("decimal(19,4)")
    assert values(spark, repair.amount_mismatch(money("1.01"), money("1.00"))) is False
    assert values(spark, repair.amount_mismatch(money("1.0101"), money("1.00"))) is True
    assert values(spark, repair.unit_margin(money("0"), money("1"))) is None
