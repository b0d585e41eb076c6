import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import scalars as S

PAIRS = [("000102030405060708090A0B0C0D0E0F", "0c0d0e0f-0a0b-0809-0001-020304050607"), ("FFEEDDCCBBAA99887766554433221100", "33221100-5544-7766-ffee-ddccbbaa9988")]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("raw,guid", PAIRS)
def test_uuid_pairs(spark, raw, guid):
    assert one(spark, S.binary_to_uuid(F.unhex(F.lit(raw)))) == guid
    assert one(spark, F.hex(S.uuid_to_binary(F.lit(guid)))) == raw


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(min_size=0, max_size=17), min_size=1, max_size=50))
def test_uuid_round_trip(spark, values):
    df = spark.createDataFrame([(bytearray(v),) for v in values], "b binary")
    for row in df.select("b", S.uuid_to_binary(S.binary_to_uuid(F.col("b"))).alias("r")).collect():
        assert row.r == (row.b if len(row.b) == 16 else None)


def test_fix_year(spark):
    leap = F.lit("4024-02-29 10:00:00").cast("timestamp")
    assert one(spark, S.fix_year(leap)) == datetime.datetime(2024, 2, 29, 10)
    assert one(spark, S.fix_year(leap, offset=1999)) == datetime.datetime(2025, 3, 1, 10)
    assert one(spark, S.fix_year_text(F.lit("4024-05-01"))) == "2024-05-01"
    assert one(spark, S.fix_year_text(F.lit("soon"))) == "soon"


def test_casts(spark):
    assert one(spark, S.to_int(F.lit("3.9"))) is None
    assert one(spark, S.to_int(F.lit(" 12 "))) == 12
    assert float(one(spark, S.to_decimal(F.lit("0.125")))) == 0.12
    assert one(spark, S.to_bool(F.lit("Да"))) is True
    assert one(spark, S.to_bool(F.lit("?"))) is None
    assert one(spark, S.typed(F.lit("x"), "bigint")) == 0


def test_binaries(spark):
    assert one(spark, S.binary_to_int(F.unhex(F.lit("000001DC")))) == 476
    assert one(spark, S.binary_to_int(F.unhex(F.lit("DC010000")), little=True)) == 476
    assert one(spark, S.binary_to_bool(F.unhex(F.lit("01")))) is True
    assert one(spark, S.binary_to_bool(F.unhex(F.lit("0101")))) is None


def test_money(spark):
    args = dict(cost=F.lit(100.0), vat=F.lit(12.0), full=F.lit(112.0), used=F.lit(5.0), bonus=F.lit(1.0), flag=F.lit(True), sign=F.lit(1))
    day = lambda d: F.lit(d).cast("timestamp")
    assert one(spark, S.sales_without_vat(period=day("2022-10-11"), **args)) == 88.0
    assert one(spark, S.sales_without_vat(period=day("2022-10-12"), **args)) == 93.0
    assert one(spark, S.ratio(F.lit(1.0), F.lit(0.0))) == 0.0
    words = ("eturn", "ale", "ill")
    assert [one(spark, S.doc_sign(F.lit(k), F.lit(o), words)) for k, o in (("Return of goods", ""), ("Sale", ""), ("Till", "return"), ("Till", "sale"), ("Move", ""), (None, None))] == [-1, 1, -1, 1, 0, 0]
    assert [one(spark, S.doc_sign(F.lit(k), F.lit(o))) for k, o in (("ВозвратТоваров", ""), ("РеализацияТоваров", ""), ("ЧекККМ", "Возврат"), ("ЧекККМ", "other"), ("ЧекККМ", None), ("Move", "Возврат"))] == [-1, 1, -1, 1, 1, 0]


def test_text(spark):
    assert one(spark, S.tidy(F.lit(" a  b  c "))) == "a b c"
    assert one(spark, S.checkpoint_field(F.lit("watermark_from=a; to=b; changes=3"), "changes")) == "3"
    assert one(spark, S.set_ref(F.lit('{"a":"1","b":"2"}'), "a", F.lit(None).cast("string"))) == '{"b":"2"}'
    assert one(spark, S.is_complete([F.lit(" "), F.lit("x")])) is True
    assert one(spark, S.is_complete([])) is True
    assert one(spark, S.lookup(F.lit(5), {"4": "four"})) == "5"
