"""Every column function against values worked out by hand."""

from __future__ import annotations

import datetime
import zlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starlode import functions as fn

D = "NÃO"


def apply(spark, make, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, c {kind}").select("i", make("c").alias("r"))
    return [row["r"] for row in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    ("make", "given", "expected"),
    [
        (fn.trim_upper, [" aé ", "\ta ", "", "  ", None, "ß"], ["AÉ", "\tA", "", "", None, "SS"]),
        (fn.trim_lower, [" A@X.COM ", None], ["a@x.com", None]),
        (lambda c: fn.null_to_upper(c, D), [None, "", "  ", " a"], [D, "", "", "A"]),
        (lambda c: fn.blank_to(c, D), [None, "", "  ", " a"], [None, D, D, "A"]),
        (lambda c: fn.empty_to(c, D), [None, "", "  ", " a"], [D, D, "  ", " a"]),
        (lambda c: fn.empty_to_upper(c, D), [None, "", "  ", " a"], [D, D, "", "A"]),
        (lambda c: fn.empty_list_to(c, D), [None, "", "[]", '["a"]', " "], [D, D, D, '["a"]', " "]),
        (fn.digits_only, ["(11) 9-8a", "", "abc", None], ["1198", "", "", None]),
        (
            fn.state_code,
            ["Campinas SP 1", "SE de RJ", "sp", "XSP", "SP-RJ", None, ""],
            ["SP", "SE", "", "", "SP", None, ""],
        ),
        (
            fn.postal_code,
            ["CEP: 01310-100", "CEP 1", "x", None, "CEP123456789", "CEP 1\n2", "a CEP 1 CEP 2", "cep 5"],
            ["01310100", "00000001", "00000000", None, "12345678", "00000001", "00000012", "00000000"],
        ),
        (
            fn.platform_label,
            ["1", "2", "3", "4", "web", None, " 1"],
            ["WEB", "ANDROID", "IOS", *["DESCONHECIDA"] * 3, "WEB"],
        ),
        (fn.deletion_label, ["2024", None], ["Inativo", "Ativo"]),
        (lambda c: fn.deletion_label(c, "Ativa", "Inativa"), ["2024", None], ["Inativa", "Ativa"]),
        (fn.surrogate_key, ["123456789", "", None], [zlib.crc32(b"123456789"), 0, None]),
    ],
)
def test_text_functions(spark, make, given, expected):
    assert apply(spark, make, given) == expected


def test_status_labels(spark):
    labels = apply(spark, fn.status_label, [0, 1, 2, 3, 4, 5, 6, 7, None], "int")
    assert labels == [
        "DESCONHECIDO", "NÃO INICIADO", "EM ANDAMENTO", "EM ANÁLISE", "REPROVADO", "REABERTO",
        "CONCLUÍDO", "DESCONHECIDO", "DESCONHECIDO",
    ]


def test_flag_label(spark):
    assert apply(spark, fn.yes_no, [True, False, None], "boolean") == ["SIM", "NÃO", "NÃO"]


def test_zero_fill_keeps_the_kind(spark):
    assert apply(spark, fn.zero_fill, [1, None], "int") == [1, 0]
    assert apply(spark, fn.zero_fill, [1.5, None], "double") == [1.5, 0.0]
    df = spark.createDataFrame([(Decimal("1.50"),), (None,)], "c decimal(10,2)")
    filled = df.select(fn.zero_fill("c").alias("c"))
    assert filled.schema["c"].dataType.simpleString() == "decimal(12,2)"
    assert [r["c"] for r in filled.collect()] == [Decimal("1.50"), Decimal("0.00")]


def test_state_falls_back_to_the_address(spark):
    df = spark.createDataFrame([("BA", "x SP"), (None, "x SP"), (None, "x"), ("", "x SP")], "s string, a string")
    got = [r[0] for r in df.select(fn.state_or_extracted("s", "a")).collect()]
    assert got == ["BA", "SP", "", ""]


def test_postal_code_can_prefer_its_own_column(spark):
    df = spark.createDataFrame([("01310-100", "CEP 2"), ("", "CEP 2"), (None, "CEP 2")], "z string, a string")
    got = [r[0] for r in df.select(fn.postal_code("a", "z")).collect()]
    assert got == ["01310100", "00000002", "00000002"]


def test_surrogate_key_of_a_number_hashes_its_text(spark):
    assert apply(spark, fn.surrogate_key, [42, None], "long") == [zlib.crc32(b"42"), None]


def test_wide_surrogate_key(spark):
    wide = apply(spark, lambda c: fn.surrogate_key(c, "xxhash64"), [1, 2, None], "long")
    assert wide[2] is None and wide[0] != wide[1]
    with pytest.raises(ValueError, match="unknown surrogate key"):
        fn.surrogate_key("c", "md5")


def test_wall_clock_shifts_by_the_zone(spark):
    df = spark.sql("SELECT timestamp'2024-06-01 12:00:00' AS t")
    shifted = df.select(fn.local_wall_clock("t").cast("timestamp_ntz").alias("t")).first()["t"]
    assert shifted == datetime.datetime(2024, 6, 1, 9)


def test_load_clock_is_one_value_per_query(spark):
    stamped = spark.range(0, 1000, 1, 8).select(fn.load_clock().alias("t"))
    assert stamped.distinct().count() == 1


def test_ansi_casts(spark):
    ok = spark.sql("SELECT cast('1.005' AS decimal(10,2)) AS d, cast('true' AS boolean) AS b").first()
    assert (ok["d"], ok["b"]) == (Decimal("1.01"), True)
    for bad in ("cast('' AS int)", "cast('3.0' AS int)", "cast('x' AS timestamp)"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.range(1).select(F.expr(bad)).collect()
