"""Expressions against literals and, text by text, against DuckDB."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import apply, texts
from stocktake.functions import numbers, text, times

AWKWARD = [
    None, "", " ", "   ", "\t", "0", "-0", "7", "07", "00123456", " 123456 ", "123.456", "12.5", "-12.5", "12.49",
    "0.4999999999", "+5", "--5", "5-", "1e3", "1E3", "1e-3", "12e-1", "1e400", "x", "12x", "1 2", " 42 ",
    "　42", "2147483647", "2147483648", "-2147483648", "99999999999999999999", "9223372036854775807",
    "9223372036854775808", "1.234,56", "1234,5", "1234.56", "1.234.567,89", "1,2,3", ",5", "5,", ".5", "5.", "R$ 5,00",
    "999999999999,99", "9999999999999,99", "0,005", "0,004", "-0,005", "1.005", "NaN", "inf", "null", "\n8\n", "8\t",
]


def duck(expression: str, values) -> list:
    con = duckdb.connect()
    con.execute("CREATE TABLE v (id int, t varchar)")
    con.executemany("INSERT INTO v VALUES (?, ?)", [[i, v] for i, v in enumerate(values)])
    return [r[0] for r in con.sql(f"SELECT {expression} FROM v ORDER BY id").fetchall()]


@pytest.mark.parametrize(
    ("ours", "theirs"),
    [
        (numbers.safe_int, "try_cast(trim(t) AS integer)"),
        (lambda c: numbers.safe_int(c, any_blanks=False), "try_cast(t AS integer)"),
        (numbers.digits_key, "try_cast(regexp_replace(t, '[^0-9]', '', 'g') AS bigint)"),
        (
            numbers.mixed_decimal,
            "try_cast(trim(if(contains(t, ','), replace(replace(t, '.', ''), ',', '.'), t)) AS decimal(14,2))",
        ),
    ],
    ids=["safe_int", "untrimmed_int", "digits_key", "mixed_decimal"],
)
def test_numbers_agree_with_duckdb(spark, ours, theirs):
    expected = duck(theirs, AWKWARD)
    assert dict(zip(AWKWARD, apply(spark, AWKWARD, ours))) == dict(zip(AWKWARD, expected))


def test_number_examples(spark):
    assert apply(spark, ["12.5", "-12.5", "1e3", "abc", ""], numbers.safe_int) == [13, -13, 1000, None, None]
    five = ["123456", "00123456", "123.456", " 123456 ", ""]
    assert apply(spark, five, numbers.digits_key) == [123456, 123456, 123456, 123456, None]
    assert apply(spark, ["1.234,56", "1234.56", "x"], numbers.mixed_decimal) == [
        Decimal("1234.56"), Decimal("1234.56"), None,
    ]


MOMENTS = [
    None, "", "2026-08-05T14:03:00", "2026-08-05 14:03:00", "2026-08-05 14:03", "2026-08-05", "2026-8-5", " 2026-08-05",
    "2026/08/05", "05/08/2026 14:03", "5/8/2026 4:03", " 05/08/2026 14:03 ", "05/08/2026", "31/02/2026 10:00",
    "2026-02-31", "2026-13-01", "2026", "2026-08", "hoje", "2026-08-05T14:03:00Z", "2026-08-05 14:03:59.123456",
    "05/08/2026 14:03:00", "05-08-2026", "\t05/08/2026 14:03\n", "05/08/2026   14:03", "\u00a005/08/2026 14:03",
    "2026-08-05  10:00", "2026-08-05T 10:00", "\t2026-08-05 10:00", "2026-08-05 10:00 ", "2026-08-05 ", "\t05/08/2026", "05/08/2026 25:00", "0005-08-05",
]


def test_timestamps_agree_with_duckdb(spark):
    expected = duck("coalesce(try_cast(t AS timestamp), try_strptime(t, '%d/%m/%Y %H:%M'))", MOMENTS)
    assert dict(zip(MOMENTS, apply(spark, MOMENTS, times.flexible_timestamp))) == dict(zip(MOMENTS, expected))


def test_dates_agree_with_duckdb(spark):
    expected = duck(
        "coalesce(CAST(try_cast(t AS timestamp) AS date), CAST(try_strptime(trim(t), '%d/%m/%Y') AS date))", MOMENTS
    )
    assert dict(zip(MOMENTS, apply(spark, MOMENTS, times.flexible_date))) == dict(zip(MOMENTS, expected))


def test_time_examples(spark):
    both = ["2026-02-10 00:00:00", "03/03/2026", "3/3/2026", "31/02/2026"]
    assert apply(spark, both, times.flexible_date) == [date(2026, 2, 10), date(2026, 3, 3), date(2026, 3, 3), None]
    read = ["2026-08-05T14:03:00", "05/08/2026 14:03"]
    assert apply(spark, read, times.flexible_timestamp) == [datetime(2026, 8, 5, 14, 3)] * 2
    typed = texts(spark, read).select(times.flexible_timestamp(F.col("t")).alias("r"))
    assert dict(typed.dtypes)["r"] == "timestamp_ntz"


WORDS = [
    None, "", "  ", "TRÊS   LAGOAS do sul", " dourados", "COMARCA DE  Rio   Brilhante", "d'água e óleo", "a\tb\nc",
    "são  josé DOS campos", "ßmall Straße", "ΟΔΟΣ Σ", "İstanbul", "e", "E DA", " Ponta Porã　",
    "x\u000by", "água-CLARA", "1º OFÍCIO das Varas",
]


@pytest.mark.parametrize(
    ("ours", "theirs"),
    [
        (text.strip, "trim(t)"),
        (text.squeeze, r"trim(regexp_replace(t, '\s+', ' ', 'g'))"),
        (lambda c: text.blank_to_null(text.strip(c)), "nullif(trim(t), '')"),
        (text.normal_upper, "upper(trim(t))"),
        (text.normal_lower, "lower(trim(t))"),
        (lambda c: text.token_or(c, "none"), "coalesce(nullif(lower(trim(t)), ''), 'none')"),
        (lambda c: text.drop_leading_words(c, "comarca", "de"), r"regexp_replace(t, '^\s*comarca\s+de\s+', '', 'i')"),
        (
            lambda c: text.label_by_prefix(c, {"com": "C", "d": "D"}),
            "CASE WHEN starts_with(lower(trim(t)), 'com') THEN 'C' WHEN starts_with(lower(trim(t)), 'd') THEN 'D' END",
        ),
    ],
    ids=["strip", "squeeze", "blank", "upper", "lower", "token", "prefix", "label"],
)
def test_text_agrees_with_duckdb(spark, ours, theirs):
    assert dict(zip(WORDS, apply(spark, WORDS, ours))) == dict(zip(WORDS, duck(theirs, WORDS)))


def test_proper_names(spark):
    expected = {
        "CAMPO  GRANDE": "Campo Grande",
        " três lagoas ": "Três Lagoas",
        "RIO DE JANEIRO E DAS OSTRAS": "Rio de Janeiro e das Ostras",
        "de": "de",
        "dos anjos": "dos Anjos",
        "éden\tdo sul": "Éden do Sul",
        "x": "X",
        "": "",
        None: None,
    }
    assert apply(spark, list(expected), text.proper_name) == list(expected.values())


def test_area_type_spellings(spark):
    kinds = ["Judicial", "JUDICIAL", "judicial ", "Adm.", "ADMINISTRATIVA", "outro", None]
    labels = {"jud": "Judicial", "adm": "Administrativa"}
    assert apply(spark, kinds, lambda c: text.label_by_prefix(c, labels)) == [*["Judicial"] * 3, *["Administrativa"] * 2, None, None]


@settings(max_examples=8, deadline=None, derandomize=True, database=None)
@given(st.lists(st.text(alphabet="0123456789.,-+ eEx ", max_size=14), min_size=40, max_size=40))
def test_random_numbers_agree_with_duckdb(spark, values):
    assert apply(spark, values, numbers.digits_key) == duck(
        "try_cast(regexp_replace(t, '[^0-9]', '', 'g') AS bigint)", values
    )
    assert apply(spark, values, numbers.mixed_decimal) == duck(
        "try_cast(trim(if(contains(t, ','), replace(replace(t, '.', ''), ',', '.'), t)) AS decimal(14,2))", values
    )
    assert apply(spark, values, numbers.safe_int) == duck("try_cast(trim(t) AS integer)", values)
