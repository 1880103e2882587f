from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lexiflow.functions.sets import OVERLAP_RATIO, Threshold, prefix_length
from lexiflow.functions.text import first_letter, tokenize


def _tok(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "value string")
    return df.select(tokenize("value", **kw).alias("t")).first()["t"]


@pytest.mark.parametrize("text,expected", [
    ("", [""]),
    ("   ", []),
    ("  lead dog, ", ["", "lead", "dog,"]),
    ("cat cat dog", ["cat", "cat", "dog"]),
    ("a\tb  c", ["a", "b", "c"]),
])
def test_raw_tokens_keep_empty(spark, text, expected):
    assert _tok(spark, text, clean=False, keep_empty=True) == expected


@pytest.mark.parametrize("text,expected", [
    ("", []),
    ("   ", []),
    ("  lead dog, ", ["lead", "dog,"]),
])
def test_raw_tokens_drop_empty(spark, text, expected):
    assert _tok(spark, text, clean=False, keep_empty=False) == expected


def test_clean_tokens_ascii_only(spark):
    # accented letters separate tokens; digits are kept; case is kept
    assert _tok(spark, "Éte déjà-vu x2 O'Neil") == ["te", "d", "j", "vu", "x2", "O", "Neil"]
    assert _tok(spark, "The THE the", lower=True) == ["the", "the", "the"]


def test_clean_keep_empty_matches_split_of_cleaned_line(spark):
    # "-a b" cleans to " a b": a leading empty token like the reference's split
    assert _tok(spark, "-a b", clean=True, keep_empty=True) == ["", "a", "b"]


def test_first_letter(spark):
    df = spark.createDataFrame([("Apple",), ("",), ("écu",)], "w string")
    assert [r[0] for r in df.select(first_letter("w")).collect()] == ["a", "", "é"]


@pytest.mark.parametrize("d,t,expected", [
    (5, "4/5", 2), (4, "4/5", 1), (1, "4/5", 1), (2, "1/4", 2), (100, "7/100", 94),
    (10, "1", 1),
])
def test_prefix_length(spark, d, t, expected):
    th = Threshold.of(t)
    df = spark.createDataFrame([(d,)], "size int")
    assert df.select(prefix_length(F.col("size"), th.num, th.den)).first()[0] == expected


def test_threshold_bounds():
    th = Threshold.of("1/4", measure=OVERLAP_RATIO)
    assert th.strict and th.jaccard_bound() == (1, 3)
    assert Threshold.of(0.8).jaccard_bound() == (4, 5)
    assert Threshold.of(Fraction(1, 2)).strict is False
    with pytest.raises(ValueError):
        Threshold.of("1/2", measure=OVERLAP_RATIO)


def test_pair_count_exact_and_overflow_safe(spark):
    from lexiflow.functions.sets import pair_count, pair_ratio
    ns = [0, 1, 2, 3, 10, 9288, 3_037_000_499, 4_294_967_296, 6_000_000_000]
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    got = [r[0] for r in df.select(pair_count(F.col("n"))).collect()]
    exp = [n * (n - 1) // 2 if n * (n - 1) // 2 < 2**63 else None for n in ns]
    assert got == exp
    ratio = df.select(pair_ratio(F.lit(7).cast("long"), F.col("n"))).collect()
    assert ratio[0][0] is None and ratio[1][0] is None and ratio[2][0] == 7.0
    assert ratio[-1][0] == pytest.approx(7 / (6e9 * (6e9 - 1) / 2))


def test_lines_are_found_in_one_regex_pass(spark):
    from lexiflow.functions.text import LINE_SEPARATOR, split_lines
    texts = ["", "a", "\n", "\r", "\r\n", "\n\r", "a\n", "\na", "\r\na\r\n", "a\r\rb\n\nc\r\n\r\n", " x\u0085\u2028y\x0b\x0c\r", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(split_lines("text").alias("got"), F.split("text", LINE_SEPARATOR, -1).alias("want"))
    assert all(r.got == r.want for r in got.collect())
    assert " split(" not in df.select(split_lines("text"))._jdf.queryExecution().analyzed().toString()
