import pytest

from lexiflow.operators import counts
from tests.conftest import rows


def test_word_count_worked_example(spark):
    lines = spark.createDataFrame([("cat cat dog",)], "value string")
    out = counts.count_words(lines, clean=False)
    assert rows(out) == [("cat", 2), ("dog", 1)]


def test_empty_word_is_counted_with_keep_empty(spark):
    lines = spark.createDataFrame([("",), (" a",), ("   ",), ("a ",)], "value string")
    out = counts.count_words(lines, clean=False, keep_empty=True)
    assert rows(out) == [("", 2), ("a", 2)]


def test_first_letter_total_equals_token_total(spark):
    lines = spark.createDataFrame([("Alpha beta  Gamma",), ("",), (" apple Zed",)], "value string")
    words = counts.explode_tokens(lines, clean=False, keep_empty=True)
    letters = counts.first_letter_count(words)
    assert rows(letters) == [("", 2), ("a", 2), ("b", 1), ("g", 1), ("z", 1)]
    assert sum(n for _, n in rows(letters)) == words.count()


def test_stop_words_strictly_above_threshold(spark):
    lines = spark.createDataFrame([("a a a b b c",)], "value string")
    wc = counts.count_words(lines)
    assert rows(counts.stop_words(wc, 2)) == [("a", 3)]
    assert rows(counts.stop_words(wc, 3)) == []


def test_top_words_ties_by_word(spark):
    lines = spark.createDataFrame([("b a c b a d",)], "value string")
    top = counts.top_words(counts.count_words(lines), 3).collect()
    assert [(r.word, r.n) for r in top] == [("a", 2), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("buckets", [1, 7, 1 << 18])
def test_frequent_words_equal_plain_counts(spark, buckets):
    rows = [(f"w{i % 97}",) for i in range(2000)] + [("hot",)] * 500 + [("",)] * 30 + [(None,)] * 25
    words = spark.createDataFrame(rows, "word string").repartition(5)
    for threshold in (0, 20, 21, 499, 500):
        want = {(r.word, r.n) for r in counts.stop_words(counts.word_count(words), threshold).collect()}
        got = [(r.word, r.n) for r in counts.frequent_words(words, threshold, buckets=buckets).collect()]
        assert set(got) == want and len(got) == len(want)
    assert counts.frequent_words(words.limit(0), 1).count() == 0
