from lexiflow.operators import preprocess
from tests.conftest import rows


def _lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, start=1)), "line_id long, value string")


def test_order_rarest_first_ties_by_word(spark):
    # counts: b=1, a=2, c=2, d=3 ; line 1 tokens {a, b, c, d}
    lines = _lines(spark, ["a b c d", "a c d", "d"])
    out = preprocess.preprocess(lines, stop_threshold=100)
    got = {r.line_id: list(r.tokens) for r in out.collect()}
    assert got[1] == ["b", "a", "c", "d"]
    assert got[3] == ["d"]


def test_collapse_ties_keeps_greatest_word(spark):
    lines = _lines(spark, ["a b c d", "a c d", "d"])
    out = preprocess.preprocess(lines, stop_threshold=100, collapse_ties=True)
    got = {r.line_id: list(r.tokens) for r in out.collect()}
    assert got[1] == ["b", "c", "d"]


def test_stop_words_case_sensitive_and_empty_lines(spark):
    # "this" occurs 3 times (> 2) and is a stop word; "This" survives
    lines = _lines(spark, ["this This cat", "this", "this dog", "", "   ", "!!"])
    out = preprocess.preprocess(lines, stop_threshold=2)
    got = {r.line_id: sorted(r.tokens) for r in out.collect()}
    assert got == {1: ["This", "cat"], 3: ["dog"]}


def test_duplicates_within_line_kept_once(spark):
    out = preprocess.preprocess(_lines(spark, ["x x y x"]), stop_threshold=100)
    r = out.first()
    assert sorted(r.tokens) == ["x", "y"] and r.size == 2


def test_document_count(spark):
    out = preprocess.preprocess(_lines(spark, ["a", "", "b c"]), stop_threshold=100)
    assert preprocess.document_count(out).first().n_documents == 2


def test_external_frequencies_unknown_word_ranks_first(spark):
    freq = spark.createDataFrame([("a", 5), ("b", 1)], "word string, n long")
    stop = spark.createDataFrame([("z",)], "word string")
    out = preprocess.preprocess(_lines(spark, ["a b q z"]), frequencies=freq, stop=stop)
    assert list(out.first().tokens) == ["q", "b", "a"]


def test_broadcast_and_shuffle_plans_agree(spark):
    lines = _lines(spark, ["a b c d", "a c d", "d", "b e e", "the the a", "x the"])
    small = preprocess.preprocess(lines, stop_threshold=2)
    big = preprocess.preprocess(lines, stop_threshold=2, max_broadcast_bytes=0,
                                max_broadcast_rows=0)
    key = lambda df: sorted((r.line_id, tuple(r.tokens)) for r in df.collect())
    assert key(small) == key(big)


def test_empty_lines_table(spark):
    out = preprocess.preprocess(_lines(spark, ["", "  ", "!!"]), stop_threshold=2)
    assert out.count() == 0


def _plan_limits():
    """Keyword arguments that force the broadcast branch and the shuffle branch."""
    return [{}, {"max_broadcast_bytes": 0, "max_broadcast_rows": 0}]


def test_given_stop_list_removes_only_the_words_it_names(spark):
    lines = _lines(spark, [f"common w{i}" for i in range(7)] + ["zzz w1"])
    stop = spark.createDataFrame([("zzz",)], "word string")
    for limits in _plan_limits():
        out = preprocess.preprocess(lines, stop_threshold=3, stop=stop, **limits)
        got = {r.line_id: list(r.tokens) for r in out.collect()}
        # "common" is counted above the threshold but not listed
        assert got == {**{i + 1: [f"w{i}", "common"] for i in range(7)}, 8: ["w1"]}


def test_repeated_frequency_rows_count_once(spark):
    lines = _lines(spark, ["a b", "b"])
    freq = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "word string, n long")
    for limits in _plan_limits():
        out = preprocess.preprocess(lines, frequencies=freq, stop=freq.limit(0).select("word"), **limits)
        assert {r.line_id: (list(r.tokens), r["size"]) for r in out.collect()} == {
            1: (["b", "a"], 2), 2: (["b"], 1)}


def test_wide_line_ids_of_a_huge_text_and_a_long_id(spark):
    from lexiflow.functions.sets import Threshold
    from lexiflow.operators.similarity import similarity_join
    from lexiflow.sources.lines import lines_from_documents

    text = "\n" * 1_000_000 + "alpha beta gamma"
    docs = spark.createDataFrame([(9_300_000_000_001, text), (7, "alpha beta gamma")], "doc_id long, text string")
    lines = lines_from_documents(docs, wide=True)
    assert lines.where("line_no = 1000001").count() == 1
    out = preprocess.preprocess(lines.select("line_id", "value"), stop_threshold=10)
    pairs = similarity_join(out.withColumnRenamed("line_id", "doc_id"), Threshold.of("4/5")).collect()
    assert [(int(r.doc_a), int(r.doc_b)) for r in pairs] == [
        (7 * 10 ** 12 + 1, 9_300_000_000_001 * 10 ** 12 + 1_000_001)]


def test_ranked_documents_spell_the_same_words(spark, sf_small):
    from lexiflow.operators.preprocess import preprocess_ranked
    from lexiflow.sources.tables import document_lines
    lines = document_lines(spark, sf_small).select("line_id", "value")
    want = {r.line_id: r.tokens for r in preprocess.preprocess(lines, stop_threshold=50).collect()}
    for limit in (1 << 25, 0):  # broadcast and shuffled dictionary
        docs, dictionary = preprocess_ranked(lines, stop_threshold=50, max_broadcast_bytes=limit)
        words = {r["rank"]: r for r in dictionary.collect()}
        assert sorted(words) == list(range(len(words)))
        order = [(words[i].n, words[i].word) for i in sorted(words)]
        assert order == sorted(order) and order[-1][0] <= 50
        got = docs.collect()
        assert {r.line_id: [words[t].word for t in r.tokens] for r in got} == want
        assert all(r.size == len(r.tokens) for r in got)
    empty, none = preprocess_ranked(lines.limit(0))
    assert empty.count() == 0 and none.count() == 0


def test_shuffled_dictionary_sorts_no_words(spark):
    from lexiflow.operators.preprocess import preprocess_ranked
    lines = spark.createDataFrame([(1, "b a a"), (2, "c b"), (None, "b b")], "line_id long, value string")
    docs, _ = preprocess_ranked(lines, max_broadcast_bytes=0)
    plan = docs._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.line_id: list(r.tokens) for r in docs.collect()} == {1: [1, 2], 2: [0, 2], None: [2]}
