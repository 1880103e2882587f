import random

import pytest
from pyspark.sql import functions as F

from lexiflow.functions.render import join_docs, join_tf_postings
from lexiflow.operators import counts, index
from tests.conftest import rows


def _tagged(spark, docs):
    df = spark.createDataFrame(docs, "doc string, value string")
    return counts.explode_tokens(df, "value", clean=True, lower=True, keep=("doc",))


def test_tf_postings_worked_example(spark):
    words = _tagged(spark, [("doc1.txt", "this is is a"), ("doc2.txt", "this is"),
                            ("doc3.txt", "is")])
    idx = index.inverted_index_tf(words).select("word", join_tf_postings(F.col("postings")))
    assert rows(idx) == [("a", "doc1.txt#1"),
                         ("is", "doc1.txt#2, doc2.txt#1, doc3.txt#1"),
                         ("this", "doc1.txt#1, doc2.txt#1")]


def test_index_stop_list_join_equals_having(spark):
    words = _tagged(spark, [("d1", "The cat and THE dog"), ("d2", "the bird and a cat"),
                            ("d3", "a cat")])
    stop = counts.stop_words(counts.word_count(words), 2).select("word")
    by_join = index.inverted_index(words, stop=stop).select("word", "n_docs",
                                                            join_docs(F.col("docs")))
    by_having = index.inverted_index(words, max_count=2).select("word", "n_docs",
                                                               join_docs(F.col("docs")))
    assert rows(by_join) == rows(by_having)
    assert ("the",) not in [(w,) for w, *_ in rows(by_join)]
    assert ("a", 2, "d2, d3") in rows(by_join)


def test_single_document_words_and_stats(spark):
    words = _tagged(spark, [("d1", "x y z"), ("d2", "y z"), ("d3", "z w")])
    assert rows(index.single_document_words(words)) == [("w", "d3"), ("x", "d1")]
    stats = index.vocabulary_stats(words).first()
    assert (stats.unique_words, stats.single_document_words) == (4, 2)


def test_case_insensitive_stop_removal(spark):
    words = spark.createDataFrame([("The",), ("cat",)], "word string")
    stop = spark.createDataFrame([("the",)], "word string")
    assert rows(index.remove_stop_words(words, stop, case_insensitive=True)) == [("cat",)]
    assert rows(index.remove_stop_words(words, stop)) == [("The",), ("cat",)]


def test_render_postings_by_schema(spark):
    words = _tagged(spark, [("d1", "x y"), ("d2", "y")])
    a = index.render_postings(index.inverted_index(words)).select("word", "docs")
    b = index.render_postings(index.inverted_index_tf(words))
    assert rows(a) == [("x", "d1"), ("y", "d1, d2")]
    assert rows(b) == [("x", "d1#1"), ("y", "d1#1, d2#1")]


def test_stop_list_of_any_case(spark):
    words = _tagged(spark, [("d1", "The cat"), ("d2", "the dog")])
    stop = spark.createDataFrame([("The",), ("DOG",)], "word string")
    assert rows(index.inverted_index(words, stop=stop).select("word")) == [("cat",)]
    assert rows(index.inverted_index_tf(words, stop=stop).select("word")) == [("cat",)]


def test_nothing_is_cut_by_default(spark):
    tagged = spark.range(5000).selectExpr("cast(id AS string) AS doc", "'the' AS word")
    assert [r.n_docs for r in index.inverted_index(tagged).collect()] == [5000]


def test_frequent_word_goes_before_the_collect(spark):
    tagged = spark.range(100_000).selectExpr("id AS doc", "'hot' AS word").unionByName(
        spark.range(10).selectExpr("id AS doc", "'cold' AS word"))
    idx = index.inverted_index(tagged, max_count=10)
    assert rows(idx.select("word", "n_docs")) == [("cold", 10)]
    plan = idx._jdf.queryExecution().optimizedPlan().toString()
    # the anti join stands below the aggregate that collects
    assert plan.index("collect_list") < plan.index("LeftAnti")


def test_posting_blocks_are_bounded_and_complete(spark):
    tagged = spark.range(1000).selectExpr("id AS doc", "'hot' AS word").unionByName(
        spark.createDataFrame([(5, "rare"), (999, "rare")], "doc long, word string"))
    got = index.posting_blocks(tagged, width=64).collect()
    assert max(r.n_docs for r in got) <= 64
    assert sorted(d for r in got if r.word == "hot" for d in r.docs) == list(range(1000))
    assert [(r.block, list(r.docs)) for r in got if r.word == "rare"] in ([(0, [5]), (15, [999])],
                                                                         [(15, [999]), (0, [5])])


def test_posting_blocks_of_names_and_frequencies(spark):
    rows = [(f"d{i % 7}", w) for i in range(60) for w in ("hot", f"w{i % 5}")] + [(None, "hot"), ("é", "hot")]
    tagged = spark.createDataFrame(rows, "doc string, word string")
    want = {}
    for d, w in rows:
        want.setdefault(w, {}).setdefault(d, 0)
        want[w][d] += 1
    names = sorted({d for d, _ in rows}, key=lambda d: (d is not None, (d or "").encode()))
    got = index.posting_blocks(tagged, width=3, tf=True).collect()
    seen = {}
    for r in got:
        assert r.n_docs == len(r.postings) <= 3
        assert all(names.index(p.doc) // 3 == r.block for p in r.postings)
        seen.setdefault(r.word, {}).update({p.doc: p.tf for p in r.postings})
    assert seen == want
    plain = index.posting_blocks(tagged, width=3).collect()
    assert {(r.word, r.block, r.n_docs) for r in plain} == {(r.word, r.block, r.n_docs) for r in got}


def test_posting_blocks_of_extreme_ids_and_refused_types(spark):
    ids = [2**62 + 1, 2**62 + 2, 2**53 + 1, 0, -1, -4, -5, -2**63, 2**63 - 1]
    tagged = spark.createDataFrame([(i, "w") for i in ids], "doc long, word string")
    got = {r.block: set(r.docs) for r in index.posting_blocks(tagged, width=4).collect()}
    want = {}
    for i in ids:
        want.setdefault(i // 4, set()).add(i)
    assert got == want
    with pytest.raises(TypeError, match="double"):
        index.posting_blocks(tagged.selectExpr("CAST(doc AS double) AS doc", "word"))


@pytest.mark.parametrize("max_count", [None, 4])
def test_word_spread_equals_counting(spark, max_count):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "é"]), rng.choice([f"w{i}" for i in range(40)])) for _ in range(120)]
    rows += [("a", "only"), ("a", "only"), (None, "none"), (None, "none"), (None, "mixed"), ("a", "mixed")]
    tagged = spark.createDataFrame(rows, "doc string, word string")
    docs, n = {}, {}
    for d, w in rows:
        docs.setdefault(w, set()).add(d)
        n[w] = n.get(w, 0) + 1
    known = {w for w in docs if max_count is None or n[w] <= max_count}
    alone = {(w, next(iter(docs[w]))) for w in known if len(docs[w]) == 1}
    assert {(r.word, r.doc) for r in index.single_document_words(tagged, max_count=max_count).collect()} == alone
    stats = index.vocabulary_stats(tagged, max_count=max_count).first()
    assert tuple(stats) == (len(known), len(alone))
    plan = index.single_document_words(tagged, max_count=max_count)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_stop_list_goes_through_a_bitmap(spark):
    words = [f"Word{i}" for i in range(500)] + [None, "", "WORD7", "é"]
    stop = [f"word{i}" for i in range(0, 500, 3)] + ["", "unseen", None]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, place int")
    listed = spark.createDataFrame([(w,) for w in stop], "word string")
    for insensitive in (True, False):
        got = index.remove_stop_words(df, listed, case_insensitive=insensitive, max_broadcast_rows=0)
        want = index.remove_stop_words(df, listed, case_insensitive=insensitive)
        assert got.columns == want.columns and sorted(got.collect(), key=lambda r: r.place) == \
            sorted(want.collect(), key=lambda r: r.place)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "LeftAnti" in plan and "Union" in plan
    # hardly any unlisted word is shuffled; with one bit per bucket, all are, and none is lost
    sure, doubtful = index.split_by_bitmap(df, F.col("word"), listed, "word")
    assert doubtful.count() < 10 and sure.count() + doubtful.count() == len(words)
    sure, doubtful = index.split_by_bitmap(df, F.lower("word"), listed, "word", bits=8)
    assert sure.count() + doubtful.count() == len(words)
    assert not {(r.word or "x").lower() for r in sure.collect()} & {w for w in stop if w is not None}
