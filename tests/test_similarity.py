import itertools
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexiflow.functions.sets import JACCARD, OVERLAP_RATIO, Threshold
from lexiflow.operators import similarity
from lexiflow.operators.joins import pairs_within_groups

DOC_SCHEMA = "doc_id long, tokens array<string>, size int"


def _docs(spark, sets):
    """Token sets in one global order (by corpus frequency, then token)."""
    freq = {}
    for s in sets.values():
        for t in set(s):
            freq[t] = freq.get(t, 0) + 1
    data = []
    for i, s in sets.items():
        toks = sorted(set(s), key=lambda t: (freq[t], t))
        if toks:
            data.append((i, toks, len(toks)))
    return spark.createDataFrame(data, DOC_SCHEMA)


def _brute(sets, th: Threshold):
    out = {}
    items = sorted((i, set(s)) for i, s in sets.items() if s)
    for (a, sa), (b, sb) in itertools.combinations(items, 2):
        o = len(sa & sb)
        union = len(sa | sb)
        if th.measure == JACCARD:
            v, sim = Fraction(o, union), o / union
        else:
            v, sim = Fraction(o, len(sa) + len(sb)), o / (len(sa) + len(sb))
        t = Fraction(th.num, th.den)
        if (v > t) if th.strict else (v >= t):
            out[(a, b)] = sim
    return out


def _run(spark, sets, th, **kw):
    df = similarity.similarity_join(_docs(spark, sets), th, **kw)
    return {(r.doc_a, r.doc_b): r.similarity for r in df.collect()}


def test_jaccard_worked_example(spark):
    sets = {1: "I have a dog".split(), 2: "I have a cat".split(),
            3: "I have a big dog".split()}
    for method in ("prefix", "overlap"):
        got = _run(spark, sets, Threshold.of("4/5"), method=method)
        assert got == {(1, 3): 0.8}, method  # 4/5 passes: the test is >=


def test_overlap_ratio_identical_and_disjoint(spark):
    sets = {1: ["a", "b"], 2: ["a", "b"], 3: ["c", "d"]}
    got = _run(spark, sets, Threshold.of("1/4", measure=OVERLAP_RATIO))
    assert got == {(1, 2): 0.5}


def test_duplicate_groups_expand_to_all_member_pairs(spark):
    sets = {i: ["x", "y", "z"] for i in range(1, 6)}
    sets.update({10: ["x", "y", "z", "w"], 11: ["q"]})
    th = Threshold.of("3/4")
    assert _run(spark, sets, th, cell_rows=2) == _brute(sets, th)


@pytest.mark.parametrize("measure,t", [(JACCARD, "4/5"), (JACCARD, "1/2"), (JACCARD, "7/100"),
                                       (OVERLAP_RATIO, "1/4")])
def test_prefix_equals_brute_force_random(spark, measure, t):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(30)]
    sets = {}
    for i in range(1, 121):
        base = rng.sample(vocab, rng.randint(1, 9))
        if i > 10 and rng.random() < 0.3:  # near and exact copies
            base = list(sets[rng.randint(1, i - 1)])
            if base and rng.random() < 0.5:
                base[rng.randrange(len(base))] = rng.choice(vocab)
        sets[i] = base
    th = Threshold.of(t, measure=measure)
    expected = _brute(sets, th)
    for method in ("prefix", "overlap"):
        got = _run(spark, sets, th, method=method, cell_rows=3)
        assert got.keys() == expected.keys(), method
        for k, v in expected.items():
            assert got[k] == pytest.approx(v, abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(1, 60), st.lists(st.sampled_from("abcdefghij"), max_size=6),
                       min_size=2, max_size=25),
       st.sampled_from(["1/3", "1/2", "2/3", "1"]))
def test_prefix_equals_brute_force_property(spark, sets, t):
    th = Threshold.of(t)
    got = _run(spark, sets, th, cell_rows=2)
    assert got.keys() == _brute(sets, th).keys()


def test_pairs_within_groups_salted_grid_is_exact(spark):
    data = [("g", i, 5) for i in range(5)] + [("h", 10, 1)] + [("k", i, 40) for i in range(40)]
    df = spark.createDataFrame(data, "g string, id long, k long")
    for cell in (1, 2, 7, 100):
        out = pairs_within_groups(df, ["g"], "id", "k", cell_rows=cell)
        got = sorted((r.g, r.l_id, r.r_id) for r in out.collect())
        exp = sorted([("g", a, b) for a, b in itertools.combinations(range(5), 2)]
                     + [("k", a, b) for a, b in itertools.combinations(range(40), 2)])
        assert got == exp, cell


def test_comparison_stats(spark):
    sets = {1: "I have a dog".split(), 2: "I have a cat".split(),
            3: "I have a big dog".split(), 4: "I have a big dog".split()}
    r = similarity.comparison_stats(_docs(spark, sets), Threshold.of("4/5")).first()
    assert r.n_documents == 4 and r.all_pairs == 6 and r.distinct_sets == 3
    assert 0 <= r.candidate_pairs <= 3
    assert r.saving_ratio == pytest.approx(r.candidate_pairs / 6)


def test_hot_token_and_hot_copy_cluster_exact(spark):
    """A third of the documents are copies of one set and a third share one hot
    token; with tiny join cells both are split across many cells and the result
    still equals brute force."""
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(40)]
    sets = {}
    for i in range(1, 91):
        if i <= 30:
            sets[i] = ["hot", "a", "b", "c"]
        elif i <= 60:
            sets[i] = ["hot"] + rng.sample(vocab, rng.randint(1, 4))
        else:
            sets[i] = rng.sample(vocab, rng.randint(1, 5))
    for t in ("1/2", "4/5"):
        th = Threshold.of(t)
        for method in ("prefix", "overlap"):
            got = _run(spark, sets, th, method=method, cell_rows=4)
            assert got.keys() == _brute(sets, th).keys(), (t, method)


def test_overlap_method_packed_and_unpacked_paths_agree(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(25)]
    sets = {i: rng.sample(vocab, rng.randint(1, 7)) for i in range(1, 80)}
    sets.update({80: list(sets[5]), 81: list(sets[5])})
    th = Threshold.of("1/2")
    expected = _brute(sets, th)
    packed = _run(spark, sets, th, method="overlap")
    unpacked = _run(spark, sets, th, method="overlap", checkpoint=False)
    assert packed.keys() == expected.keys() == unpacked.keys()
    # negative ids cannot be packed: the measured check falls back
    shifted = {i - 1000: s for i, s in sets.items()}
    neg = _run(spark, shifted, th, method="overlap")
    assert neg.keys() == {(a - 1000, b - 1000) for a, b in expected}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    for method in ("prefix", "overlap"):
        assert similarity.similarity_join(empty, Threshold.of("4/5"), method=method).count() == 0
    r = similarity.comparison_stats(empty, Threshold.of("4/5")).first()
    assert (r.n_documents, r.all_pairs, r.candidate_pairs, r.saving_ratio) == (0, 0, 0, None)


def test_hot_token_and_hot_set_at_the_default_cell_size(spark):
    from pyspark.sql import functions as F
    # one token in 3000 distinct sets of one size, and one set of 2100 copies
    distinct = spark.range(3000).select(F.col("id").alias("doc_id"), F.array(
        F.concat(F.lit("u"), F.col("id").cast("string")), F.lit("hot")).alias("tokens"))
    copies = spark.range(2100).select((F.col("id") + 10_000).alias("doc_id"), F.array(
        F.lit("c1"), F.lit("c2"), F.lit("c3")).alias("tokens"))
    docs = distinct.unionByName(copies).withColumn("size", F.size("tokens"))
    pairs = similarity.similarity_join(docs, Threshold.of("4/5"))
    assert pairs.agg(F.count("*"), F.min("doc_a")).first()[:] == (2100 * 2099 // 2, 10_000)
    # sharing the hot token alone is a third: all pairs at 1/3 come through the salted grid
    low = similarity.candidate_pairs(distinct.withColumn("size", F.lit(2)).withColumnRenamed("doc_id", "set_id"),
                                     Threshold.of("1/3"))
    assert low.count() == 3000 * 2999 // 2
    set_pairs, members = similarity.similar_sets(docs, Threshold.of("4/5"))
    assert set_pairs.count() == 0
    assert members.where("copies = 2100").select("set_id").distinct().count() == 1


def test_arrays_that_read_alike_are_different_sets(spark):
    docs = spark.createDataFrame([(1, ["a b"], 1), (2, ["a", "b"], 2)], DOC_SCHEMA)
    sets, _, _ = similarity.collapse_duplicates(docs)
    assert sets.count() == 2


def test_candidates_lie_between_result_and_all_pairs(spark, sf_small):
    from lexiflow.plans import catalog
    docs = catalog.processed_lines(spark, sf_small)
    stats = similarity.comparison_stats(docs, Threshold.of("4/5")).first()
    set_pairs, _ = similarity.similar_sets(docs, Threshold.of("4/5"))
    sizes = [set(r.tokens) for r in docs.collect()]
    assert stats.n_documents == len(sizes)
    assert stats.distinct_sets == len({tuple(sorted(s)) for s in sizes})
    assert set_pairs.count() <= stats.candidate_pairs <= stats.all_pairs


# ---- ranks, signatures, adaptive prefixes

def _ranked(spark, sets):
    """The documents of :func:`_docs` with integer ranks for tokens."""
    docs = _docs(spark, sets).collect()
    freq = {}
    for d in docs:
        for t in d.tokens:
            freq[t] = freq.get(t, 0) + 1
    rank = {t: i for i, t in enumerate(sorted(freq, key=lambda t: (freq[t], t)))}
    return spark.createDataFrame([(d.doc_id, [rank[t] for t in d.tokens], d.size) for d in docs],
                                 "doc_id long, tokens array<int>, size int")


def _near_copies(seed, n, words, longest):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    sets = {}
    for i in range(1, n + 1):
        base = rng.sample(vocab, rng.randint(1, longest))
        if i > 5 and rng.random() < 0.5:
            base = list(sets[rng.randint(1, i - 1)])
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocab)
        sets[i] = base
    return sets


@pytest.mark.parametrize("shared", [None, 1, 2, 3, 4])
@pytest.mark.parametrize("measure,t", [(JACCARD, "4/5"), (JACCARD, "1/2"), (JACCARD, "7/100"),
                                       (OVERLAP_RATIO, "1/4")])
def test_adaptive_prefixes_equal_brute_force(spark, measure, t, shared):
    sets = _near_copies(11, 90, 40, 14)
    th = Threshold.of(t, measure=measure)
    docs = _ranked(spark, sets)
    for cell_rows in (3, 2048):
        got = similarity.similarity_join(docs, th, shared=shared, cell_rows=cell_rows)
        assert {(r.doc_a, r.doc_b) for r in got.collect()} == _brute(sets, th).keys()


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(1, 60), st.lists(st.sampled_from("abcdefghijklmnop"), max_size=9),
                       min_size=2, max_size=25),
       st.sampled_from(["1/3", "1/2", "4/5", "1"]), st.sampled_from([2, 3, 4, None]))
def test_shared_tokens_property(spark, sets, t, shared):
    th = Threshold.of(t)
    got = similarity.similarity_join(_ranked(spark, sets), th, shared=shared, max_broadcast_bytes=0)
    assert {(r.doc_a, r.doc_b) for r in got.collect()} == _brute(sets, th).keys()


def test_signature_bounds_the_overlap(spark):
    from pyspark.sql import functions as F

    from lexiflow.functions.sets import signature, signature_overlap
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        a = set(rng.sample(range(5000), rng.randint(1, 400)))
        b = set(rng.sample(sorted(a), rng.randint(0, len(a)))) | set(rng.sample(range(5000), rng.randint(1, 30)))
        rows.append((sorted(a), sorted(b), len(a & b)))
    df = spark.createDataFrame([*rows, ([], [1], 0), ([], [], 0)], "a array<int>, b array<int>, o int")
    got = df.select("a", "b", "o", *[w.alias(f"a{k}") for k, w in enumerate(signature(F.col("a")))],
                    *[w.alias(f"b{k}") for k, w in enumerate(signature(F.col("b")))]).select(
        "o", F.size("a").alias("n"), signature_overlap(
            F.size("a"), F.size("b"), [F.col(f"a{k}") for k in range(4)],
            [F.col(f"b{k}") for k in range(4)]).alias("bound")).collect()
    assert all(r.o <= r.bound <= r.n for r in got)
    # with few tokens hardly any share a bit: the bound is close
    small = [r for r in got if 0 < r.n <= 20]
    assert small and sum(r.bound - r.o for r in small) <= len(small) * 2


def test_profile_counts_the_posting_lists(spark):
    sets = _near_copies(3, 60, 25, 10)
    th = Threshold.of("1/2")
    distinct, _, _ = similarity.collapse_duplicates(_ranked(spark, sets), signatures=True)
    hot, measures = similarity.posting_profile(distinct, th, cell_rows=4)
    lists = {r.token: r for r in hot.collect()}
    for shared in (1, 2, 3, 4):
        probe, index = ({r.token: r["count"] for r in f(distinct, th, extra=shared - 1).groupBy("token").count().collect()}
                        for f in (similarity.prefix_postings, similarity.index_postings))
        assert measures[f"pairs{shared}"] == sum(n * index.get(t, 0) for t, n in probe.items())
        want_hot = {t for t in probe if max(probe[t], index.get(t, 0)) > 4}
        assert measures[f"hot{shared}"] == len(want_hot) and want_hot <= lists.keys()
        assert all(lists[t][f"x{shared}"] == probe[t] and lists[t][f"y{shared}"] == index.get(t, 0)
                   for t in want_hot)
    assert similarity.choose_shared({"pairs1": 10, "pairs2": 14, "pairs3": 15, "pairs4": 16}) == 3
    assert similarity.choose_shared({f"pairs{n}": 0 for n in (1, 2, 3, 4)}) == 4


def test_signatures_leave_few_candidates(spark, sf_small):
    from lexiflow.plans import catalog
    th = catalog.OVERLAP_RATIO_THRESHOLD
    sets, _, stats = similarity.collapse_duplicates(catalog.ranked_lines(spark, sf_small), signatures=True)
    plain = similarity.candidate_pairs(sets.drop(*similarity.SIGNATURE), th).count()
    left = similarity.candidate_pairs(sets, th, shared=None)
    assert left.count() * 10 < plain
    assert similarity.verify(left, sets, th).count() <= left.count()
    # candidates are made and reduced without any array on the way
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if line.lstrip(" :+-").startswith(("Join", "Aggregate")):
            assert "tokens" not in line
    assert similarity.array_table_bytes(10, 100, 0) == 48 * 10 + 8 * 100


def test_prefix_index_blocks_hold_the_prefix_index(spark):
    sets = _near_copies(5, 80, 12, 6)
    for docs in (_docs(spark, sets), _ranked(spark, sets)):
        want = {r.word: list(r.docs) for r in similarity.prefix_index(docs, Threshold.of("1/2")).collect()}
        got = {}
        for r in sorted(similarity.prefix_index_blocks(docs, Threshold.of("1/2"), width=7).collect(), key=lambda r: r.block):
            assert r.n_docs == len(r.docs) <= 7 and {d // 7 for d in r.docs} == {r.block}
            got.setdefault(r.word, []).extend(r.docs)
        assert got == want


def test_prefix_index_blocks_of_ranks_name_the_words(spark):
    from lexiflow.operators import preprocess
    words = [f"w{i}" for i in range(30)]
    rng = random.Random(3)
    lines = spark.createDataFrame([(i, " ".join(rng.choices(words, k=9))) for i in range(60)], "line_id long, value string")
    th = Threshold.of("4/5")
    plain = preprocess.preprocess(lines, "line_id", "value").withColumnRenamed("line_id", "doc_id")
    ranked, dictionary = preprocess.preprocess_ranked(lines, "line_id", "value")
    ranked = ranked.withColumnRenamed("line_id", "doc_id")
    want = sorted(map(tuple, similarity.prefix_index_blocks(plain, th, width=8).collect()))
    got = similarity.prefix_index_blocks(ranked, th, width=8, dictionary=dictionary)
    assert got.columns == ["word", "block", "n_docs", "docs"] and sorted(map(tuple, got.collect())) == want
