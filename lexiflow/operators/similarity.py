"""Set-similarity self-joins over token-set documents.

Input: ``docs`` with an id column, ``tokens`` (distinct, in one global order,
rarest first: words as of :func:`lexiflow.operators.preprocess.preprocess`, or their integer
ranks as of :func:`~lexiflow.operators.preprocess.preprocess_ranked`, which are
narrower everywhere) and ``size``. Output pairs ``doc_a < doc_b`` with ``similarity``.

Plan, all DataFrame joins and aggregates:

1. Exact duplicates are collapsed: documents with identical token arrays form
   one *set* (id = smallest member id). Copies are the bulk of similar pairs in
   web-like text, and a cluster of k copies would otherwise cost k^2
   candidates per shared token.
2. Prefix filtering between distinct sets: each set posts its first
   ``d - ceil(t*d) + 1`` tokens; sets sharing a posted token become candidates
   if their sizes are compatible. With ``l - 1`` tokens more on both sides a pair must share ``l``
   of them; ``l`` is chosen from the measured lengths of the posting lists
   (:func:`posting_profile`). Posting lists are paired with a salted grid
   (:func:`pairs_across_groups`), so a hot token never lands in one task.
3. A posting carries a 256-bit signature of its set. Bits that only one of two
   sets has bound the overlap from above, so most candidates go where they arise, before they
   are shuffled and before any token array is fetched.
4. Distinct candidates (deduplicated by the same aggregate that applies the
   positional filter) fetch both token arrays by id — broadcast lookups when
   the measured size of the sets allows, else two shuffle joins, never a
   driver-side copy — and are verified exactly in integer arithmetic.
5. Similar set pairs expand to member pairs; copies inside one set are pairs
   with similarity 1 (Jaccard) or 1/2 (overlap ratio).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.functions.sets import (JACCARD, SIGNATURE_WORDS, Threshold, accept, overlap_of,
                                     pair_count, pair_ratio, prefix_length, signature,
                                     signature_overlap, similarity_value, size_compatible)
from lexiflow.operators.index import posting_blocks
from lexiflow.operators.joins import (DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS,
                                      DEFAULT_CELL_ROWS, broadcast_if_small, key_table_bytes,
                                      pairs_across_groups, pairs_within_groups)
from lexiflow.session import materialize_measured, scratch_path

SIGNATURE = [f"sig{k}" for k in range(SIGNATURE_WORDS)]
#: most tokens that two prefixes may have to share, and by how much the posting joins may grow for it
MAX_SHARED = 4
SHARED_GROWTH = 1.5


def as_threshold(threshold, measure: str = JACCARD, strict: bool | None = None) -> Threshold:
    return threshold if isinstance(threshold, Threshold) else \
        Threshold.of(threshold, measure=measure, strict=strict)


def _words(docs: DataFrame) -> bool:
    """Are the tokens words (and not ranks)?"""
    return isinstance(docs.schema["tokens"].dataType.elementType, T.StringType)


def collapse_duplicates(docs: DataFrame, id_col: str = "doc_id", checkpoint: bool = True,
                        signatures: bool = False) -> tuple[DataFrame, DataFrame, dict | None]:
    """(sets, members, stats): distinct token arrays and the documents holding them.

    sets:    set_id (smallest member id), tokens, size, copies (and the ``signatures``)
    members: <id_col>, set_id, copies, size
    Each document is tagged with its set once: an aggregate on the SHA-256 of the
    token array (each token with its length before it, so no two arrays read alike), partial
    map-side so a hot copy cluster collapses before the shuffle, joined back on those
    32 bytes; arrays never are a shuffle key and AQE splits a hot one. The tagged table
    is written once (``checkpoint``); ``sets`` is then a narrow filter on it
    (the member whose id is the set id) and ``members`` a projection, so no
    later stage recomputes the preprocessing or the grouping. ``stats`` of the
    sets (count ``n``, tokens ``t``, characters ``c``, id range, largest size)
    are observed during that write; None without ``checkpoint``.
    """
    words = _words(docs)
    spelled = F.transform("tokens", lambda t: F.concat(F.length(t).cast("string"), F.lit(":"), t)) \
        if words else F.col("tokens").cast("array<string>")
    docs = docs.select(id_col, "tokens", "size",
                       F.unhex(F.sha2(F.array_join(spelled, ","), 256)).alias("_print"))
    set_of = (docs.groupBy("_print")
              .agg(F.min(id_col).alias("set_id"), F.count(F.lit(1)).alias("copies")))
    tagged = docs.join(set_of, "_print").drop("_print")
    stats = None
    rep = F.col(id_col) == F.col("set_id")
    if signatures:
        tagged = tagged.select("*", *[F.when(rep, word).alias(name) for name, word in
                                      zip(SIGNATURE, signature(F.col("tokens")), strict=True)])
    if checkpoint:
        chars = F.octet_length(F.array_join("tokens", "")).cast("bigint") if words else F.lit(0).cast("bigint")
        tagged, stats = materialize_measured(tagged, "set-members", {
            "n": F.count(F.when(rep, 1)),
            "t": F.sum(F.when(rep, F.col("size").cast("bigint"))),
            "c": F.sum(F.when(rep, chars)),
            "min_id": F.min("set_id"), "max_id": F.max("set_id"),
            "max_size": F.max("size")})
    sets = tagged.where(rep).select("set_id", "tokens", "size", "copies",
                                    *(SIGNATURE if signatures else []))
    members = tagged.select(id_col, "set_id", "copies", "size")
    return sets, members, stats


def _salt_sizes(postings: DataFrame, key: str, cell_rows: int, max_broadcast_rows: int,
                posting_bound: int | None = None) -> tuple[DataFrame, str | None]:
    """Attach ``_k`` = posting-list length for hot keys (0 otherwise).

    Returns the postings and the name of the group-size column for
    :func:`pairs_within_groups`. With a proven ``posting_bound <= cell_rows``
    (stop words removed at threshold T bound every token's postings by T) no
    key can be hot: the counting job is skipped and ``None`` is returned.
    """
    if posting_bound is not None and posting_bound <= cell_rows:
        return postings, None
    counts = postings.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
    hot, m = materialize_measured(counts.where(F.col("_k") > cell_rows), "hot-keys",
                                  {"rows": F.count(F.lit(1))})
    hot = broadcast_if_small(hot, max_broadcast_rows, known_rows=m["rows"])
    return (postings.join(hot, key, "left")
            .withColumn("_k", F.coalesce(F.col("_k"), F.lit(0)))), "_k"


def _postings(sets: DataFrame, length: Column, id_col: str, extra: int = 0,
              carry: tuple[str, ...] = ()) -> DataFrame:
    """(<id_col>, size, pos, token, carry): the first ``length + extra`` tokens of every set."""
    most = F.least(F.col("size"), length + F.lit(extra))
    return sets.select(id_col, "size", *carry,
                       F.posexplode(F.slice("tokens", F.lit(1), most)).alias("pos", "token")) \
        .withColumn("pos", F.col("pos") + 1)


def _probe_length(th: Threshold) -> Column:
    p, q = th.jaccard_bound()
    return prefix_length(F.col("size"), p, q)


def _index_length(th: Threshold) -> Column:
    p, q = th.jaccard_bound()
    return prefix_length(F.col("size"), 2 * p, p + q)


def prefix_postings(sets: DataFrame, th: Threshold, id_col: str = "set_id", extra: int = 0,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """(<id_col>, size, pos, token): the first prefix-length tokens of every set.

    ``pos`` is the 1-based position of the token in the set's global order; ``extra`` lengthens
    the prefix, the columns ``carry`` come along.
    """
    return _postings(sets, _probe_length(th), id_col, extra, carry)


def required_overlap_ok(bound: F.Column, size_a: F.Column, size_b: F.Column,
                        p: int, q: int) -> F.Column:
    """Can an overlap of at most ``bound`` reach Jaccard p/q?  o*(p+q) >= p*(|A|+|B|)."""
    return bound.cast("bigint") * (p + q) >= (size_a + size_b).cast("bigint") * p


def index_postings(sets: DataFrame, th: Threshold, id_col: str = "set_id", extra: int = 0,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """(<id_col>, size, pos, token): the shorter *index* prefix of every set.

    When the larger document of a pair probes with its prefix, the smaller
    one needs only its first ``d - ceil(2t/(1+t) d) + 1`` tokens indexed: a
    pair with Jaccard >= t shares at least 2t/(1+t)·|smaller| tokens, so its
    first shared token lies in both prefixes (the AllPairs / PPJoin indexing
    bound). With ``extra`` tokens more on both sides ``extra + 1`` shared tokens do.
    """
    return _postings(sets, _index_length(th), id_col, extra, carry)


def posting_profile(sets: DataFrame, th: Threshold, cell_rows: int = DEFAULT_CELL_ROWS,
                    most: int = MAX_SHARED) -> tuple[DataFrame, dict]:
    """(hot, measures): lengths of the posting lists when prefixes must share 1 to ``most`` tokens.

    A posting's level is the smallest number of shared tokens whose prefix holds it. ``hot`` has the
    tokens with more than ``cell_rows`` postings on a side at the last level, with the lengths
    ``x1..``, ``y1..`` of their probe and index lists at each level. ``measures`` has, per level l:
    ``pairs<l>``, the rows that joining the lists gives at most, ``hot<l>`` and ``chars<l>``, number
    and bytes of its hot tokens. One aggregate with map-side combine; only hot tokens are written.
    """
    levels = range(1, most + 1)
    # the index prefix is a part of the probe prefix: one pass over the postings counts both
    postings = _postings(sets.withColumn("_probe", _probe_length(th)).withColumn("_index", _index_length(th)),
                         F.col("_probe"), "set_id", most - 1, ("_probe", "_index"))
    lists = postings.groupBy("token").agg(
        *[F.count(F.when(F.col("pos") < F.col(length) + n, 1)).alias(f"{side}{n}")
          for side, length in (("x", "_probe"), ("y", "_index")) for n in levels])
    obs = Observation(f"postings-{uuid.uuid4().hex[:8]}")

    def hot(n: int) -> Column:
        return F.greatest(f"x{n}", f"y{n}") > cell_rows

    chars = F.octet_length(F.col("token").cast("string")).cast("bigint")
    path = scratch_path(sets.sparkSession, "hot-tokens")
    (lists.observe(obs, *[F.sum(F.col(f"x{n}").cast("double") * F.col(f"y{n}")).alias(f"pairs{n}") for n in levels],
                   *[F.count(F.when(hot(n), 1)).alias(f"hot{n}") for n in levels],
                   *[F.sum(F.when(hot(n), chars)).alias(f"chars{n}") for n in levels])
     .where(hot(most)).write.parquet(path))
    return sets.sparkSession.read.parquet(path), {k: v or 0 for k, v in obs.get.items()}


def choose_shared(measures: dict, most: int = MAX_SHARED, growth: float = SHARED_GROWTH) -> int:
    """The most tokens to share for which joining the posting lists grows to ``growth`` times at most."""
    allowed = [n for n in range(1, most + 1) if measures[f"pairs{n}"] <= growth * measures["pairs1"]]
    return max(allowed, default=1)


def candidate_pairs(sets: DataFrame, th: Threshold, cell_rows: int = DEFAULT_CELL_ROWS,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    posting_bound: int | None = None, shared: int | None = 1) -> DataFrame:
    """(l_set_id, r_set_id, l_size, r_size): distinct prefix candidates that survive
    the size filter, the positional filter and, if ``sets`` has them, the signatures (J4).

    Sets are ordered by (size, id). The later set ``x`` probes with its prefix,
    the earlier set ``y`` is indexed on its shorter index prefix
    (:func:`index_postings`); each pair is generated in that one orientation.
    ``shared`` tokens must lie in both prefixes, which are longer by ``shared - 1`` for it (None: as
    many as :func:`choose_shared` allows); a pair whose least overlap is smaller must share that.
    Positional filter: tokens are in one global order, so every token the two
    sets share before their last shared prefix token is itself a match. With
    ``m`` matches, the last at positions (i, j), the overlap is at most
    ``m + min(|x| - i, |y| - j)``; pairs whose bound cannot reach the
    threshold are dropped. The per-pair aggregate that computes the bound also
    removes duplicate candidates (one shuffle either way). Tokens with long
    posting lists are split into a salted grid unless ``posting_bound`` proves
    none exists.
    """
    p, q = th.jaccard_bound()
    signed = SIGNATURE[0] in sets.columns
    carry = tuple(SIGNATURE) if signed else ()
    bounded = posting_bound is not None and posting_bound <= cell_rows
    hot = None
    if shared is None or not bounded:
        most = MAX_SHARED if shared is None else shared
        lists, measures = posting_profile(sets, th, cell_rows, most)
        shared = choose_shared(measures, most) if shared is None else shared
        if measures[f"hot{shared}"] and not bounded:
            rows = measures[f"hot{shared}"]
            hot = broadcast_if_small(
                lists.select("token", F.col(f"x{shared}").alias("_kl"), F.col(f"y{shared}").alias("_kr"))
                .where(F.greatest("_kl", "_kr") > cell_rows), max_broadcast_rows, known_rows=rows,
                known_bytes=key_table_bytes(rows, 1, measures[f"chars{shared}"]))

    def side(postings: DataFrame, name: str) -> DataFrame:
        return postings.select(F.col("set_id").alias(f"{name}_id"), F.col("size").alias(f"{name}_size"),
                               F.col("pos").alias(f"{name}_pos"), "token",
                               *[F.col(c).alias(f"{name}_{c}") for c in carry])

    probe = side(prefix_postings(sets, th, extra=shared - 1, carry=carry), "x")
    index = side(index_postings(sets, th, extra=shared - 1, carry=carry), "y")
    if hot is not None:
        zero = {"_kl": 0, "_kr": 0}
        probe = probe.join(hot, "token", "left").fillna(zero)
        index = index.join(hot, "token", "left").fillna(zero)
    pairs = pairs_across_groups(probe, index, ["token"], "x_id", "y_id", hot is not None, cell_rows)
    x_size, y_size = F.col("x_size"), F.col("y_size")
    later = (x_size > y_size) | ((x_size == y_size) & (F.col("x_id") > F.col("y_id")))
    pairs = pairs.where(later & size_compatible(x_size, y_size, p, q))
    if signed:
        most = signature_overlap(x_size, y_size, [F.col(f"x_{c}") for c in SIGNATURE],
                                 [F.col(f"y_{c}") for c in SIGNATURE])
        pairs = pairs.where(required_overlap_ok(most, x_size, y_size, p, q))
    # sizes depend on the ids: carried as max() so the key is just the id pair
    per_pair = (pairs.groupBy("x_id", "y_id")
                .agg(F.max("x_size").alias("x_size"), F.max("y_size").alias("y_size"),
                     F.count(F.lit(1)).alias("_m"), F.max("x_pos").alias("_i"),
                     F.max("y_pos").alias("_j")))
    bound = F.col("_m") + F.least(x_size - F.col("_i"), y_size - F.col("_j"))
    kept = per_pair.where(required_overlap_ok(bound, x_size, y_size, p, q))
    if shared > 1:
        kept = kept.where((F.col("_m") >= shared) | required_overlap_ok(F.col("_m"), x_size, y_size, p, q))
    x_first = F.col("x_id") < F.col("y_id")
    return kept.select(
        F.least("x_id", "y_id").alias("l_set_id"), F.greatest("x_id", "y_id").alias("r_set_id"),
        F.when(x_first, F.col("x_size")).otherwise(F.col("y_size")).alias("l_size"),
        F.when(x_first, F.col("y_size")).otherwise(F.col("x_size")).alias("r_size"))


def array_table_bytes(rows: int, tokens: int, chars: int) -> int:
    """Upper estimate of the in-memory bytes of ``(id, tokens)`` rows (ranks: no ``chars``)."""
    return 48 * rows + (24 if chars else 8) * tokens + chars


def verify(candidates: DataFrame, sets: DataFrame, th: Threshold,
           broadcast_sets: bool = False) -> DataFrame:
    """(set_a, set_b, similarity) for candidates passing the exact test.

    ``broadcast_sets`` (decided by the caller from a byte-size check) ships
    the token arrays to every task; otherwise candidates are shuffled to them.
    """
    toks = sets.select("set_id", "tokens")
    if broadcast_sets:
        toks = F.broadcast(toks)
    joined = (candidates
              .join(toks.withColumnRenamed("set_id", "l_set_id")
                    .withColumnRenamed("tokens", "l_tokens"), "l_set_id")
              .join(toks.withColumnRenamed("set_id", "r_set_id")
                    .withColumnRenamed("tokens", "r_tokens"), "r_set_id"))
    overlap = overlap_of(F.col("l_tokens"), F.col("r_tokens"))
    scored = joined.select(F.col("l_set_id").alias("set_a"), F.col("r_set_id").alias("set_b"),
                           "l_size", "r_size", overlap.alias("_o"))
    return (scored.where(accept(F.col("_o"), F.col("l_size"), F.col("r_size"), th))
            .select("set_a", "set_b",
                    similarity_value(F.col("_o"), F.col("l_size"), F.col("r_size"),
                                     th.measure).alias("similarity")))


# Packed posting keys: ``id << SIZE_BITS | size`` in one bigint.
SIZE_BITS = 20


def _packable(stats: dict | None) -> bool:
    """Ids and sizes measured to fit one bigint key (ids >= 0, < 2^43; sizes < 2^20)."""
    return bool(stats) and stats["n"] > 0 and stats["min_id"] >= 0 \
        and stats["max_id"] < (1 << (63 - SIZE_BITS)) and stats["max_size"] < (1 << SIZE_BITS)


def overlap_pairs(sets: DataFrame, th: Threshold, cell_rows: int = DEFAULT_CELL_ROWS,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  posting_bound: int | None = None, stats: dict | None = None) -> DataFrame:
    """(set_a, set_b, similarity) by counting shared tokens over the full index.

    No prefix filter: every size-compatible pair sharing any token is scored
    (the all-pairs semantics, minus pairs with nothing in common, which score
    0). Overlaps come from a partial-aggregated count, no arrays are fetched.
    When the measured ``stats`` show ids and sizes fit, each posting carries
    ``id << 20 | size`` as one key, so the size filter reads bits and the
    per-pair aggregate is a bare count on two longs (no size columns carried).
    """
    p, q = th.jaccard_bound()
    if _packable(stats):
        mask = (1 << SIZE_BITS) - 1
        postings = sets.select(
            (F.shiftleft(F.col("set_id"), SIZE_BITS) + F.col("size")).alias("key"),
            F.explode("tokens").alias("token"))
        postings, k = _salt_sizes(postings, "token", cell_rows, max_broadcast_rows,
                                  posting_bound)
        pairs = pairs_within_groups(postings, ["token"], "key", k, cell_rows=cell_rows)
        l_size = F.col("l_key").bitwiseAND(F.lit(mask))
        r_size = F.col("r_key").bitwiseAND(F.lit(mask))
        pairs = pairs.where(size_compatible(l_size, r_size, p, q))
        scored = pairs.groupBy("l_key", "r_key").agg(F.count(F.lit(1)).alias("_o"))
        scored = scored.select(
            F.shiftright("l_key", SIZE_BITS).alias("l_set_id"),
            F.shiftright("r_key", SIZE_BITS).alias("r_set_id"),
            F.col("l_key").bitwiseAND(F.lit(mask)).cast("int").alias("l_size"),
            F.col("r_key").bitwiseAND(F.lit(mask)).cast("int").alias("r_size"), "_o")
    else:
        postings = sets.select("set_id", "size", F.explode("tokens").alias("token"))
        postings, k = _salt_sizes(postings, "token", cell_rows, max_broadcast_rows,
                                  posting_bound)
        pairs = pairs_within_groups(postings, ["token"], "set_id", k, carry=["size"],
                                    cell_rows=cell_rows)
        pairs = pairs.where(size_compatible(F.col("l_size"), F.col("r_size"), p, q))
        scored = (pairs.groupBy("l_set_id", "r_set_id")
                  .agg(F.max("l_size").alias("l_size"), F.max("r_size").alias("r_size"),
                       F.count(F.lit(1)).alias("_o")))
    return (scored.where(accept(F.col("_o"), F.col("l_size"), F.col("r_size"), th))
            .select(F.col("l_set_id").alias("set_a"), F.col("r_set_id").alias("set_b"),
                    similarity_value(F.col("_o"), F.col("l_size"), F.col("r_size"),
                                     th.measure).alias("similarity")))


def expand_pairs(set_pairs: DataFrame, members: DataFrame, th: Threshold,
                 id_col: str = "doc_id", cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """Member pairs of similar sets plus pairs of copies inside one set."""
    a = members.select(F.col("set_id").alias("set_a"), F.col(id_col).alias("_a"))
    b = members.select(F.col("set_id").alias("set_b"), F.col(id_col).alias("_b"))
    across = (set_pairs.join(a, "set_a").join(b, "set_b")
              .select(F.least("_a", "_b").alias("doc_a"), F.greatest("_a", "_b").alias("doc_b"),
                      "similarity"))
    multi = members.where(F.col("copies") > 1)
    within = pairs_within_groups(multi, ["set_id"], id_col, "copies", carry=["size"],
                                 cell_rows=cell_rows)
    s = F.col("l_size")
    within = (within.where(accept(s, s, s, th))
              .select(F.col(f"l_{id_col}").alias("doc_a"), F.col(f"r_{id_col}").alias("doc_b"),
                      similarity_value(s, s, s, th.measure).alias("similarity")))
    return across.unionByName(within)


def similarity_join(docs: DataFrame, threshold, measure: str = JACCARD, *,
                    id_col: str = "doc_id", strict: bool | None = None, method: str = "prefix",
                    posting_bound: int | None = None, cell_rows: int = DEFAULT_CELL_ROWS,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                    checkpoint: bool = True, shared: int | None = None) -> DataFrame:
    """All pairs (doc_a < doc_b) with similarity >= t (or > t when strict).

    method="prefix": prefix-filtered candidates verified by id join (the
    reference's inverted-index job); method="overlap": full-index overlap
    counting, i.e. every pair that could score above zero (the all-pairs job).
    Both return the same rows. ``posting_bound``: a proven upper bound on how
    many documents share one token (the stop threshold after stop-word
    removal); it lets the join skip hot-token detection. ``checkpoint`` writes
    the documents tagged with their duplicate set once to the shared
    checkpoint folder (the stage boundary the reference also writes after
    preprocessing), so every later stage re-reads them instead of recomputing.
    """
    th = as_threshold(threshold, measure, strict)
    sets, members, stats = collapse_duplicates(docs, id_col, checkpoint, signatures=method == "prefix")
    if method == "prefix":
        cands = candidate_pairs(sets, th, cell_rows, max_broadcast_rows, posting_bound, shared)
        small = stats is not None and \
            array_table_bytes(stats["n"], stats["t"], stats["c"]) <= max_broadcast_bytes
        set_pairs = verify(cands, sets, th, broadcast_sets=small)
    elif method == "overlap":
        set_pairs = overlap_pairs(sets, th, cell_rows, max_broadcast_rows, posting_bound, stats)
    else:
        raise ValueError(f"unknown method {method!r}")
    return expand_pairs(set_pairs, members, th, id_col, cell_rows)


def all_pairs(docs: DataFrame, threshold, measure: str = JACCARD, **kw) -> DataFrame:
    """The all-pairs job (J3): every pair scored exactly, no prefix filter."""
    return similarity_join(docs, threshold, measure, method="overlap", **kw)


def prefix_index(docs: DataFrame, threshold, measure: str = JACCARD,
                 id_col: str = "doc_id") -> DataFrame:
    """(word, n_docs, docs): the inverted index of prefix tokens only.

    For documents whose stop words are removed at a threshold T, as :func:`preprocess` does: a
    posting list then holds at most T ids.
    """
    th = as_threshold(threshold, measure)
    posted = prefix_postings(docs.withColumnRenamed(id_col, "_pid"), th, id_col="_pid")
    return (posted.groupBy(F.col("token").alias("word"))
            .agg(F.count(F.lit(1)).alias("n_docs"),
                 F.array_sort(F.collect_list("_pid")).alias("docs")))


def prefix_index_blocks(docs: DataFrame, threshold, measure: str = JACCARD, id_col: str = "doc_id",
                        width: int = 4096, dictionary: DataFrame | None = None) -> DataFrame:
    """(word, block, n_docs, docs): :func:`prefix_index` in rows of at most ``width`` documents.

    For documents of any preprocessing: nothing needs to bound a posting list. Block b holds the ids
    ``b * width`` to ``b * width + width - 1``. Tokens that are ranks are turned into words by ``dictionary``
    (word, rank) at the end, so that only integers are dealt out on the way and a word meets its blocks, not its documents.
    """
    th = as_threshold(threshold, measure)
    posted = prefix_postings(docs.withColumnRenamed(id_col, "_pid"), th, id_col="_pid")
    blocks = posting_blocks(posted.select(F.col("token").alias("word"), F.col("_pid").alias("doc")), width=width)
    if dictionary is None:
        return blocks
    return (blocks.withColumnRenamed("word", "rank").join(dictionary.select("rank", "word"), "rank")
            .select("word", "block", "n_docs", "docs"))


def comparison_stats(docs: DataFrame, threshold, measure: str = JACCARD, *,
                     id_col: str = "doc_id", posting_bound: int | None = None,
                     cell_rows: int = DEFAULT_CELL_ROWS,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                     checkpoint: bool = True) -> DataFrame:
    """One row: documents, all pairs n(n-1)/2, distinct sets, prefix candidates, ratio."""
    th = as_threshold(threshold, measure)
    sets, members, _ = collapse_duplicates(docs, id_col, checkpoint)
    cands = candidate_pairs(sets, th, cell_rows, max_broadcast_rows, posting_bound)
    # three scalars gathered as tagged rows and folded by one aggregate
    tagged = (members.select(F.lit("n_documents").alias("_m"))
              .unionByName(sets.select(F.lit("distinct_sets").alias("_m")))
              .unionByName(cands.select(F.lit("candidate_pairs").alias("_m"))))
    counts = tagged.agg(*[F.count(F.when(F.col("_m") == m, 1)).alias(m)
                          for m in ("n_documents", "distinct_sets", "candidate_pairs")])
    n = F.col("n_documents")
    return counts.select("n_documents", pair_count(n).alias("all_pairs"), "distinct_sets",
                         "candidate_pairs",
                         pair_ratio(F.col("candidate_pairs"), n).alias("saving_ratio"))


def similar_sets(docs: DataFrame, threshold, measure: str = JACCARD, *, id_col: str = "doc_id",
                 strict: bool | None = None, posting_bound: int | None = None,
                 cell_rows: int = DEFAULT_CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """The similarity join in class form: (set_a, set_b, similarity) and (``id_col``, set_id, copies, size).

    Copies of one token set are one class, so a cluster of k copies costs k membership rows
    instead of the k(k-1)/2 pairs of :func:`similarity_join`, and no link between different sets is lost.
    """
    th = as_threshold(threshold, measure, strict)
    sets, members, stats = collapse_duplicates(docs, id_col, signatures=True)
    cands = candidate_pairs(sets, th, cell_rows, posting_bound=posting_bound, shared=None)
    small = array_table_bytes(stats["n"], stats["t"], stats["c"]) <= DEFAULT_BROADCAST_BYTES
    return verify(cands, sets, th, broadcast_sets=small), members


def all_pairs_stats(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """One row for the all-pairs method (A15 for J3): documents, the n(n-1)/2 comparisons it
    makes, distinct token sets. Counted, never enumerated."""
    sets, members, _ = collapse_duplicates(docs, id_col)
    counts = members.agg(F.count(F.lit(1)).alias("n_documents"),
                         F.count(F.when(F.col(id_col) == F.col("set_id"), 1)).alias("distinct_sets"))
    return counts.select("n_documents", pair_count(F.col("n_documents")).alias("all_pairs"), "distinct_sets")
