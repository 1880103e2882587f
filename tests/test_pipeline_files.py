"""The reference's whole chain on plain text files, checked against brute force.

Lines of a text corpus are numbered densely (documents = non-empty lines),
word counts and the stop list are written as ``word,n`` files and read back,
lines are preprocessed, similar pairs are found with the prefix join and
written as ``a,b, similarity : x`` lines.
"""

import itertools
import os
import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import functions as F

from lexiflow.functions.render import pair_line
from lexiflow.functions.sets import Threshold
from lexiflow.operators import counts, preprocess, similarity
from lexiflow.session import scratch_path
from lexiflow.sinks.delimited import COMMA, write_delimited
from lexiflow.sources.lines import number_lines
from lexiflow.sources.side_inputs import read_stop_list, read_word_counts

STOP = 30


def _brute(lines, t):
    toks = [re.findall(r"[A-Za-z0-9]+", v) for v in lines]
    freq = Counter(w for ws in toks for w in ws)
    docs = {}
    for i, ws in enumerate(toks, start=1):
        s = {w for w in ws if freq[w] <= STOP}
        if s:
            docs[i] = s
    out = {}
    for (a, sa), (b, sb) in itertools.combinations(sorted(docs.items()), 2):
        o = len(sa & sb)
        if Fraction(o, len(sa | sb)) >= t:
            out[(a, b)] = o / len(sa | sb)
    return len(docs), out


def test_text_file_chain_matches_brute_force(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(os.path.join(sf_small, "documents.parquet"))
             .orderBy("doc_id").limit(60).collect()]
    lines = [ln for tx in texts for ln in tx.split("\n") if ln != ""]
    src = scratch_path(spark, "chain-src")
    os.makedirs(src)
    with open(os.path.join(src, "corpus.txt"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")

    numbered = number_lines(spark, src)  # line_id 1..N over non-empty lines
    freq_path, stop_path = scratch_path(spark, "freq"), scratch_path(spark, "stop")
    wc = counts.count_words(numbered, "value")
    write_delimited(wc, freq_path, "word", "n", sep=COMMA, n_files=3)
    write_delimited(counts.stop_words(wc, STOP), stop_path, "word", "n", sep=COMMA, n_files=1)
    docs = preprocess.preprocess(numbered, "line_id", "value",
                                 stop=read_stop_list(spark, stop_path),
                                 frequencies=read_word_counts(spark, freq_path))
    docs = docs.withColumnRenamed("line_id", "doc_id")
    t = Fraction(4, 5)
    pairs = similarity.similarity_join(docs, Threshold.of(t), posting_bound=STOP)
    out = scratch_path(spark, "pairs")
    pairs.select(pair_line(F.col("doc_a"), F.col("doc_b"), F.col("similarity"))
                 .alias("value")).write.text(out)

    n_docs, expected = _brute(lines, t)
    assert len(expected) > 10  # the fixture has near and exact copies
    assert docs.count() == n_docs
    got = {}
    for r in spark.read.text(out).collect():
        a, b, x = re.match(r"^(\d+),(\d+), similarity : (.*)$", r.value).groups()
        got[(int(a), int(b))] = float(x)
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert abs(got[k] - v) < 1e-6
