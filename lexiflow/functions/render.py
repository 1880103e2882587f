"""Text renderings of results, used at sinks (and to compare with SQL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats of the reference's jobs.
POSTING_SEPARATOR = ", "      # docs of one word: "a, b"
TF_MARK = "#"                 # doc and term frequency: "doc#3"
TOKEN_SEPARATOR = ";"         # processed document: "id,t1;t2"
PAIR_FORMAT = "%d,%d, similarity : %s"


def join_docs(docs: Column) -> Column:
    """``a, b, c`` from an array of document names."""
    return F.array_join(docs, POSTING_SEPARATOR)


def join_tf_postings(postings: Column) -> Column:
    """``doc#tf, doc#tf`` from an array<struct<doc, tf>>."""
    return F.array_join(
        F.transform(postings, lambda p: F.concat(p["doc"], F.lit(TF_MARK), p["tf"].cast("string"))),
        POSTING_SEPARATOR)


def join_tokens(tokens: Column) -> Column:
    """``t1;t2;t3`` without a trailing separator."""
    return F.array_join(tokens, TOKEN_SEPARATOR)


def pair_line(doc_a: Column, doc_b: Column, similarity: Column) -> Column:
    """``a,b, similarity : x`` with x printed as a 32-bit float like the reference."""
    return F.format_string(PAIR_FORMAT, doc_a, doc_b,
                           similarity.cast("float").cast("string"))
