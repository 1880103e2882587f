"""Secret scan over an incremental blob ledger.

Every version of every path is a blob addressed by the SHA-256 of its content.
The ledger is a table of (blob, rule version, findings); a scan takes only
the blobs it does not hold for the rule version in force, appends their
findings, and joins findings back to all paths that hold the blob.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm.common import text_or_empty
from lexiflow.operators.index import split_by_bitmap
from lexiflow.session import materialize, materialize_measured

# The rules, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex")
RULE_VERSION = "base-1"
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run of 32 or more is the same as a maximal run kept when it has 32 or more
_HEX = re.compile(r"[0-9a-f]{32,}")

FINDING = "array<struct<start:long,kind_no:int,end:long>>"
#: sizes of the bitmaps of addresses: 128 kB to 32 MB
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
_LEDGER = f"blob string, rule_version string, findings {FINDING}"


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every finding, by start and then kind; code points."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _scan(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64())]))
    for batch in batches:
        found = [[dict(zip(("start", "kind_no", "end"), f, strict=True)) for f in find_secrets(t.as_py())]
                 for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)],
                                         names=["blob", "findings"])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows, one per (blob, rule version); a ledger not begun yet is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    # a scan that was cut off and run again may have filed a blob twice, with equal findings
    return spark.read.schema(_LEDGER).parquet(path).dropDuplicates(["blob", "rule_version"])


def _blob(content_col: str):
    return F.sha2(text_or_empty(content_col), 256)


def update_ledger(versions: DataFrame, ledger: str, content_col: str = "text",
                  rule_version: str = RULE_VERSION) -> None:
    """Scan the blobs of ``versions`` that ``ledger`` does not hold for ``rule_version``."""
    blobs = materialize(versions.select(_blob(content_col).alias("blob")), "ledger-blobs")
    _file_unseen(versions, blobs, ledger, content_col, rule_version)


def _file_unseen(versions: DataFrame, blobs: DataFrame, ledger: str, content_col: str,
                 rule_version: str) -> None:
    """:func:`update_ledger`, given the ``blob`` of every row of ``versions`` as a written table.

    What is to be scanned is settled on addresses alone. Two bitmaps of them, of bounded size, then tell
    of most contents where they stand whether they are surely in the ledger, or surely unseen and held by one row;
    the former are skipped and the latter scanned in place. Only contents of several rows, and the few that a
    bitmap leaves in doubt, are shuffled, one copy per task, and matched with the unseen addresses.
    """
    spark = versions.sparkSession
    held = blobs.groupBy("blob").agg(F.count(F.lit(1)).alias("copies"))
    begun = _exists(spark, ledger)
    if begun:
        done = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version).select("blob")
        held = held.join(done.withColumn("known", F.lit(True)), "blob", "left")
    else:
        held = held.withColumn("known", F.lit(None).cast("boolean"))
    unseen = F.col("known").isNull()
    alone = unseen & (F.col("copies") == 1)
    held, m = materialize_measured(held, "ledger-state", {
        "unseen": F.sum(unseen.cast("long")), "others": F.sum((~alone).cast("long"))})
    rows = versions.select(text_or_empty(content_col).alias("content")) \
        .select(F.sha2("content", 256).alias("blob"), "content")
    if begun:
        rows = split_by_bitmap(rows, F.col("blob"), held.where(unseen), "blob", bitmap_bits(m["unseen"]))[1]
    in_place, doubtful = split_by_bitmap(rows, F.col("blob"), held.where(~alone), "blob",
                                         bitmap_bits(m["others"]))
    one_each = (doubtful.groupBy("blob").agg(F.first("content").alias("content"))
                .join(held.where(unseen).select("blob"), "blob", "left_semi"))
    (in_place.unionByName(one_each).mapInArrow(_scan, f"blob string, findings {FINDING}")
     .select("blob", F.lit(rule_version).alias("rule_version"), "findings")
     .write.mode("append").parquet(ledger))


def bitmap_bits(n: int) -> int:
    """Bits of a bitmap of ``n`` addresses: 16 or more for each, as long as ``MOST_BITS`` allow it.

    Past that more contents are in doubt, and so shuffled; no result depends on it.
    """
    bits = LEAST_BITS
    while bits < min(16 * n, MOST_BITS):
        bits *= 2
    return bits


def findings_by_path(versions: DataFrame, ledger: str, path_col: str = "doc_id",
                     content_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Per row of ``versions``: path, ``blob``, ``findings`` (empty array if none).

    A blob held by very many paths is one hot key on the path side of an
    equi-join of narrow rows, which the skew join splits; only blobs with findings join.
    """
    return _join_findings(versions.select(F.col(path_col).alias("path"), _blob(content_col).alias("blob")),
                          ledger, path_col, rule_version)


def _join_findings(paths: DataFrame, ledger: str, path_col: str, rule_version: str) -> DataFrame:
    found = (read_ledger(paths.sparkSession, ledger)
             .where((F.col("rule_version") == rule_version) & (F.size("findings") > 0))
             .select("blob", "findings"))
    return paths.join(found, "blob", "left").select(
        F.col("path").alias(path_col), "blob",
        F.coalesce("findings", F.array().cast(FINDING)).alias("findings"))


def scan(versions: DataFrame, ledger: str, path_col: str = "doc_id", content_col: str = "text",
         rule_version: str = RULE_VERSION) -> DataFrame:
    """Bring the ledger up to date with ``versions`` and return :func:`findings_by_path`.

    Defined cases: null content is the empty blob; null paths and repeated rows come out as they
    went in; an empty table adds nothing and returns nothing; other columns are not read.
    """
    paths = materialize(versions.select(F.col(path_col).alias("path"), _blob(content_col).alias("blob")),
                        "ledger-paths")
    _file_unseen(versions, paths.select("blob"), ledger, content_col, rule_version)
    return _join_findings(paths, ledger, path_col, rule_version)


def _of_kind(number: int):
    return lambda f: f.kind_no == number


def finding_digest(found: DataFrame) -> DataFrame:
    """Add n_assign, n_access, n_hex, spans and base_sha256 from the ``findings`` column."""
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_join(F.transform("findings", lambda f: F.concat_ws(
        ":", F.element_at(names, f.kind_no + 1), f.start.cast("string"), f.end.cast("string"))), ",")
    out = found.withColumn("spans", spans)
    for i, k in enumerate(KINDS):
        out = out.withColumn(f"n_{k}", F.size(F.filter("findings", _of_kind(i))).cast("long"))
    return out.withColumn("base_sha256", F.sha2("spans", 256))
