"""Mixing sources to target weights by Poisson replication.

Source ``s`` with volume ``V_s`` (code points of its texts) and target weight
``w_s`` should be repeated ``epochs * w_s * V / V_s`` times on average. Each
document draws its own repetition count by inverting the Poisson distribution
of that mean at a uniform number hashed from its id and the seed, so the draw is
the same on every run and every partitioning, and the expected mix is exact. The
document is exploded by its count, and the copies are dealt out and sorted by a
second hash: a global shuffle.

A Poisson of mean m is the sum of ``ceil(m / 16)`` Poissons of equal mean, so only means up
to 16 are ever inverted; for those P(X > 80) is below 2**-53 and the table of 81
probabilities covers every value of the 52-bit uniform number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import free_name
from lexiflow.operators.joins import broadcast_if_small, key_table_bytes
from lexiflow.session import materialize_measured

SEED = "mix-1"
TEMPERATURE = 0.5
EPOCHS = 1.0
STEP_MEAN = 16
MAX_DRAW = 80


def hash_unit(*parts: Column) -> Column:
    """Uniform double in (0, 1): 52 bits of the MD5 of the parts, the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_means(docs: DataFrame, source_col: str = "source", text_col: str = "text",
                 temperature: float = TEMPERATURE, epochs: float = EPOCHS,
                 weights: dict | None = None) -> tuple[DataFrame, int, int]:
    """Per source: ``volume``, ``weight`` (target share), ``mean`` repetitions; number of sources and bytes of their names.

    Without ``weights`` the target shares are volumes raised to ``temperature``,
    normalised; with them, a source not named has weight 0. A source
    without any text has mean 1 (repeating it cannot change the mix). Null is a
    source of its own.
    """
    volumes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.coalesce(F.length(F.col(text_col)), F.lit(0)).cast("long")).alias("volume"))
    if weights is None:
        raw = F.pow(F.col("volume").cast("double"), F.lit(float(temperature)))
    else:
        raw = F.lit(0.0)
        for name, w in weights.items():
            raw = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(raw)
    raw = F.when(F.col("volume") > 0, raw).otherwise(F.lit(0.0))
    # one row per source is written; the two totals are observed on the way
    rated, total = materialize_measured(volumes.withColumn("raw", raw), "source-volumes", {
        "volume": F.sum("volume"), "raw": F.sum("raw"), "n": F.count(F.lit(1)),
        "bytes": F.sum(F.octet_length(F.col("source").cast("string")).cast("long"))})
    share = F.col("raw") / F.lit(float(total["raw"])) if total["raw"] > 0 else F.lit(0.0)
    mean = F.lit(float(epochs)) * share * F.lit(float(total["volume"])) / F.col("volume")
    return rated.select(
        "source", "volume", share.alias("weight"),
        F.when(F.col("volume") > 0, mean).otherwise(F.lit(1.0)).alias("mean")), total["n"], total["bytes"]


def with_distribution(means: DataFrame) -> DataFrame:
    """Add ``steps`` and ``cdf`` (of one step's Poisson at 0..MAX_DRAW) to the means."""
    steps = F.greatest(F.lit(1), F.ceil(F.col("mean") / F.lit(float(STEP_MEAN)))).cast("int")
    fact = F.array(*[F.lit(float(math.factorial(k))) for k in range(MAX_DRAW + 1)])
    mean = F.col("step_mean")
    pmf = F.transform(F.sequence(F.lit(0), F.lit(MAX_DRAW)),
                      lambda k: F.exp(-mean) * F.pow(mean, k.cast("double")) / F.element_at(fact, k + 1))
    cdf = F.transform(F.sequence(F.lit(1), F.lit(MAX_DRAW + 1)), lambda k: F.aggregate(
        F.slice("pmf", F.lit(1), k), F.lit(0.0), lambda a, x: a + x))
    return (means.withColumn("steps", steps)
            .withColumn("step_mean", F.col("mean") / F.col("steps"))
            .withColumn("pmf", pmf).withColumn("cdf", cdf).drop("pmf", "step_mean"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", temperature: float = TEMPERATURE, epochs: float = EPOCHS,
        weights: dict | None = None, seed: str = SEED) -> DataFrame:
    """All columns of ``docs``, one row per drawn copy, plus ``_copies``, ``_copy`` (from 0), ``_key``.

    Rows are dealt out and sorted by ``_key``, a hash of seed, id and copy number.

    Defined cases: null source as in :func:`source_means`; a null id hashes as the empty
    string; repeated rows draw the same count each; null text has volume 0; an empty table gives an
    empty result. Input columns named like the three added ones are refused; any other name may be in use.
    """
    clash = {"_copies", "_copy", "_key"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are added by this operator")
    means, n_sources, name_bytes = source_means(docs, source_col, text_col, temperature, epochs, weights)
    src, steps, cdf = (free_name(docs, c) for c in ("_src", "_steps", "_cdf"))
    side = with_distribution(means).select(F.col("source").alias(src), F.col("steps").alias(steps),
                                           F.col("cdf").alias(cdf))
    side_bytes = key_table_bytes(n_sources, 1, name_bytes) + 8 * (MAX_DRAW + 3) * n_sources
    joined = docs.join(broadcast_if_small(side, known_rows=n_sources, known_bytes=side_bytes),
                       F.col(source_col).eqNullSafe(F.col(src)))
    # one uniform number per step, then its place in the distribution
    units = F.transform(F.sequence(F.lit(0), F.col(steps) - 1),
                        lambda i: hash_unit(F.lit(seed), F.col(id_col), i))
    draws = F.transform(units, lambda u: F.size(F.filter(cdf, lambda c: c <= u)))
    copies = F.aggregate(draws, F.lit(0), lambda a, x: a + x)
    key = hash_unit(F.lit(seed), F.lit("order"), F.col(id_col), F.col("_copy"))
    return (joined.withColumn("_copies", copies).drop(src, steps, cdf)
            .where(F.col("_copies") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
            .withColumn("_key", key)
            .repartition("_key").sortWithinPartitions("_key"))
