"""Quality classifier by co-training.

Two views of a document are learnt separately: its text (hashed features of its distinct
words and of its shape) and its page metadata (language, source, length). Both
start from the labelled sample; in every round each view labels the unlabelled pool, and its
most confident labels join the other view's training set. A view that is never that sure, as metadata that says
little, teaches nothing; what was passed in each round is kept with the model. Each view is then calibrated on
held-out labelled rows, and a logistic combination of the two calibrated views, fitted on
the same rows, scores every document.

A document is good if its labels say quality 1 and not toxic, bad if they say quality 0 or
toxic. The fit sees a bounded sample (``labelled`` and ``pool`` rows, chosen by a hash of the
id). Which text features tell the classes apart is counted in Spark; only those of the sample
travel to the driver. Scoring is a scan of all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.llm.common import give_back_memory, text_or_empty
from lexiflow.session import materialize

LABELLED = 12_000
POOL = 6_000
ROUNDS = 3
#: share of the pool that a view may label per round and class, most confident first
CONFIDENT_SHARE = 0.1
#: least probability of a label that is passed on
CONFIDENT = 0.98
THRESHOLD = 0.5
SEED = 17
BUCKETS = 1 << 20
#: a feature is used if it is in so many training rows and its share of bad rows is off by so many
#: standard deviations
LEAST_ROWS = 5
LEAST_Z = 2.5
RIDGE = 1e-4
STEPS = 150
_EDGE = re.compile(r"^[^\w]*(.*?)([^\w]*)$", re.DOTALL)


# ---- features

def _bucket(kind: str, value: str) -> int:
    return zlib.crc32((kind + value).encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def word_features(word: str) -> list[int]:
    """Buckets of one distinct word: itself, its beginning, its trailing signs, its case."""
    core, tail = _EDGE.match(word).groups()
    low = core.lower()
    out = [_bucket("w:", low)]
    if len(low) >= 5:
        out.append(_bucket("p:", low[:5]))
    if tail:
        out.append(_bucket("t:", tail[:4]))
    if len(core) >= 2 and core.isupper():
        out.append(_bucket("c:", "upper"))
    return out


def shape_features(text: str, words: list[str], n_distinct: int) -> list[int]:
    """Buckets of a text's shape: size, repetition, share of ASCII signs, word length."""
    n = len(words)
    size = int(math.log2(n + 1))
    if not n:
        return [_bucket("size:", "0")]
    chars = sum(map(len, words))
    signs = len(text) - len(text.translate(_SIGNS))
    return [_bucket("size:", str(size)), _bucket("distinct:", f"{size}:{20 * n_distinct // n}"),
            _bucket("signs:", str(20 * signs // chars)), _bucket("length:", str(min(40, chars // n)))]


_SIGNS = {c: None for c in range(33, 127) if not chr(c).isalnum()}


def text_features(text: str) -> list[int]:
    words = text.split()
    distinct = set(words)
    out = shape_features(text, words, len(distinct))
    for w in distinct:
        out.extend(word_features(w))
    return out


def meta_features(lang, source, n_chars) -> list[int]:
    size = "none" if n_chars is None or n_chars != n_chars else str(int(math.log2(max(0, n_chars) + 1)))
    return [_bucket("lang:", str(lang)), _bucket("source:", str(source)), _bucket("chars:", size),
            _bucket("both:", f"{lang}:{size}")]


class TextScorer:
    """Sum of the weights of a text's features; words seen before are looked up."""

    CACHE = 400_000

    def __init__(self, weights: dict[int, float]):
        self.weights, self.cache = weights, {}

    def __call__(self, text: str) -> float:
        get, cache = self.weights.get, self.cache
        words = text.split()
        distinct = set(words)
        z = sum(get(i, 0.0) for i in shape_features(text, words, len(distinct)))
        for w in sorted(distinct):  # a fixed order of adding, so equal texts get equal scores
            v = cache.get(w)
            if v is None:
                if len(cache) >= self.CACHE:
                    cache.clear()
                v = cache[w] = sum(get(i, 0.0) for i in word_features(w))
            if v:
                z += v
        return z


# ---- fitting (bounded sample, on the driver)

def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class View:
    """A linear classifier over hashed features, and its calibration."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        dense = np.zeros(BUCKETS)
        dense[list(self.weights)] = list(self.weights.values())
        return np.array([dense[r].sum() for r in rows]) + self.bias

    def calibrated(self, margin):
        return self.scale * margin + self.shift


def fit_view(rows: list[np.ndarray], good: np.ndarray) -> View:
    """Ridge logistic regression with balanced classes."""
    bad = 1.0 - good
    share = bad.mean()
    if not 0 < share < 1:
        return View(bias=4.0 if share == 0 else -4.0)
    of_row = np.repeat(np.arange(len(rows), dtype=np.int64), [len(r) for r in rows])
    idx = np.concatenate(rows)
    used = np.unique(idx)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    at = place[idx]
    balance = np.where(good > 0, 0.5 / (1 - share), 0.5 / share)
    # Adam on the full sample; the last weight is the bias
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    for t in range(1, STEPS + 1):
        margin = np.bincount(of_row, w[at], minlength=len(rows)) + w[-1]
        g = (_sigmoid(margin) - good) * balance
        grad = np.append(np.bincount(at, g[of_row], minlength=len(used)) / len(rows) + RIDGE * w[:-1],
                         g.mean())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return View(dict(zip(used.tolist(), w[:-1].tolist(), strict=True)), float(w[-1]))


def fit_logistic(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Coefficients (last: constant) of a small logistic regression, by damped Newton steps.

    Targets are drawn in from 0 and 1 as in Platt's method, so separable rows have a finite fit.
    """
    n_good, n_bad = good.sum(), len(good) - good.sum()
    target = np.where(good > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = _sigmoid(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(a.shape[1])
        w += np.clip(np.linalg.solve(h, a.T @ (target - p) - 1e-3 * w), -2, 2)
    return w


@dataclass
class CoTrained:
    text: View
    meta: View
    combine: tuple[float, float, float]
    #: (round, from, to, class, labels passed that the other view did not have)
    passed: list[tuple[int, str, str, str, int]] = field(default_factory=list)

    def combined(self, text_logit, meta_logit):
        a, b, c = self.combine
        return a * text_logit + b * meta_logit + c


NAMES = ("text", "meta")


def co_train(text_rows: list[np.ndarray], meta_rows: list[np.ndarray], label: np.ndarray,
             held_out: np.ndarray, rounds: int = ROUNDS, share: float = CONFIDENT_SHARE,
             confident: float = CONFIDENT) -> CoTrained:
    """Fit both views and their combination; ``label`` is 1, 0 or NaN (pool), ``held_out`` a mask."""
    train = np.flatnonzero(~np.isnan(label) & ~held_out)
    held = np.flatnonzero(~np.isnan(label) & held_out)
    pool = np.flatnonzero(np.isnan(label))
    if not len(train):
        return CoTrained(View(bias=4.0), View(bias=4.0), (0.5, 0.5, 0.0))
    if len(held) < 20 or len(set(label[held])) < 2:
        held = train
    views = [text_rows, meta_rows]
    taught = [{int(i): float(label[i]) for i in train} for _ in views]
    fitted: list[View] = []
    passed: list = []
    for turn in range(rounds + 1):
        fitted = []
        for rows, known in zip(views, taught, strict=True):
            at = np.fromiter(known, np.int64)
            view = fit_view([rows[i] for i in at], np.array([known[i] for i in at]))
            scale, shift = fit_logistic(view.margins([rows[i] for i in held])[:, None], label[held])
            view.scale, view.shift = float(max(scale, 0.0)), float(shift)
            fitted.append(view)
        if turn == rounds or not len(pool):
            break
        # each view hands its surest labels to the other one
        for me, other in ((0, 1), (1, 0)):
            # of those that the other view does not have yet
            new = np.array([i for i in pool.tolist() if i not in taught[other]], np.int64)
            p = _sigmoid(fitted[me].calibrated(fitted[me].margins([views[me][i] for i in new])))
            for value, sure in ((1.0, p), (0.0, 1 - p)):
                best = np.argsort(-sure, kind="stable")[:int(share * len(pool))]
                before = len(taught[other])
                for i in new[best[sure[best] >= confident]]:
                    taught[other].setdefault(int(i), value)
                passed.append((turn + 1, NAMES[me], NAMES[other], "good" if value else "bad",
                               len(taught[other]) - before))
    x = np.column_stack([v.calibrated(v.margins([rows[i] for i in held]))
                         for v, rows in zip(fitted, views, strict=True)])
    a, b, c = fit_logistic(x, label[held])
    return CoTrained(*fitted, (float(a), float(b), float(c)), passed)


# ---- Spark

def document_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per labelled id: label 1.0 (good) or 0.0 (bad).

    Any bad label makes a document bad; good needs both labels known. Ids with neither, and null
    ids, are left out.
    """
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int"))
    known = F.max(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int"))
    return (labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(bad.alias("bad"), known.alias("good"))
            .select(id_col, F.when(F.col("bad") == 1, 0.0).when(F.col("good") == 1, 1.0).alias("label"))
            .where(F.col("label").isNotNull()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", chars_col: str = "n_chars",
        labelled: int = LABELLED, pool: int = POOL, rounds: int = ROUNDS) -> CoTrained:
    """Fit on at most ``labelled`` labelled and ``pool`` unlabelled documents of ``docs``."""
    docs = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(chars_col).cast("double").alias("n_chars"))
    known = document_labels(labels, id_col).withColumnRenamed(id_col, "_id")
    order = F.xxhash64(F.col("_id"), F.lit(SEED))
    ids = docs.where(F.col("_id").isNotNull()).select("_id").distinct()
    some = known.join(ids, "_id", "left_semi").orderBy(order, "_id").limit(labelled)
    rest = (ids.join(known.select("_id"), "_id", "left_anti").orderBy(order, "_id").limit(pool)
            .select("_id", F.lit(None).cast("double").alias("label")))
    wanted = some.unionByName(rest)

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(text_features(t), np.int32) for t in texts])

    # a quarter of the labelled rows is held out of the training
    held = F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(4)) == 0
    # at most labelled + pool rows: of several rows with one id the first text, then the first metadata
    nth = Window.partitionBy("_id").orderBy("_text", "lang", "source", "n_chars")
    chosen = (docs.join(F.broadcast(wanted), "_id").withColumn("_nth", F.row_number().over(nth))
              .where("_nth = 1"))
    sample = materialize(
        chosen.select("_id", "label", held.alias("held"), hashed("_text").alias("f"), "lang", "source", "n_chars"),
        "labelled-sample")
    telling = telling_features(sample.where(F.col("label").isNotNull() & ~F.col("held")))

    @F.pandas_udf("array<int>")
    def only_telling(features: pd.Series) -> pd.Series:
        return pd.Series([f[np.isin(f, telling)] for f in features])

    # one flat array of feature numbers; the rows are views on it
    got = sample.withColumn("f", only_telling("f")).toArrow()
    order = np.argsort(got["_id"].to_numpy(), kind="stable")
    features = got["f"].combine_chunks()
    flat, ends = features.values.to_numpy(), features.offsets.to_numpy()
    text_rows = [flat[ends[i]:ends[i + 1]] for i in order]
    meta = list(zip(*(got[c].to_pylist() for c in ("lang", "source", "n_chars")), strict=True))
    meta_rows = [np.array(meta_features(*meta[i]), np.int32) for i in order]
    label = got["label"].to_numpy().astype(np.float64)
    model = co_train(text_rows, meta_rows, label[order], got["held"].to_numpy()[order], rounds)
    del got, features, flat, ends, text_rows, meta, meta_rows
    give_back_memory()
    return model


def telling_features(train: DataFrame) -> np.ndarray:
    """Buckets in at least LEAST_ROWS rows whose share of bad rows is off by LEAST_Z deviations.

    The result is a subset of the BUCKETS numbers, a few thousand in practice.
    """
    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("label")).alias("bad")).first()
    if not total["n"]:
        return np.empty(0, np.int32)
    share = total["bad"] / total["n"]
    n, bad = F.col("n"), F.col("bad")
    off = F.abs(bad - n * F.lit(share)) / F.sqrt(n * F.lit(share * (1 - share)) + F.lit(1e-9))
    got = (train.select((1 - F.col("label")).alias("bad"), F.explode(F.array_distinct("f")).alias("f"))
           .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
           .where((n >= LEAST_ROWS) & (off >= LEAST_Z)).select("f").toPandas())
    return np.sort(got["f"].to_numpy(np.int32))


def with_scores(docs: DataFrame, model: CoTrained, out_col: str = "scores", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with a struct column (p_text, p_meta, score): probabilities of being good."""
    if out_col in docs.columns:
        raise ValueError(f"column {out_col} is added by this operator")
    state: dict = {}

    @F.pandas_udf("p_text double, p_meta double, score double")
    def score(text: pd.Series, lang: pd.Series, source: pd.Series, chars: pd.Series) -> pd.DataFrame:
        if "text" not in state:
            state["text"] = TextScorer(model.text.weights)
        get = model.meta.weights.get
        zt = np.fromiter(map(state["text"], text), np.float64, len(text)) + model.text.bias
        zm = np.array([sum(get(i, 0.0) for i in meta_features(*m))
                       for m in zip(lang, source, chars, strict=True)], np.float64) + model.meta.bias
        lt, lm = model.text.calibrated(zt), model.meta.calibrated(zm)
        return pd.DataFrame({"p_text": _sigmoid(lt), "p_meta": _sigmoid(lm),
                             "score": _sigmoid(model.combined(lt, lm))})

    return docs.withColumn(out_col, score.asNondeterministic()(
        text_or_empty(text_col), F.col(lang_col).cast("string"), F.col(source_col).cast("string"),
        F.col(chars_col).cast("double")))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per row: id, p_text, p_meta, score, keep (score at or above the threshold).

    Defined cases: null texts count as empty, null metadata is a value of its own; null ids are scored
    but never in the sample; repeated rows come out as often as they went in; equal
    rows get equal scores; without any labelled document every score is above one half; an empty table gives an
    empty result; other columns are not read.
    """
    cols = [options.get(k, v) for k, v in (("text_col", "text"), ("lang_col", "lang"),
                                           ("source_col", "source"), ("chars_col", "n_chars"))]
    scored = with_scores(docs.select(id_col, *cols), fit(docs, labels, id_col, **options), "_s", *cols)
    return scored.select(id_col, "_s.*").withColumn("keep", F.col("score") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that score at or above the threshold; all columns."""
    return (with_scores(docs, fit(docs, labels, id_col, **options), "_s")
            .where(F.col("_s.score") >= threshold).drop("_s"))
