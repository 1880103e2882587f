"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are folded (lower case, every run of other than letters and
digits becomes one space). A passage within ``e`` edits of an item of length m shares at least
``m + 1 - q - q * e`` of the item's q-grams with it, and their diagonals (text position
minus item position) span at most e. So q-gram hits are counted per text and item in
overlapping diagonal bands: a band starts every ``e + 1`` diagonals and is twice as wide, so any
alignment lies wholly in one. Bands that reach the bound are regions; a region is
confirmed by aligning the whole item to it in a band of that width, free ends in the text,
with at most e edits.

An item is compared as a whole, or in overlapping segments of ``segment`` characters if it is longer, and
also in passages: every ``stride``-th run of ``passage`` characters, and the last one. A verbatim
quote of ``passage + stride - 1`` characters holds a whole passage, wherever it begins.

Items of a benchmark may share phrases ("which of the following statements is true about"). A q-gram found in more
than ``COMMON_ITEMS`` different items is common. Common grams are no evidence for a passage, which must meet its bound with
the others, so a text that shares only such a phrase with an item matches nothing. For whole items
they are evidence but need no index: of the grams an item must share, at most its common ones are common, so the
bound less their number is asked of the others; only an item for which nothing would be left keeps all.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import slices, text_or_empty

Q = 10
EDIT_RATE = 0.06
SEGMENT = 512
#: a quote of part of an item counts from this many folded characters on; passages begin every STRIDE
PASSAGE = 50
STRIDE = 10
#: the index of one pass over the texts holds at most this many benchmark q-grams
INDEX_GRAMS = 4_000_000
#: a q-gram in more than this many different items is common to the benchmark
COMMON_ITEMS = 4
#: cells of the alignment tables held at once
ALIGN_CELLS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22
MATCHES = "array<struct<item_id:long,edits:int,start:long,end:long,size:int>>"
_OTHER = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def edit_budget(length: int, rate: float) -> int:
    return int(rate * length)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Polynomial hash of every q-gram of a code point array, by doubling."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    width = 1
    h = codes.astype(np.uint64) + np.uint64(1)
    out, done = None, 0
    rest = q
    while rest:
        if rest & 1:
            if out is None:
                out, done = h, width
            else:
                n = min(len(out), len(h) - done)
                out = out[:n] + _pow(_BASE, done) * h[done:done + n]
                done += width
        rest >>= 1
        if rest:
            h = h[:-width] + _pow(_BASE, width) * h[width:]
            width *= 2
    return out[:len(codes) - q + 1]


def _pow(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _FILTER_BITS)


def segments(item: str, q: int, segment: int) -> list[str]:
    """Folded segments of one item; half a segment of overlap, none shorter than q."""
    text = fold(item)
    if len(text) <= segment:
        return [text] if len(text) >= q else []
    step = segment // 2
    return [text[max(0, min(i, len(text) - segment)):][:segment]
            for i in range(0, len(text) - step, step)]


def passages(item: str, passage: int, stride: int) -> list[str]:
    """Folded passages of an item longer than ``passage``."""
    text = fold(item)
    last = len(text) - passage
    if last <= 0:
        return []
    return [text[i:i + passage] for i in [*range(0, last, stride), last]]


def gram_size(length: int, q: int, rate: float) -> int:
    """q, or less where a match within the budget need not share one gram of that size."""
    return min(q, length // (1 + edit_budget(length, rate)))


def common_grams(texts: list[str], q: int, most: int = COMMON_ITEMS) -> np.ndarray:
    """Sorted hashes of the q-grams that more than ``most`` of the different ``texts`` hold."""
    per_text = [np.unique(gram_hashes(_codes(t), q)) for t in set(texts)]
    if not per_text:
        return np.empty(0, np.uint64)
    grams, n = np.unique(np.concatenate(per_text), return_counts=True)
    return grams[n > most]


class GramIndex:
    """The q-grams of a set of benchmark parts with their places.

    ``items`` are (owner, text), the owner an item id or a list of them; ``passage`` tells which texts
    are passages (default: none), ``common`` the hashes of common grams.
    """

    def __init__(self, items: list[tuple], q: int, rate: float, passage: list[bool] | None = None,
                 common: np.ndarray | None = None):
        self.q, self.rate = q, rate
        self.items = items
        self.length = np.array([len(t) for _, t in items], np.int64)
        self.budget = np.array([edit_budget(len(t), rate) for _, t in items], np.int64)
        # a bound below one shared gram would let every text through; one gram is then asked for
        self.bound = np.maximum(1, self.length + 1 - q - q * self.budget)
        grams = [gram_hashes(_codes(t), q) for _, t in items]
        places = [np.arange(len(g)) for g in grams]
        if common is not None and len(common):
            for i, g in enumerate(grams):
                own = ~np.isin(g, common)
                left = int(self.bound[i]) - int((~own).sum())
                if passage is not None and passage[i]:
                    grams[i], places[i] = g[own], places[i][own]
                elif left >= 1:
                    grams[i], places[i], self.bound[i] = g[own], places[i][own], left
        h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate(places) if grams else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.h, self.owner, self.place = h[order], owner[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[_slot(self.h)] = True

    def regions(self, codes: np.ndarray, doc_of) -> np.ndarray:
        """Rows (text, item, first diagonal) of bands that meet the bound; a band is two budgets and two wide."""
        g = gram_hashes(codes, self.q)
        pos = np.flatnonzero(self.filter[_slot(g)])
        lo = np.searchsorted(self.h, g[pos], side="left")
        hi = np.searchsorted(self.h, g[pos], side="right")
        n = hi - lo
        pos, lo, n = pos[n > 0], lo[n > 0], n[n > 0]
        out = [np.empty((0, 3), np.int64)]
        # in runs of a bounded number of hits; a text is never divided between runs
        docs = doc_of(pos)
        ends = np.flatnonzero(np.diff(docs, append=-1)) + 1
        at = 0
        while at < len(pos):
            total = np.cumsum(n[at:])
            stop = ends[ends > at]
            fit = stop[total[stop - at - 1] <= 2_000_000]
            to = int(fit[-1]) if len(fit) else int(stop[0])
            out.append(self._bands(pos[at:to], docs[at:to], lo[at:to], n[at:to]))
            at = to
        return np.concatenate(out)

    def _bands(self, pos, docs, lo, n):
        k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item = self.owner[k]
        diagonal = np.repeat(pos, n) - self.place[k]
        width = self.budget[item] + 1
        band = diagonal // width
        doc = np.repeat(docs, n)
        doc, item, band = (np.concatenate([doc, doc]), np.concatenate([item, item]),
                           np.concatenate([band, band - 1]))
        order = np.lexsort((band, item, doc))
        doc, item, band = doc[order], item[order], band[order]
        new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0)
                             | (np.diff(band, prepend=band[:1] - 1) != 0))
        count = np.diff(np.append(new, len(doc)))
        new = new[count >= self.bound[item[new]]]
        return np.stack([doc[new], item[new], band[new] * (self.budget[item[new]] + 1)], axis=1)


def align_all(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, items: np.ndarray, first: np.ndarray,
              width: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the best alignment of all of each item on ``width`` diagonals from ``first`` on.

    Row r aligns ``items[r]`` with ``codes[begin[r]:end[r]]``, free ends in the text; all items have one length.
    The tables of all rows are filled together: row i holds, for diagonal d, the edits of item[:i] against text
    ending at i + d. Edits beyond the item's length mean that no alignment lies on these diagonals.
    """
    m = items.shape[1]
    d = np.arange(width)
    big = 2 * m + 2
    at = first[:, None] + d[None, :]
    lo, hi = begin[:, None], end[:, None]
    row = np.where((at >= lo) & (at <= hi), 0, big)
    for i in range(m):
        here = np.clip(at + i, 0, len(codes) - 1)
        new = row + (codes[here] != items[:, i, None])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        inside = (at + i + 1 >= lo) & (at + i + 1 <= hi)
        new = np.where(inside, new, big)
        # a step along the text costs one per diagonal
        new = np.minimum.accumulate(new - d, axis=1) + d
        row = np.where(inside, new, big)
    best = row.argmin(axis=1)
    return row[np.arange(len(row)), best], m + first + best


def start_of(text: str, item: str, end: int, edits: int) -> int:
    """Where the part of ``text`` ending at ``end`` begins that is within ``edits`` of ``item``; the nearest to its length."""
    last = text[max(0, end - len(item) - edits):end][::-1]
    row = list(range(len(last) + 1))
    for i, c in enumerate(reversed(item), 1):
        new = [i]
        for j, t in enumerate(last, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    fits = [j for j, v in enumerate(row) if v <= edits]
    return end - min(fits, key=lambda j: (abs(j - len(item)), j))


def _owners(owner) -> list[int]:
    return owner if isinstance(owner, list) else [owner]


def find_matches(texts: list[str], indexes) -> list[list[dict]]:
    """Per text, its best confirmed match with every benchmark item; places in the folded text.

    Best is the longest part of the item, then fewest edits, then the first place.
    """
    indexes = [indexes] if isinstance(indexes, GramIndex) else indexes
    folded = [fold(t) for t in texts]
    starts = np.cumsum([0] + [len(t) + 1 for t in folded])
    # texts are joined by a character that folding removes, so no gram crosses it unseen
    codes = _codes("\x00".join(folded))

    def doc_of(pos):
        return np.searchsorted(starts, pos, side="right") - 1

    met = [(int(index.length[part]), doc, part, first, index)
           for index in indexes for doc, part, first in index.regions(codes, doc_of).tolist()]
    by_size: dict[int, list] = {}
    for region in met:
        by_size.setdefault(region[0], []).append(region)
    found: list[dict[int, dict]] = [{} for _ in texts]
    # longest parts first: a shorter part of an item already found is not aligned
    for size in sorted(by_size, reverse=True):
        todo = [r for r in by_size[size] if any(
            found[r[1]].get(o, {"size": 0})["size"] <= size for o in _owners(r[4].items[r[2]][0]))]
        budget = edit_budget(size, indexes[0].rate)
        width = 2 * (budget + 1)
        rows = max(1, ALIGN_CELLS // max(width, size))
        for at in range(0, len(todo), rows):
            _confirm(todo[at:at + rows], codes, folded, starts, size, budget, width, found)
    return [[m[k] for k in sorted(m)] for m in found]


def _confirm(regions, codes, folded, starts, size, budget, width, found) -> None:
    """Align regions of one part length and keep each item's best match per text."""
    docs = np.array([r[1] for r in regions])
    items = np.stack([_codes(r[4].items[r[2]][1]) for r in regions])
    edits, ends = align_all(codes, starts[docs], starts[docs + 1] - 1, items, np.array([r[3] for r in regions]), width)
    best: dict[tuple, tuple] = {}
    for i in np.flatnonzero(edits <= budget).tolist():
        _, doc, part, _, index = regions[i]
        key = (doc, part, id(index))
        best[key] = min(best.get(key, (budget + 1, 0)), (int(edits[i]), int(ends[i] - starts[doc])))
    by_id = {id(r[4]): r[4] for r in regions}
    for (doc, part, index), (n, end) in best.items():
        owner, item = by_id[index].items[part]
        start = start_of(folded[doc], item, end, n) if n else end - size
        for item_id in _owners(owner):
            old = found[doc].get(item_id)
            if old is None or (-size, n, start) < (-old["size"], old["edits"], old["start"]):
                found[doc][item_id] = {"item_id": item_id, "edits": n, "start": start, "end": end, "size": size}


def benchmark_parts(items: list[tuple[int, str]], q: int, segment: int, passage: int,
                    stride: int) -> list[tuple[list[int], str, bool]]:
    """(item ids, text, is it a passage) of everything items are compared by, each text once per kind."""
    whole: dict[str, dict] = {}
    part: dict[str, dict] = {}
    for item_id, text in items:
        own = segments(text, q, segment)
        for t in own:
            whole.setdefault(t, {})[item_id] = None
        for t in passages(text, passage, stride):
            if t not in own:
                part.setdefault(t, {})[item_id] = None
    return [(sorted(ids), t, kind) for kind, texts in ((False, whole), (True, part)) for t, ids in texts.items()]


def _passes(parts: list[tuple[list[int], str, bool]], index_grams: int):
    """The parts in passes of at most ``index_grams`` q-grams each."""
    held, grams = [], 0
    for part in parts:
        if held and grams + len(part[1]) > index_grams:
            yield held
            held, grams = [], 0
        held.append(part)
        grams += len(part[1])
    yield held


def with_matches(docs: DataFrame, benchmark: DataFrame, out_col: str = "matches",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 q: int = Q, rate: float = EDIT_RATE, segment: int = SEGMENT, passage: int = PASSAGE,
                 stride: int = STRIDE, index_grams: int = INDEX_GRAMS) -> DataFrame:
    """``docs`` with a column of matches (item_id, edits, start, end; places in the folded text).

    A match is that of the longest part of the item found: the whole item or segment, else a passage of
    ``passage`` characters with at most ``rate`` edits.

    The benchmark is the small, held-out side and goes through the driver as a whole: its parts are cut into
    passes of at most ``index_grams`` q-grams (about 100 MB), each shipped with the scan of the texts as one
    UDF. All UDFs of the scan run in one worker, so a worker holds the indexes of all passes. The texts
    are not shuffled.

    Defined cases: null or empty texts and items match nothing; an item shorter than q folded
    characters is too short to be evidence and matches nothing; items with a null id are not used;
    repeated items count as one, repeated texts each for itself; of items with equal parts each is
    reported; a passage that is common to more than ``COMMON_ITEMS`` items is no evidence (a whole item is); empty tables on either side give empty
    matches; an input column named ``out_col`` is refused.
    """
    if out_col in docs.columns:
        raise ValueError(f"column {out_col} is added by this operator")
    if passage + 1 - q - q * edit_budget(passage, rate) < 1:
        raise ValueError(f"a passage of {passage} characters may share no {q}-gram with its quote")
    rows = (benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             text_or_empty(item_text_col).alias("text"))
            .where(F.col("item_id").isNotNull()).distinct())
    items = [(r.item_id, r.text) for r in rows.orderBy("item_id", "text").toLocalIterator()]
    folded = [fold(t) for _, t in items]
    common = {n: common_grams(folded, n) for n in {gram_size(len(t), q, rate) for t in folded} if n}
    parts = [_matcher(held, q, rate, common)(text_or_empty(text_col))
             for held in _passes(benchmark_parts(items, q, segment, passage, stride), index_grams)]
    # one UDF column is read twice if its fields are picked at once, so the size goes in a step of its own
    found = docs.withColumn(out_col, parts[0] if len(parts) == 1 else F.flatten(F.array(*parts)))
    return found.withColumn(out_col, _best_per_item(F.col(out_col)))


def _best_per_item(matches):
    """Of an item that matched in several passes, the longest match, then fewest edits, then the first."""
    def best(item):
        m = F.array_min(F.transform(F.filter(matches, lambda x: x.item_id == item), lambda x: F.struct(
            (-x["size"]).alias("size"), x.edits.alias("edits"), x.start.alias("start"), x.end.alias("end"))))
        return F.struct(item.alias("item_id"), m.edits.alias("edits"), m.start.alias("start"), m.end.alias("end"))

    return F.transform(F.array_distinct(F.transform(matches, lambda x: x.item_id)), best)


def build_indexes(held: list[tuple[list[int], str, bool]], q: int, rate: float,
                  common: dict[int, np.ndarray]) -> list[GramIndex]:
    """One index per gram size that the parts need."""
    by_size: dict[int, list] = {}
    for part in held:
        by_size.setdefault(gram_size(len(part[1]), q, rate), []).append(part)
    return [GramIndex([(ids, t) for ids, t, _ in parts], n, rate, [kind for _, _, kind in parts], common.get(n))
            for n, parts in sorted(by_size.items())]


def _matcher(held: list[tuple[list[int], str, bool]], q: int, rate: float, common: dict[int, np.ndarray]):
    state: dict = {}

    @F.pandas_udf(MATCHES)
    def matches(texts: pd.Series) -> pd.Series:
        if "indexes" not in state:
            state["indexes"] = build_indexes(held, q, rate, common)
        out: list = []
        for part in slices(texts.tolist()):
            out.extend(find_matches(part, state["indexes"]) if state["indexes"] else [[] for _ in part])
        return pd.Series(out, dtype=object)

    return matches.asNondeterministic()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per confirmed (document, item): id, item_id, edits, start, end."""
    found = with_matches(docs.select(id_col, options.get("text_col", "text")), benchmark,
                         "_matches", **options)
    return (found.where(F.size("_matches") > 0)
            .select(id_col, F.explode("_matches").alias("m")).select(id_col, "m.*"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any match; all columns."""
    return (with_matches(docs, benchmark, "_matches", **options)
            .where(F.size("_matches") == 0).drop("_matches"))
