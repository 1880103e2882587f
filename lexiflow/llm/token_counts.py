"""Token counts by overlap resynchronisation.

A text longer than ``chunk_chars`` is encoded in chunks that overlap, each with
character offsets, and spliced at a boundary inside the overlap that the
whole text's encoding is proven to have:

* **word boundary**: a word mark preceded by anything else. No piece of the
  vocabulary holds a mark after another character (checked when the
  model is loaded), so no merge ever crosses such a place, whatever surrounds it;
* **common token**: a token that both chunks place at the same offsets, in the
  middle of a word. A byte-pair encoding is valid exactly if every pair
  of neighbouring tokens is valid on its own; left of the token the pairs
  come from the left chunk, right of it from the right one, so the spliced sequence
  is the encoding. This needs merges of distinct rank, so tokens
  with the mark, some of which tie, are not used.

When an overlap holds neither, it is doubled and the right chunk encoded again,
until it reaches back to the start of the left chunk, which is then simply encoded
together with the right one.
"""

from __future__ import annotations

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import text_or_empty, text_udf

CONTEXT_TOKENS = 4096
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
MARK = "▁"
_MARKS = (" ", MARK)


class ResyncCounter:
    """Counts tokens of texts of any length with one loaded model."""

    def __init__(self, model_path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        if not 0 < overlap < chunk:
            raise ValueError("need 0 < overlap < chunk")
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        self.mark_cuts = not any(MARK in p.lstrip(MARK) for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        short = [t for t in texts if len(t) <= self.chunk]
        known = iter(self.sp.encode(short, num_threads=1)) if short else iter(())
        return [len(next(known)) if len(t) <= self.chunk else self._long(t) for t in texts]

    def _encode(self, text: str, lo: int, hi: int) -> list[tuple[int, int]]:
        """(begin, end) in the whole text of every token of ``text[lo:hi]``."""
        got = self.sp.encode(text[lo:hi], return_type="offset_mapping")["offsets"]
        return [(lo + b, lo + e) for b, e in got]

    def _splice(self, text: str, left: list, right: list, lo: int, hi: int) -> int | None:
        """A proven boundary of the whole encoding in ``(lo, hi)``, the middlemost, or None."""
        middle = (lo + hi) // 2
        starts = {b for b, _ in left} & {b for b, _ in right}
        if self.mark_cuts:
            cuts = [p for p in starts
                    if lo < p < hi and text[p] in _MARKS and text[p - 1] not in _MARKS]
            if cuts:
                return min(cuts, key=lambda p: (abs(p - middle), p))
        shared = set(left) & set(right)
        cuts = [b for b, e in shared if lo < b < e < hi and text[b - 1] not in _MARKS
                and not any(m in text[b:e] for m in _MARKS)]
        return min(cuts, key=lambda p: (abs(p - middle), p)) if cuts else None

    def _long(self, text: str) -> int:
        n = len(text)
        total, start, end = 0, 0, min(n, self.chunk)
        left = self._encode(text, 0, end)
        kept = 0  # tokens of `left` before this offset belong to an earlier chunk
        while end < n:
            overlap, cut = self.overlap, None
            while cut is None:
                lo = max(end - overlap, kept)
                hi = min(n, end + self.chunk)
                if lo <= kept:
                    break
                right = self._encode(text, lo, hi)
                cut = self._splice(text, left, right, lo, end)
                if cut is None:
                    overlap *= 2
                    self.widened += 1
            if cut is None:
                # no boundary is proven: the left chunk grows by the right one
                end = min(n, end + self.chunk)
                left = self._encode(text, start, end)
                continue
            total += sum(kept <= b < cut for b, _ in left)
            left, start, kept, end = right, lo, cut, hi
        return total + sum(b >= kept for b, _ in left)


_LOADED: dict = {}


def _counter(model_path: str, chunk: int, overlap: int) -> ResyncCounter:
    key = (model_path, chunk, overlap)
    if key not in _LOADED:
        _LOADED[key] = ResyncCounter(model_path, chunk, overlap)
    return _LOADED[key]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text", context: int = CONTEXT_TOKENS,
                 chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``context``).

    ``model_path`` names a sentencepiece model readable on every executor. Nothing
    is shuffled; a worker holds one text slice and its tokens.

    Defined cases: null text counts as empty (0 bytes, 0 tokens); null ids and repeated
    rows come out as they went in; an empty table gives an empty result; other columns are
    not read.
    """
    def batch(texts):
        return _counter(model_path, chunk, overlap).counts(texts)

    text = text_or_empty(text_col)
    return (docs.select(F.col(id_col).alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                        text_udf(batch, "long")(text).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > context))
