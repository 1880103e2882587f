"""Token-id output: best-fit-decreasing packing into fixed-length rows.

Texts are tokenised in the scan; a document longer than a row is cut
losslessly into row-length segments and a rest. Segments are packed
longest first, each into the open row with the least free space that
still holds it, found by a segment tree over free capacities. Packing is done per
run of about ``run_tokens`` tokens of a partition, so nothing is
shuffled and a worker holds one run; the free space lost is at most what one
run's last rows leave open.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import slices, text_or_empty

SEQ_LEN = 2048
RUN_TOKENS = 1 << 21
PAD_ID = 50256

SCHEMA = ("pack_id long, n_tokens int, n_segments int, input_ids array<int>, "
          "position_ids array<int>, cu_seqlens array<int>, doc_ids array<long>, "
          "doc_offsets array<long>, segment_starts array<int>")


class CapacityTree:
    """Open rows by free capacity; ``take(n)`` gives the fullest row with ``n`` free or None."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, capacity.bit_length())
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = [0] * (2 * self.size)

    def _add(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free capacity, row) of the smallest capacity >= need, removed from the tree."""
        count, node = self.count, need + self.size
        if not count[node]:
            # climb until a right sibling holds a row, then go down its leftmost path
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        free = node - self.size
        row = self.rows[free].pop()
        self._add(free, -1)
        return free, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Row number of every segment; segments are at most ``capacity`` long and not empty."""
    out = np.empty(len(lengths), np.int64)
    tree = CapacityTree(capacity)
    rows = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            free, row = capacity, rows
            rows += 1
        else:
            free, row = found
        out[i] = row
        if free > n:
            tree.put(free - n, row)
    return out


_LOADED: dict = {}


def rank_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-pair encoding of a rank file (lines of base64 token and rank)."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})
    return _LOADED[path]


#: what the pattern's ``\\s`` matches, in runs too long for its look-ahead
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
#: a pattern that ends so takes a run of white space as one piece, up to the character before a word
_SPACE_RULE = r"|\s+(?!\S)|\s+"


def encode_text(encoding: tiktoken.Encoding, pattern: str, text: str) -> list[int]:
    """The ids of ``encoding.encode_ordinary(text)``, for runs of white space of any length.

    The look-ahead of the pattern's rule for white space overflows the matcher's stack on runs of some
    hundred thousand characters. A long run is cut out as the piece that the rule makes of it: all of it at the end of the
    text, else all but its last character, which begins the next piece. What stands before it ends
    at the run in any case.
    """
    if not pattern.endswith(_SPACE_RULE):
        return encoding.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for run in _LONG_SPACE.finditer(text):
        out += encoding.encode_ordinary(text[at:run.start()])
        at = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding._encode_single_piece(text[run.start():at].encode("utf-8"))
    return out + encoding.encode_ordinary(text[at:])


def _lists(values: np.ndarray, lengths: np.ndarray, kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def pack_run(ids: list, known: list[bool], tokens: list[np.ndarray], seq_len: int,
             first_pack: int, pad_id: int) -> pa.RecordBatch:
    """Pack one run of documents; ``known`` tells which ids are not null."""
    n_tok = np.fromiter(map(len, tokens), np.int64, len(tokens))
    pieces = -(-n_tok // seq_len)
    doc = np.repeat(np.arange(len(tokens)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    offset = nth * seq_len
    length = np.minimum(seq_len, n_tok[doc] - offset)
    row = best_fit_decreasing(length, seq_len)
    n_rows = int(row.max()) + 1 if len(row) else 0
    order = np.argsort(row, kind="stable")  # within a row, in document order
    doc, offset, length, row = doc[order], offset[order], length[order], row[order]
    per_row = np.bincount(row, minlength=n_rows)
    filled = np.bincount(row, weights=length, minlength=n_rows).astype(np.int64)
    first = np.cumsum(per_row) - per_row
    before = np.cumsum(length) - length
    start = before - np.repeat(before[first], per_row) if n_rows else before
    # matrices: padded id and position of every cell
    matrix = np.full(n_rows * seq_len, pad_id, np.int32)
    position = np.zeros(n_rows * seq_len, np.int32)
    ramp = np.arange(seq_len, dtype=np.int32)
    for d, o, n, at in zip(doc.tolist(), offset.tolist(), length.tolist(),
                           (row * seq_len + start).tolist(), strict=True):
        matrix[at:at + n] = tokens[d][o:o + n]
        position[at:at + n] = ramp[:n]
    # cumulative lengths: 0 and the end of every segment
    cu = np.zeros(len(row) + n_rows, np.int32)
    cu[np.arange(len(row)) + row + 1] = start + length
    doc_ids = pa.array([ids[d] if known[d] else None for d in doc.tolist()], pa.int64())
    seg = pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array(first_pack + np.arange(n_rows), pa.int64()),
        pa.array(filled, pa.int32()), pa.array(per_row, pa.int32()),
        _lists(matrix, np.full(n_rows, seq_len), pa.int32()),
        _lists(position, np.full(n_rows, seq_len), pa.int32()),
        _lists(cu, per_row + 1, pa.int32()),
        pa.ListArray.from_arrays(seg, doc_ids),
        _lists(offset, per_row, pa.int64()), _lists(start, per_row, pa.int32()),
    ], names=[c.split()[0] for c in SCHEMA.split(", ")])


def pack(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
         text_col: str = "text", seq_len: int = SEQ_LEN, pad_id: int = PAD_ID,
         run_tokens: int = RUN_TOKENS) -> DataFrame:
    """Packed rows of ``docs``: see ``SCHEMA``.

    ``input_ids`` and ``position_ids`` have ``seq_len`` cells; cells from ``n_tokens`` on are
    ``pad_id`` and 0. Positions restart at 0 with every segment; ``cu_seqlens`` holds 0 and
    the end of every segment. Segment i holds the tokens of ``doc_ids[i]`` from
    ``doc_offsets[i]`` on, so the documents can be put together again.
    ``pack_id`` is unique; which documents share a row follows the input's partitions.

    Defined cases: a null or empty text has no tokens and is in no row; a null id
    is a null in ``doc_ids``; repeated rows are packed as often as they come; an empty table gives
    an empty result; other columns are not read.
    """
    def run(batches):
        from pyspark import TaskContext

        encoding = rank_encoding(rank_path, pattern)
        next_pack = TaskContext.get().partitionId() << 33
        ids, known, tokens, held = [], [], [], 0
        for batch in batches:
            got_ids = batch.column(0).to_pylist()
            at = 0
            for part in slices(batch.column(1).to_pylist()):
                for text in part:
                    one = np.array(encode_text(encoding, pattern, text), np.int32)
                    if len(one):
                        ids.append(got_ids[at])
                        known.append(got_ids[at] is not None)
                        tokens.append(one)
                        held += len(one)
                    at += 1
                    if held >= run_tokens:
                        out = pack_run(ids, known, tokens, seq_len, next_pack, pad_id)
                        next_pack += out.num_rows
                        ids, known, tokens, held = [], [], [], 0
                        yield from (out.slice(i, 512) for i in range(0, out.num_rows, 512))
        if tokens:
            out = pack_run(ids, known, tokens, seq_len, next_pack, pad_id)
            yield from (out.slice(i, 512) for i in range(0, out.num_rows, 512))

    return docs.select(F.col(id_col).cast("long").alias("id"),
                       text_or_empty(text_col).alias("text")).mapInArrow(run, SCHEMA)
