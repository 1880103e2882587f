"""Merkle manifest of a table with incremental witnesses.

Per group (source), leaves in id order form a tree of runs of three; the group roots, in the order
of the group names, form a tree above them. A leaf's *witness* is, level by level, what stands to the
left and to the right of it in its run, enough to fold the leaf up to the root.

1. Leaf digests are column expressions over the scan; only digests travel on.
2. Leaves get their rank in their group from a range sort and are cut into aligned blocks of
   ``3 ** BLOCK_LEVELS`` leaves, so that a block is exactly one subtree.
3. A block is built by streaming append (:class:`Frontier`): an arriving leaf opens the smallest
   subtree; when the third member of a run arrives, the run closes, every leaf below it
   gets its witness extended by the siblings just completed, and the run's digest is appended one level up.
4. Block roots are appended in the same way, as the leaves of the next round, until each group has one
   node; group roots likewise until one node is left.
5. Witnesses are joined from the top down: a leaf's is its own within the block, then the block's, and so on.

So a hot group is many blocks, a task holds one block at a time, and the rounds are the logarithm
of the largest group to the base of the block size.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.joins import broadcast_if_small, key_table_bytes
from lexiflow.operators.ranks import attach_runs, dense_ranks, same_keys, sorted_runs
from lexiflow.session import materialize, materialize_measured

FANOUT = 3
#: a block is a subtree of this many levels: 729 leaves
BLOCK_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def encode_field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value (integers decimal)."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[encode_field(v) for v in values]), 256)


class Frontier:
    """The open subtrees of a growing tree, with the partial witnesses of its leaves."""

    def __init__(self):
        self.left: list[list[str]] = []
        self.right: list[list[str]] = []
        #: per level the nodes of the open run: (digest, first leaf, end of its leaves)
        self.open: list[list[tuple[str, int, int]]] = [[]]

    def append(self, leaf: str) -> None:
        node, level = (leaf, len(self.left), len(self.left) + 1), 0
        self.left.append([])
        self.right.append([])
        while True:
            self._add(node, level)
            if len(self.open[level]) < FANOUT:
                return
            node, level = self._close(level), level + 1

    def _add(self, node: tuple[str, int, int], level: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)

    def _close(self, level: int) -> tuple[str, int, int]:
        """Complete the run of a level: extend the witnesses of the leaves below, return the parent."""
        run = self.open[level]
        self.open[level] = []
        parts = [node[0] for node in run]
        for i, (_, first, end) in enumerate(run):
            before, after = "".join(parts[:i]), "".join(parts[i + 1:])
            for leaf in range(first, end):
                self.left[leaf].append(before)
                self.right[leaf].append(after)
        return digest(parts), run[0][1], run[-1][2]

    def finish(self, levels: int) -> str:
        """Close what is open up to ``levels``, short runs as they are; returns the digest there."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._add(self._close(level), level + 1)
        return self.open[levels][0][0]


def levels_of(n: int, most: int) -> int:
    """Levels until ``n`` nodes are one, ``most`` at most."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _append_blocks(block_levels: int):
    """Rows sorted by (tree, block, pos); adds the witness and, on a block's first row, the block's root."""
    def grow(block: pa.Table) -> pa.Table:
        frontier = Frontier()
        for leaf in block.column("digest").to_pylist():
            frontier.append(leaf)
        n = block.column("n")[0].as_py()
        root = frontier.finish(block_levels if n > FANOUT ** block_levels else levels_of(n, block_levels))
        kind = pa.list_(pa.string())
        return (block.append_column("lefts", pa.array(frontier.left, kind))
                .append_column("rights", pa.array(frontier.right, kind))
                .append_column("root", pa.array([root] + [None] * (block.num_rows - 1), pa.string())))

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            tree, block = held.column("tree").to_numpy(), held.column("block").to_numpy()
            cuts = [0, *((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])).nonzero()[0] + 1]
            # the last block may go on in the next batch
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield from grow(held.slice(a, b - a)).to_batches()
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from grow(held).to_batches()

    return run


def _climb(nodes: DataFrame, block_levels: int, name: str) -> DataFrame:
    """One round of appends over ``nodes(tree, pos, n, digest, ...)``, written with ``block, lefts, rights, root``."""
    size = FANOUT ** block_levels
    placed = nodes.withColumn("block", F.expr(f"pos div {size}"))
    dealt = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return materialize(dealt.mapInArrow(
        _append_blocks(block_levels),
        f"{schema}, lefts array<string>, rights array<string>, root string"), name)


def _blocks(grown: DataFrame, block_levels: int) -> DataFrame:
    """The block roots of a round as the nodes of the next one."""
    size = FANOUT ** block_levels
    return grown.where("root is not null").select(
        "tree", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
        F.col("root").alias("digest"))


def _under(lower: DataFrame, upper: DataFrame, on: dict[str, str], carry: list[str]) -> DataFrame:
    """``lower`` with the witnesses of ``upper`` put after its own, and the columns ``carry`` of ``upper``.

    ``on``: column of lower -> column of upper, unique there. Upper has a row per block of lower; it is
    broadcast if it is small, else a key meets at most one block of rows.
    """
    side, m = materialize_measured(upper.select(
        *[F.col(u).alias(f"_u_{k}") for k, u in on.items()], F.col("lefts").alias("_lefts"),
        F.col("rights").alias("_rights"), *carry), "witnesses", {
            "rows": F.count(F.lit(1)),
            "chars": F.sum(F.octet_length(F.array_join("_lefts", "")).cast("long")
                           + F.octet_length(F.array_join("_rights", "")) + 48 * F.size("_lefts")
                           + 96 * len(carry))})
    side = broadcast_if_small(side, known_rows=m["rows"], known_bytes=key_table_bytes(m["rows"], 2, m["chars"]))
    return (lower.join(side, same_keys(list(on), "_u_"))
            .withColumn("lefts", F.concat("lefts", "_lefts"))
            .withColumn("rights", F.concat("rights", "_rights"))
            .drop("_lefts", "_rights", *[f"_u_{k}" for k in on]))


def _grow_trees(nodes: DataFrame, largest: int, block_levels: int, name: str) -> list[DataFrame]:
    """Rounds of appends until every tree is one node."""
    rounds = []
    while True:
        grown = _climb(nodes, block_levels, f"{name}-{len(rounds)}")
        rounds.append(grown)
        largest = -(-largest // FANOUT ** block_levels)
        if largest <= 1:
            return rounds
        # a tree that is one node already has its witnesses; it takes part with no level more
        nodes = _blocks(grown, block_levels)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source", extra: dict[str, Column] | None = None,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: id, group, ``leaf``, ``subroot``, ``root``, ``lefts``, ``rights`` and ``extra``.

    ``leaf`` is the digest of ``fields``; ``lefts[i]`` and ``rights[i]`` are the digests, run together, that
    stand before and after the leaf's ancestor in its run at level i, through the group's tree and then
    through the tree of groups. :func:`fold` turns a leaf and its witness into the root.
    ``extra`` are columns computed from the input row and carried along.

    Defined cases: nulls in any field are encoded as such; a null id comes first in its group, the null group
    first of all; leaves of one id are ordered by their digest, so repeated rows give the same tree in any
    order; an empty text is a value, not a null; an empty table gives an empty result; other columns of
    ``docs`` are not read. ``extra`` must not use the names above.
    """
    extra = extra or {}
    leaves = materialize(docs.select(
        F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("grp"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"),
        *[c.alias(f"x_{k}") for k, c in extra.items()]), "merkle-leaves")
    numbered, runs, _ = sorted_runs(leaves, ["id", "digest"], ["grp"], "merkle-sorted")
    runs = materialize(runs, "merkle-runs")
    groups, seen = materialize_measured(runs.groupBy("grp").agg(F.sum("_run_rows").alias("n")), "merkle-groups", {
        "n": F.max("n"), "groups": F.count(F.lit(1))})
    # the rank of a group is its tree and its place in the tree of groups
    trees = dense_ranks(groups, ["grp"], alias="tree", name="merkle-trees")
    trees = trees.select(F.col("grp").alias("_g_grp"), "n", "tree")
    runs = runs.join(trees, same_keys(["grp"], "_g_")).drop("_g_grp")
    nodes = attach_runs(numbered, runs, "pos", ["grp"], ["tree", "n"])
    rounds = _grow_trees(nodes, max(1, seen["n"]), block_levels, "merkle-blocks")
    tops = _blocks(rounds[-1], block_levels).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"),
        F.lit(seen["groups"]).cast("long").alias("n"), "digest")
    above = _grow_trees(tops, max(1, seen["groups"]), block_levels, "merkle-groups-blocks")
    # from the top down: root of the whole, then groups, then blocks of groups, then leaves
    upper = above[-1]
    last = upper.where("root is not null").select("root").head()
    for lower in reversed(above[:-1]):
        upper = _under(lower, upper, {"block": "pos"}, [])
    upper = upper.select(F.col("pos").alias("tree"), "lefts", "rights", F.col("digest").alias("subroot"))
    upper = _under(rounds[-1], upper, {"tree": "tree"}, ["subroot"])
    for lower in reversed(rounds[:-1]):
        upper = _under(lower, upper, {"tree": "tree", "block": "pos"}, ["subroot"])
    return upper.select(
        F.col("id").alias(id_col), F.col("grp").alias(group_col), F.col("digest").alias("leaf"), "subroot",
        F.lit(last["root"] if last else None).cast("string").alias("root"), "lefts", "rights",
        *[F.col(f"x_{k}").alias(k) for k in extra])


def fold(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(F.arrays_zip(lefts.alias("l"), rights.alias("r")), leaf,
                       lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def proof_digest(lefts: Column, rights: Column) -> Column:
    """Digest of all siblings of a witness, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), ""), 256)


def without_line_ends(id_col: str = "doc_id", text_col: str = "text",
                      fields: tuple[str, ...] = FIELDS) -> Column:
    """Leaf digest of a row whose text lost its line ends, for ids with an even CRC-32; null where nothing changes."""
    hit = (F.crc32(F.col(id_col).cast("string")) % 2 == 0) & F.contains(F.col(text_col), F.lit("\n"))
    cut = F.replace(F.col(text_col), F.lit("\n"), F.lit(""))
    return F.when(hit, leaf_digest([cut if f == text_col else F.col(f) for f in fields]))


def audit(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The manifest of ``docs`` and, per row, whether a tampered copy of it still leads to the root."""
    rows = manifest(docs, extra={"tampered": without_line_ends()}, block_levels=block_levels)
    folded = fold(F.coalesce("tampered", "leaf"), F.col("lefts"), F.col("rights"))
    return rows.select("doc_id", "leaf", "subroot", "root",
                       proof_digest(F.col("lefts"), F.col("rights")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
