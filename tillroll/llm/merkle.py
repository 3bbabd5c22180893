"""Merkle manifest of a dataset: a hash tree over its rows, with every row's proof.

Rows of one group (a language) are leaves in key order. Every ``FAN`` consecutive nodes of a level
hash to their parent, the last run having fewer, until one node, the group's subroot, remains; the
subroots, in order of their groups, are the leaves of a tree of the same kind, whose top is the root.
A row's proof are the other nodes of each run on its way up: with them and the row alone the root can
be computed again.

Trees are built block by block. A block is ``FAN ** DEPTH`` consecutive leaves, aligned, so no run
leaves it; it keeps each of its levels as one string of hex digests end to end. A digest then has a
fixed place: parents are hashes of fixed-width substrings, and a node's siblings are the substrings
before and after it in its run. (The strings are held as bytes, whose substrings Spark finds without
counting characters.) Blocks' tops are the leaves of the next tier, up to a tier that is one block per
group; a row's path is its block's path below that of the block in the tier above. Work and memory of
a task are bounded by the block; the largest group only adds blocks and, rarely, a tier.

Places in key order come from one range sort of the hashes, split within groups, and from the number
of rows that each sorted partition has of each group. Texts do not move.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.frames import stored

FAN = 8
#: Levels to a block: 512 leaves.
DEPTH = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as the leaf hashes it: its number of UTF-8 bytes, a colon, the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the fields end to end, in lower-case hex."""
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def _part(level: Column, start: Column, length: Column) -> Column:
    """``length`` bytes of a level from byte ``start`` (from 0) on."""
    return F.substring(level, start + 1, length)


def _parents(level: Column, fan: int) -> Column:
    width = fan * HEX
    runs = F.ceil(F.octet_length(level) / F.lit(width)).cast("int")
    parents = F.transform(
        F.sequence(F.lit(0), runs - 1), lambda run: F.sha2(_part(level, run * width, F.lit(width)), 256)
    )
    return F.array_join(parents, "").cast("binary")


def _siblings(level: Column, place: Column, height: int, fan: int) -> Column:
    """The segments of ``level`` left and right of the node above leaf ``place``, within its run."""
    node = F.floor(place / F.lit(fan**height)).cast("int")
    nth = F.pmod(node, F.lit(fan))
    left = _part(level, (node - nth) * HEX, nth * HEX)
    right = _part(level, (node + 1) * HEX, (fan - 1 - nth) * HEX)
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def _placed(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``nodes`` (grp, ...) with ``place``, the rank from 0 in ``order`` within ``grp``, and ``of``,
    the number of nodes of ``grp``; and the largest of those numbers."""
    row, task = F.monotonically_increasing_id(), F.spark_partition_id()
    ranked = stored(
        nodes.repartitionByRange("grp", *order)
        .sortWithinPartitions("grp", *order)
        .withColumns({"__row": row, "__task": task}),
        "sorted-nodes",
    )
    # One row for each group and partition that has rows of it.
    spans = ranked.groupBy("grp", "__task").agg(
        F.min("__row").alias("__first"), F.count("*").alias("__n")
    )
    group = Window.partitionBy("grp")
    before = group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(
        spans.select(
            "grp",
            "__task",
            "__first",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
            F.sum("__n").over(group).alias("of"),
        ),
        "node-spans",
    )
    place = F.col("__before") + F.col("__row") - F.col("__first")
    rows = ranked.join(spans, ["grp", "__task"]).withColumn("place", place)
    most = spans.agg(F.max("of")).first()[0] or 0
    return rows.drop("__row", "__task", "__first", "__before"), int(most)


def _blocks(placed: DataFrame, carried: list[str], fan: int, depth: int) -> DataFrame:
    """(grp, block, of, members, level0 ... , steps, top): a row for each block.

    ``members``: the ``carried`` columns of its leaves, in order. ``steps``: how many levels the
    block rises, all if its group has other blocks, else until one node remains. ``top``: that node.
    """
    size = fan**depth
    inside = F.pmod("place", F.lit(size)).cast("int")
    members = F.sort_array(F.collect_list(F.struct(inside.alias("place"), "hash", *carried)))
    block = F.floor(F.col("place") / F.lit(size)).cast("long")
    rows = placed.groupBy("grp", block.alias("block")).agg(F.max("of").alias("of"), members.alias("members"))
    hashes = F.transform("members", lambda member: member["hash"])
    rows = rows.withColumn("level0", F.array_join(hashes, "").cast("binary"))
    # Each level is a column that the next one and the result use, so it is computed once.
    for height in range(depth):
        rows = rows.withColumn(f"level{height + 1}", _parents(F.col(f"level{height}"), fan))
    steps = F.lit(0)
    for height in range(depth):
        steps = steps + ((F.col("of") > size) | (F.octet_length(f"level{height}") > HEX)).cast("int")
    levels = F.array(*[F.col(f"level{height}") for height in range(depth + 1)])
    top = F.get(levels, F.col("steps")).cast("string")
    kept = F.transform("members", lambda member: member.dropFields("place", "hash")) if carried else F.lit(None)
    return (
        rows.withColumn("steps", steps)
        .withColumn("top", top)
        .withColumn("n", F.size("members"))
        .withColumn("members", kept)
        .drop(f"level{depth}")
    )


class Tree(NamedTuple):
    """``tiers``: the blocks' tables, lowest first. ``tops``: (grp, top), each group's subroot."""

    tiers: list[DataFrame]
    tops: DataFrame
    fan: int
    depth: int

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """(grp, carried columns, hash, top, path): every leaf with its group's subroot and the
        siblings on its way up, an array of (left, right). ``above``: (grp, path), what follows after
        a group's subroot."""
        upper = None
        for number in range(len(self.tiers) - 1, -1, -1):
            blocks = self.tiers[number]
            if upper is not None:
                blocks = blocks.drop("top").join(upper, ["grp", "block"])
            elif above is not None:
                blocks = blocks.join(above.select("grp", F.col("path").alias("up")), "grp")
            else:
                blocks = blocks.withColumn("up", F.array().cast(_PATH))
            places = F.sequence(F.lit(0), F.col("n") - 1)

            node = F.transform(places, self._block if number else self._leaf)
            upper = blocks.select("grp", "top", F.explode(node).alias("node"))
            if number:  # the leaves of this tier are the blocks of the one below
                upper = upper.select("grp", "top", "node.*")
        return upper.select("grp", "node.member.*", "node.hash", "top", "node.path")

    def _path(self, place: Column) -> Column:
        own = [_siblings(F.col(f"level{h}"), place, h, self.fan) for h in range(self.depth)]
        return F.concat(F.slice(F.array(*own), F.lit(1), F.col("steps")), F.col("up"))

    def _block(self, place: Column) -> Column:
        below = F.col("block") * self.fan**self.depth + place
        return F.struct(below.alias("block"), self._path(place).alias("up"))

    def _leaf(self, place: Column) -> Column:
        own = _part(F.col("level0"), place * HEX, F.lit(HEX)).cast("string")
        member = F.get("members", place)
        return F.struct(member.alias("member"), own.alias("hash"), self._path(place).alias("path"))


def tree(nodes: DataFrame, order: list[str], carried: list[str], fan: int = FAN, depth: int = DEPTH) -> Tree:
    """The trees over ``nodes`` (grp, hash, ...), one for each ``grp``, leaves in ``order``."""
    placed, most = _placed(nodes, order)
    tiers, size = [], fan**depth
    while True:
        blocks = stored(_blocks(placed, carried, fan, depth), "tree-blocks")
        tiers.append(blocks)
        if most <= size:
            return Tree(tiers, blocks.select("grp", "top"), fan, depth)
        most = -(-most // size)
        count = F.ceil(F.col("of") / F.lit(size)).cast("long")
        # A group that is one block already has its subroot: its block goes up by itself, unhashed.
        placed = blocks.select(
            "grp", F.col("block").alias("place"), F.col("top").alias("hash"), count.alias("of")
        )
        carried = []


class Manifest(NamedTuple):
    """``rows``: the trees of the groups; ``groups``: the tree over their subroots."""

    rows: Tree
    groups: Tree
    #: (grp, group, subroot): ``grp`` is the group's name in the tree's order, its null the first.
    subroots: DataFrame

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return self.groups.tops.select(F.col("top").alias("root"))

    def proofs(self) -> DataFrame:
        """(carried columns, leaf, subroot, root, path) for every row of the dataset."""
        above = stored(self.groups.paths().select(F.col("group").alias("grp"), "path"), "group-paths")
        rows = self.rows.paths(above).withColumnsRenamed({"hash": "leaf", "top": "subroot"})
        return rows.withColumn("root", self.root().scalar()).drop("grp")


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
    fan: int = FAN,
    depth: int = DEPTH,
) -> Manifest:
    """The manifest of ``docs``: a leaf for each row, of ``fields``, in ascending order of ``key``.

    A null in any column is a value like others: null groups form the first group, null keys come
    first. Rows with one key follow each other by their hashes, so repeated rows have a proof each.
    An empty table has no root. Columns that are not named are ignored. ``carry``: further columns of
    the proofs, beside ``key``.
    """
    more = carry or {}
    name = F.col(group).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"),
        F.col(key).alias(key),
        leaf_hash(*[F.col(c) for c in fields]).alias("hash"),
        *[value.alias(c) for c, value in more.items()],
    )
    # Stored, since a range sort reads its input twice and texts should be hashed once.
    rows = tree(stored(leaves, "leaves"), [key, "hash"], [key, *more], fan, depth)
    tops = rows.tops.select(F.lit("").alias("grp"), F.col("grp").alias("group"), F.col("top").alias("hash"))
    groups = tree(tops, ["group"], ["group"], fan, depth)
    subroots = rows.tops.select(
        "grp",
        F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("group"),
        F.col("top").alias("subroot"),
    )
    return Manifest(rows, groups, subroots)


def tampered(key: Column) -> Column:
    """Whether a row is among the third whose letters the check of the proofs changes."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 0, F.lit(False))


def verified_rows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """Every row's proof, and whether it still verifies after a third of the texts were changed.

    Where the CRC-32 of the key divides by 3, A-Z of ``text`` turn to lower case. (key, leaf, subroot,
    root, proof_sha256, folded_root, verified): the root is folded from the changed leaf, else the
    original one. A text without A-Z, and a null one, changes nothing and verifies. See ``manifest``
    for nulls, ties and empty tables; a null key is never tampered with.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate(F.col(text), capitals, capitals.lower())
    changed = leaf_hash(*[lower if c == text else F.col(c) for c in fields])
    carry = {"__changed": F.when(tampered(F.col(key)), changed)}
    proofs = manifest(docs, key, group, fields, carry).proofs()
    found = proofs.withColumn("folded_root", folded(F.col("path"), F.coalesce("__changed", "leaf")))
    return found.select(
        key,
        "leaf",
        "subroot",
        "root",
        proof_hash(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
