"""Operator 9: shards of nearly equal bytes from a k-d tree over document metadata.

A node of the tree stands for a number of shards. It is split along the dimension in which its rows
spread widest (as a share of the whole table's spread) at the weighted value that gives either part the bytes
of its shards. That value is found from counts: sums of bytes in `BINS` equal intervals, then in the
interval that holds the cut, and so on, for all nodes of a level at once. All dimensions are
functions of the text, and rows equal in one dimension are ordered by the text's hash, so equal texts
stay together, unless that would move a cut by more than `whole_groups` of a shard; then their
documents are ordered by the hash of the id. A hot group is thus split like anything else.

The driver sees at most BINS small rows for each node. Main path: DataFrame functions only.

Defined cases: a null text weighs the fixed 8 bytes and has the checksum of no bytes; null ids are kept; repeated rows
get a slot each; an empty table gives no rows; with few or heavy documents shards may stay empty;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fovea.llm.common import materialize

SHARDS = 24
OVERHEAD = 8
BINS = 4096
DIMENSIONS = ("size", "wide", "checksum")
#: A cut may be off by this share of a shard's bytes, and by more to keep equal texts together.
PRECISION, WHOLE_GROUPS = 0.005, 0.02
ROWS_PER_BUCKET = 2_000
LAST = (1 << 62) - 1


def metadata(docs: DataFrame) -> DataFrame:
    """Sizes, the dimensions, and the two hashes that order equal rows."""
    raw = F.col("text").cast("binary")
    octets = F.coalesce(F.octet_length("text"), F.lit(0))
    letters = F.coalesce(F.length("text"), F.lit(0))
    return docs.select(
        "doc_id",
        (octets + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("bigint").alias("checksum"),
        F.floor((octets - letters) * 1000 / F.greatest(octets, F.lit(1))).cast("bigint").alias("wide"),
        F.xxhash64("text").bitwiseAND(F.lit(LAST)).alias("text_hash"),
        F.xxhash64("doc_id").bitwiseAND(F.lit(LAST)).alias("id_hash"),
    )


@dataclass
class Node:
    """Shards first .. first + shards - 1; `cut` holds (column, value) pairs, compared in turn."""

    number: int
    first: int
    shards: int
    cut: list[tuple[str, int]] | None = None
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def place(self, value: str) -> Column:
        """`number` or `first` of the leaf that a row belongs to."""
        if self.left is None:
            return F.lit(getattr(self, value))
        return F.when(before(self.cut), self.left.place(value)).otherwise(self.right.place(value))


def before(cut: list[tuple[str, int]]) -> Column:
    (name, value), *rest = cut
    below = F.col(name) < F.lit(value)
    return below | ((F.col(name) == F.lit(value)) & before(rest)) if rest else below


@dataclass
class Search:
    """The interval of one column, among rows equal to `prefix`, that holds a node's cut."""

    node: Node
    target: float
    order: list[str]
    low: int
    high: int
    below: float = 0.0
    prefix: list[tuple[str, int]] | None = None
    done: bool = False

    @property
    def step(self) -> int:
        return -(-(self.high - self.low + 1) // BINS)

    def bin(self) -> Column:
        name = self.order[0]
        inside = F.col(name).between(self.low, self.high)
        for other, value in self.prefix or []:
            inside &= F.col(other) == F.lit(value)
        return F.when(inside, F.floor((F.col(name) - F.lit(self.low)) / F.lit(self.step)))

    def narrow(self, bins: dict[int, tuple[int, int, int, int]], precision: float, whole: float):
        """Go on with the values that hold the cut, or settle before or after them.

        A bin is (bytes, rows, least value, greatest value).
        """
        total, name = self.below, self.order[0]
        for at in sorted(bins):
            weight, rows, low, high = bins[at]
            if total + weight >= self.target:
                break
            total += weight
        off, end = min((abs(total - self.target), low), (abs(total + weight - self.target), high + 1))
        group = name == "text_hash" and low == high
        if off <= (whole if group else precision) or rows == 1 or low == high and len(self.order) == 1:
            self.node.cut = [*(self.prefix or []), (name, end)]
            self.done = True
        elif low == high:
            self.below = total
            self.prefix = [*(self.prefix or []), (name, low)]
            self.order = self.order[1:]
            self.low, self.high = 0, LAST
        else:
            self.below, self.low, self.high = total, low, high


def _spreads(rows: DataFrame, node: Column) -> dict[int, dict]:
    stats = [f(name).alias(f"{k}_{name}") for name in DIMENSIONS for k, f in (("min", F.min), ("max", F.max))]
    found = rows.groupBy(node.alias("_node")).agg(F.sum("size").alias("bytes"), *stats).collect()
    return {row["_node"]: row.asDict() for row in found}


def grow(rows: DataFrame, shards: int, precision: float, whole: float) -> Node:
    """The tree over staged metadata, level by level."""
    root, counter = Node(0, 0, shards), 1
    spread = _spreads(rows, F.lit(0))
    if not spread:
        return root
    widest = {x: max(spread[0][f"max_{x}"] - spread[0][f"min_{x}"], 1) for x in DIMENSIONS}
    share = spread[0]["bytes"] / shards
    while open_nodes := [n for n in root.leaves() if n.shards > 1]:
        spread = _spreads(rows, root.place("number"))
        searches: dict[int, Search] = {}
        for node in open_nodes:
            own = spread.get(node.number)
            if own is None:
                node.cut = [("size", 0)]
                continue
            name = max(DIMENSIONS, key=lambda x: (own[f"max_{x}"] - own[f"min_{x}"]) / widest[x])  # noqa: B023
            searches[node.number] = Search(
                node,
                own["bytes"] * (node.shards // 2) / node.shards,
                [name, "text_hash", "id_hash"],
                own[f"min_{name}"],
                own[f"max_{name}"],
            )
        while active := {k: s for k, s in searches.items() if not s.done}:
            number = root.place("number")
            cell = value = F.lit(None).cast("bigint")
            for k, search in active.items():
                cell = F.when(F.col("_node") == k, search.bin()).otherwise(cell)
                value = F.when(F.col("_node") == k, F.col(search.order[0])).otherwise(value)
            found = (
                rows.withColumn("_node", number)
                .select("_node", cell.alias("_bin"), "size", value.alias("_value"))
                .where(F.col("_bin").isNotNull())
                .groupBy("_node", "_bin")
                .agg(F.sum("size"), F.count("*"), F.min("_value"), F.max("_value"))
                .collect()
            )
            by_node: dict[int, dict[int, tuple]] = {k: {} for k in active}
            for row in found:
                by_node[row["_node"]][row["_bin"]] = tuple(row)[2:]
            for k, search in active.items():
                search.narrow(by_node[k], precision * share, whole * share)
        for node in open_nodes:
            part = node.shards // 2
            node.left = Node(counter, node.first, part)
            node.right = Node(counter + 1, node.first + part, node.shards - part)
            counter += 2
    return root


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    precision: float = PRECISION,
    whole_groups: float = WHOLE_GROUPS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(doc_id, size, checksum, shard, slot) of every document.

    Slots are numbered in buckets of about `rows_per_bucket` rows, whose counts are added up first, so no
    task sorts a whole shard.
    """
    # rows equal in both hashes are told apart by the task that read them
    rows = materialize(metadata(docs).withColumn("_salt", F.spark_partition_id()), "metadata")
    tree = grow(rows, shards, precision, whole_groups)
    buckets = max(1, -(-rows.count() // (shards * rows_per_bucket)))
    placed = rows.select(
        "doc_id", "size", "checksum", "text_hash", "id_hash", "_salt",
        tree.place("first").cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "text_hash", "_salt"), F.lit(buckets)).alias("_bucket"),
    )
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_bucket")
    offsets = counts.select(
        "shard", "_bucket",
        (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_offset"),
    )
    own = Window.partitionBy("shard", "_bucket").orderBy("id_hash", "text_hash")
    numbered = placed.withColumn("_at", F.row_number().over(own))
    return numbered.join(offsets, ["shard", "_bucket"]).select(
        "doc_id", "size", "checksum", "shard",
        (F.col("_offset") + F.col("_at") - 1).cast("bigint").alias("slot"),
    )
