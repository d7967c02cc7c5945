"""Operator 7: exact top-k inner products, pruned by segment statistics from coarse to fine.

A vector's segments are summed up by mean and deviation. Since the part of an inner product that
lies in a segment of length l is at most l * (mean * mean + deviation * deviation), two vectors' inner
product is at most the sum of that over their segments (put differently, their squared distance is
at least the two squared lengths less twice that). Bounds are compared with a threshold that the query
has from the start: its k-th best score among a sample of all rows. Three steps drop what stays below:

1. Rows are grouped by their coarse statistics (the nearest of `GROUPS` of the sample). A group's box of
   smallest and largest statistics bounds the product with any of its rows; a query is sent only to groups
   that can reach its threshold.
2. In a group, the coarse bounds of a block of queries and a slice of rows are one matrix product.
3. Where that drops half of the pairs or more, finer segments bound the others; where it does not, finer
   ones cost more than the exact product of the whole block, which is then taken at once.

Exact scores raise the threshold from slice to slice. `pruning` reports what each step drops. Statistics drop
much where vectors fall into groups, and nothing where all directions are alike.

Groups are dealt into cells and their queries into blocks, so that a task holds one cell and one block, whatever
the number of rows or the size of a group. Rows are copied once per block of `BLOCK_ROWS` queries that reach
their group.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id; vectors meet those of equal length only; rows with the query's id are its
own; a row that occurs twice counts once; integer components and scores beyond 64 bits are the
nearest 64-bit ones; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fovea.llm.common import materialize, prepare

TOP = 10
SCALE = 1024
#: Rows of the sample that thresholds come from, and how many of them stand for groups; both are sent to all tasks.
SAMPLE, GROUPS = 4096, 64
#: Most rows of a cell and queries of a block; cells are smaller where there are few rows for many tasks.
CELL_ROWS, BLOCK_ROWS, LEAST_CELL = 1 << 16, 1 << 15, 2048
LEVELS = (4, 16)
#: Rows of a slice, queries that meet it at a time, and pairs bounded at a time.
SLICE, AT_ONCE, PAIRS = 2048, 1024, 1 << 16
#: Largest whole number below which sums of products are exact as doubles.
EXACT = 2.0**53


def integer_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): components floor(1024 * x) of the vectors that take part."""
    wide = F.col(vector).cast("array<double>")
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(F.col("vec_id").isNotNull() & wide.isNotNull())
        .where(sound)
        .select("vec_id", F.transform(wide, lambda x: F.floor(x * SCALE).cast("bigint")).alias("v"))
        .dropDuplicates(["vec_id", "v"])
    )


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of equal segments, so scaled that the bound is an inner product."""
    out = []
    for part in np.array_split(x.astype(np.float64), max(1, min(segments, x.shape[1])), axis=1):
        root = np.sqrt(part.shape[1])
        out += [part.mean(1) * root, part.std(1) * root] if part.shape[1] else []
    return np.stack(out, 1) if out else np.zeros((len(x), 1))


def reach(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max(initial=0))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of integers, exactly."""
    if reach(a) * reach(b) * max(a.shape[1], 1) < 2.0**62:
        return np.einsum("ij,ij->i", a, b)
    wide = (a.astype(object) * b.astype(object)).sum(1)
    return np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in wide], np.int64)


def slack_of(a: float, b: float, width: int) -> float:
    """More than rounding can take from a bound or a score of vectors that reach so far."""
    return 1e-9 * (a + 1) * (b + 1) * max(width, 1)


def kth_best(scores: np.ndarray, top: int) -> np.ndarray:
    """The `top`-th largest of each row, minus infinity where there are fewer."""
    if scores.shape[1] < top:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]


def thresholds(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, top: int) -> np.ndarray:
    """A score that at least `top` of the rows reach for each query, its own rows aside."""
    out = np.empty(len(q))
    for low in range(0, len(q), AT_ONCE):
        some = slice(low, low + AT_ONCE)
        scores = q[some].astype(np.float64) @ x.T.astype(np.float64)
        scores[q_ids[some, None] == x_ids[None, :]] = -np.inf
        out[some] = kth_best(scores, top)
    return out - slack_of(reach(q), reach(x), x.shape[1])


class Counts:
    """Pairs that met each step, and pairs it dropped."""

    def __init__(self):
        self.met, self.dropped = {}, {}

    def add(self, step: str, met: int, left: int) -> None:
        self.met[step] = self.met.get(step, 0) + met
        self.dropped[step] = self.dropped.get(step, 0) + met - left


def best_pairs(
    x_ids: np.ndarray,
    x: np.ndarray,
    q_ids: np.ndarray,
    q: np.ndarray,
    top: int,
    threshold: np.ndarray | None = None,
    counts: Counts | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, score) of each query's best `top` rows here, as far as they reach its threshold."""
    counts = counts or Counts()
    far_x, far_q, width = reach(x), reach(q), x.shape[1]
    slack = slack_of(far_q, far_x, width)
    whole = far_x * far_q * max(width, 1) < EXACT
    threshold = np.full(len(q), -np.inf) if threshold is None else threshold.astype(np.float64).copy()
    found = [(np.empty(0, np.int64),) * 3]
    wide_q = q.astype(np.float64)
    fine_q = [segment_statistics(q, level) for level in LEVELS]
    for begin in range(0, len(x), SLICE):
        part = slice(begin, begin + SLICE)
        ids, rows = x_ids[part], x[part]
        fine_x = [segment_statistics(rows, level) for level in LEVELS]
        wide = rows.T.astype(np.float64)
        for low in range(0, len(q), AT_ONCE):
            some = slice(low, low + AT_ONCE)
            least = threshold[some]
            own = q_ids[some, None] == ids[None, :]
            alive = (fine_q[0][some] @ fine_x[0].T + slack >= least[:, None]) & ~own
            left = int(alive.sum())
            counts.add("coarse", alive.size - int(own.sum()), left)
            if not left:
                continue
            if whole and 2 * left > alive.size:  # finer bounds cost more than they save
                scores = np.where(alive, wide_q[some] @ wide, -np.inf)
                best = np.maximum(kth_best(scores, top), least)
                which, row = np.nonzero((scores >= best[:, None]) & alive)
                score = scores[which, row].astype(np.int64)
                threshold[some] = best
            else:
                which, row = np.nonzero(alive)
                kept = np.zeros(len(which), bool)
                for at in range(0, len(which), PAIRS):
                    a, b = which[at : at + PAIRS], row[at : at + PAIRS]
                    bound = np.einsum("ij,ij->i", fine_q[1][some][a], fine_x[1][b])
                    kept[at : at + PAIRS] = bound + slack >= least[a]
                which, row = which[kept], row[kept]
                counts.add("fine", left, len(which))
                score = np.concatenate([np.empty(0, np.int64)] + [
                    exact(q[some][which[at : at + PAIRS]], rows[row[at : at + PAIRS]])
                    for at in range(0, len(which), PAIRS)
                ])
                kept = score.astype(np.float64) + slack >= least[which]
                which, row, score = which[kept], row[kept], score[kept]
            found.append((which + low, row + begin, score))
    which, row, score = (np.concatenate(parts) for parts in zip(*found))
    # best first within each query: by falling score, then rising id
    order = np.lexsort((x_ids[row], -score.astype(np.float64), which))
    if len(score) and np.abs(score.astype(np.float64)).max() > 2.0**52:
        order = np.array(sorted(range(len(score)), key=lambda i: (which[i], -int(score[i]), x_ids[row[i]])))
    which, row, score = which[order], row[order], score[order]
    kept = np.arange(len(which)) - np.searchsorted(which, which) < top
    return which[kept], row[kept], score[kept]


def matrix(column: pa.ChunkedArray | pa.ListArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


class Sample:
    """Rows of a bounded sample by length, with the ones that stand for groups."""

    def __init__(self, rows: list):
        self.of_length = {}
        for length in sorted({len(row["v"]) for row in rows}):
            some = [row for row in rows if len(row["v"]) == length]
            ids = np.array([row["vec_id"] for row in some], np.int64)
            x = np.array([row["v"] for row in some], np.int64).reshape(len(some), length)
            stands = np.unique(segment_statistics(x[:GROUPS], LEVELS[0]), axis=0)
            self.of_length[length] = ids, x, stands

    def groups(self, x: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        """Number of the nearest group."""
        if x.shape[1] not in self.of_length:
            return np.zeros(len(x), np.int64)
        stands = self.of_length[x.shape[1]][2]
        far = (stands * stands).sum(1)[None, :] - 2 * statistics @ stands.T
        return far.argmin(1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one length each, and their vectors."""
    lengths = batch.column("v").value_lengths().to_numpy()
    for length in np.unique(lengths).tolist():
        part = batch.filter(pa.array(lengths == length)) if (lengths != length).any() else batch
        yield part, matrix(part.column("v"))


def grouped(vectors: DataFrame, sample) -> DataFrame:
    """`vectors` with `length`, `class` (number of the group) and `stats`, the coarse statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _by_length(batch):
                stats = segment_statistics(x, LEVELS[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("v"),
                        pa.array(np.full(len(x), x.shape[1], np.int32)),
                        pa.array(sample.value.groups(x, stats), pa.int32()),
                        pa.array(list(stats), pa.list_(pa.float64())),
                    ],
                    ["vec_id", "v", "length", "class", "stats"],
                )

    schema = "vec_id bigint, v array<bigint>, length int, class int, stats array<double>"
    return vectors.select("vec_id", "v").mapInArrow(run, schema)


def with_thresholds(queries: DataFrame, sample, top: int) -> DataFrame:
    """`queries` with `length`, `least` (a score that `top` rows reach) and `stats`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, q in _by_length(batch):
                least = np.full(len(q), -np.inf)
                if q.shape[1] in sample.value.of_length:
                    ids, x, _ = sample.value.of_length[q.shape[1]]
                    least = thresholds(part.column("vec_id").to_numpy(), q, ids, x, top)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("v"),
                        pa.array(np.full(len(q), q.shape[1], np.int32)),
                        pa.array(least),
                        pa.array(list(segment_statistics(q, LEVELS[0])), pa.list_(pa.float64())),
                    ],
                    ["vec_id", "v", "length", "least", "stats"],
                )

    schema = "vec_id bigint, v array<bigint>, length int, least double, stats array<double>"
    return queries.select("vec_id", "v").mapInArrow(run, schema)


def boxes(rows: DataFrame) -> DataFrame:
    """(length, class, n, low, high): rows of each group, smallest and largest statistics."""
    flat = rows.select("length", "class", F.posexplode("stats").alias("at", "s"))
    ends = flat.groupBy("length", "class", "at").agg(
        F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")
    )
    in_order = lambda name: F.transform(
        F.sort_array(F.collect_list(F.struct("at", name))), lambda x: x[name]
    ).alias(name)  # as many as there are statistics
    return ends.groupBy("length", "class").agg(F.max("n").alias("n"), in_order("low"), in_order("high"))


def _met(vectors: DataFrame, queries: DataFrame, top: int, cell_rows: int | None, block_rows: int):
    """(cogrouped rows and queries that meet, pairs in all, pairs of groups that queries were sent to)."""
    spark = vectors.sparkSession
    prepare(spark)
    by_hash = F.xxhash64("vec_id", "v")
    some = vectors.select("vec_id", "v").orderBy(by_hash, "vec_id", "v").limit(SAMPLE).collect()
    sample = spark.sparkContext.broadcast(Sample(some))  # a bounded number of rows
    rows = materialize(grouped(vectors, sample), "grouped")
    asked = materialize(with_thresholds(queries, sample, top), "queries")
    groups = materialize(boxes(rows), "boxes")
    if cell_rows is None:
        tasks = 2 * spark.sparkContext.defaultParallelism
        cell_rows = min(max(rows.count() // tasks, LEAST_CELL), CELL_ROWS)
    ends = F.transform(
        F.arrays_zip("low", "high", "stats"),
        lambda b: F.greatest(b["low"] * b["stats"], b["high"] * b["stats"]),
    )
    rounding = F.aggregate(ends, F.lit(1e-3), lambda a, x: a + F.abs(x) * 1e-9)
    bound = F.aggregate(ends, F.lit(0.0), lambda a, x: a + x) + rounding
    # a group for each length and class: at most GROUPS for a query
    sent = asked.join(groups, "length").where(bound >= F.col("least"))
    sent = materialize(sent.select("vec_id", "v", "length", "least", "class", "n"), "sent")
    blocks = sent.groupBy("length", "class").agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"),
        F.ceil(F.max("n") / F.lit(cell_rows)).cast("int").alias("cells"),
    )
    keys = ["length", "class"]
    dealt = lambda n, salt: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.col(n)).cast("int").alias(salt)
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    left = rows.join(F.broadcast(blocks), keys).select(  # a row per group
        *keys, "vec_id", "v", dealt("cells", "cell"), each("blocks", "block")
    )
    right = sent.join(F.broadcast(blocks), keys).select(
        *keys, "vec_id", "v", "least", dealt("blocks", "block"), each("cells", "cell")
    )
    keys += ["cell", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)), rows, asked, sent


def search(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    cell_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): exact best rows of each query, both as (vec_id, v)."""
    names = ["query_id", "vec_id", "score"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            empty = pa.array([], pa.int64())
            return pa.table([empty] * 3, names)
        x_ids, q_ids = (t.column("vec_id").to_numpy() for t in (left, right))
        x, q = matrix(left.column("v")), matrix(right.column("v"))
        which, row, score = best_pairs(x_ids, x, q_ids, q, top, right.column("least").to_numpy())
        return pa.table([q_ids[which], x_ids[row], score], names)

    met = _met(vectors, queries, top, cell_rows, block_rows)[0]
    found = met.applyInArrow(meet, "query_id bigint, vec_id bigint, score bigint")
    falling = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def pruning(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    cell_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(step, pairs, dropped): what boxes of groups, coarse and fine bounds see and drop in such a search."""
    names = ["step", "pairs", "dropped"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = Counts()
        if left.num_rows and right.num_rows:
            best_pairs(
                left.column("vec_id").to_numpy(), matrix(left.column("v")), right.column("vec_id").to_numpy(),
                matrix(right.column("v")), top, right.column("least").to_numpy(), counts,
            )
        steps = sorted(counts.met)
        columns = [steps, [counts.met[s] for s in steps], [counts.dropped[s] for s in steps]]
        kinds = [pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    met, rows, asked, sent = _met(vectors, queries, top, cell_rows, block_rows)
    seen = met.applyInArrow(meet, "step string, pairs bigint, dropped bigint")
    alike = asked.groupBy("length").agg(F.count("*").alias("q")).join(
        rows.groupBy("length").agg(F.count("*").alias("x")), "length"
    )
    pairs = alike.agg(F.sum(F.col("q") * F.col("x")).alias("pairs"))
    kept = sent.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))
    boxed = pairs.join(kept, F.lit(True)).select(  # one row each
        F.lit("boxes").alias("step"), "pairs", (F.col("pairs") - F.col("kept")).alias("dropped")
    )
    return boxed.unionByName(seen.groupBy("step").agg(F.sum("pairs").alias("pairs"), F.sum("dropped").alias("dropped")))
