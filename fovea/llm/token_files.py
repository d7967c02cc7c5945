"""Operator 12: token ids of a corpus in files, packed by a canonical length-limited Huffman code.

A file set is a folder of three Parquet tables:

    code     (id, length)             lengths of the code words of the ids that occur; the code follows from them
    blocks   (shard, number, before, n, doc_ids, sizes, bits, checkpoints)
    shards   (shard, first)           ids of the corpus before each shard

Documents lie in blocks in ascending order of their ids, whole ones, until a block has `BLOCK_IDS` ids; a longer
document is a block of its own. A document's bits begin at a full byte. `checkpoints` holds the bit where
every 256th id of a document begins, so a block is decoded without any other one, and from any checkpoint.

Writing: texts are encoded by the tokenizers library and staged; the counts of ids are added up over all tasks and
give code lengths by package-merge, at most `LONGEST` bits; the ids are shuffled once, by ranges of doc_id; each
task of the sorted rows makes them bits and joins these to blocks, and the tasks' totals give every shard
its place. Spark's own writer commits the files, so lost executors leave
none behind. Decoding is driven by a table of all bit strings of the longest length: one lookup gives an
id and how far to go on; the runs from all checkpoints of a batch go on side by side.

Defined cases: a null or empty text is the end id alone; documents without an id come first; rows of the same
id stand next to each other, in the order of the input's files, each with a start of its own; a corpus of
one different id has a code of one bit; an empty table gives empty files and no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.llm.common import arrow_batches, materialize, prepare, row_slices, running_offsets, whole_text
from fovea.llm.words import ByteWords, word_table

END_ID = 2
#: Most bits of a code word; more where the number of ids needs it.
LONGEST = 18
#: Ids between two checkpoints, and ids of a block.
EVERY = 256
BLOCK_IDS = 1 << 16
TEXT_BYTES, SLICE_IDS = 1 << 23, 1 << 20


# --- the code


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best code words of at most `longest` bits, by package-merge; 0 where a count is 0.

    Packages of a level are pairs of the level below, merged with the single symbols by weight. Of the last
    level the 2n - 2 lightest items are taken; each symbol among them is one bit longer, and the packages
    among them say how many items of the level below are taken.
    """
    used = np.nonzero(counts)[0]
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    longest = max(longest, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    items, single = weights, [np.ones(len(weights), bool)]
    for _ in range(longest - 1):
        pairs = len(items) // 2
        packages = items[: 2 * pairs : 2] + items[1 : 2 * pairs : 2]
        both = np.concatenate([weights, packages])
        rank = np.argsort(both, kind="stable")
        items = both[rank]
        single.append(rank < len(weights))
    taken = 2 * len(weights) - 2
    for level in reversed(single):
        symbols = int(level[:taken].sum())
        lengths[order[:symbols]] += 1
        taken = 2 * (taken - symbols)
    return lengths


class Code:
    """The canonical code of given lengths: shorter words first, of equal length by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.nonzero(self.lengths)[0]
        used = used[np.argsort(self.lengths[used], kind="stable")]
        self.bits = int(self.lengths.max(initial=0)) or 1
        # each word takes the next 2 ** (bits - length) strings of `bits` bits
        width = np.int64(1) << (self.bits - self.lengths[used])
        begin = np.cumsum(width) - width
        self.words = np.zeros(len(lengths), np.uint64)
        self.words[used] = (begin >> (self.bits - self.lengths[used])).astype(np.uint64)
        #: for every string of `bits` bits the id it begins with, and that id's length
        self.id_of = np.zeros(1 << self.bits, np.uint32)
        self.id_of[: width.sum()] = np.repeat(used, width)
        self.step_of = np.ones(1 << self.bits, np.uint8)
        self.step_of[: width.sum()] = np.repeat(self.lengths[used], width)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """Bits of documents of `sizes` ids, each from a full byte on, and the bits where checkpoints lie."""
        lengths = self.lengths[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(sizes)
        first = last - sizes
        bits = upto[last] - upto[first]
        size = (bits + 7) >> 3
        base = np.concatenate([[0], np.cumsum(size)])
        at = upto[:-1] + np.repeat(base[:-1] * 8 - upto[first], sizes)
        # a word reaches into two neighbouring groups of 32 bits at most
        group, gap = at >> 5, (64 - (at & 31) - lengths).astype(np.uint64)
        both = self.words[ids] << gap
        out = np.zeros((int(base[-1]) >> 2) + 2, np.uint32)
        if len(ids):
            head = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1])
            out[group[head]] = np.bitwise_or.reduceat(both >> np.uint64(32), head).astype(np.uint32)
            tail = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            over = np.nonzero(tail)[0]
            out[group[over] + 1] |= tail[over]  # one word at most crosses each border
        raw = out.astype(">u4").tobytes()
        edges = base.tolist()
        marks = [at[a:b:EVERY] - 8 * e for a, b, e in zip(first.tolist(), last.tolist(), edges)]
        return [raw[a:b] for a, b in zip(edges, edges[1:])], marks

    def decode(self, raw: bytes, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of runs that begin at given bits and have `counts` ids, one run after the other."""
        if not counts.sum():
            return np.empty(0, np.uint32)
        data = np.frombuffer(raw + bytes(8), np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        order = np.argsort(-counts, kind="stable")
        at, n = begins[order].astype(np.int64), counts[order]
        most = int(n[0])
        alive = np.searchsorted(-n, -np.arange(1, most + 1), "right")
        out = np.empty((most, len(n)), np.uint32)
        drop = np.uint32(32 - self.bits)
        for step in range(most):
            here = at[: alive[step]]
            string = window[here >> 3] << (here & 7).astype(np.uint32) >> drop
            out[step, : alive[step]] = self.id_of[string]
            here += self.step_of[string]
        # back to the order of the runs
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        run = np.repeat(place, counts)
        first = np.cumsum(counts) - counts
        step = np.arange(len(run)) - np.repeat(first, counts)
        return out[step, run]


def runs_of(sizes: np.ndarray) -> np.ndarray:
    """Numbers of ids between checkpoints, for documents of `sizes` ids."""
    runs = -(-sizes // EVERY)
    number = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return np.minimum(np.repeat(sizes, runs) - number * EVERY, EVERY)


# --- writing


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, ids): packed ids with the end id."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(ByteWords, tokenizer)
        end = words.pack([end_id])
        for batch in batches:
            texts = batch.column("text")
            for low, high in row_slices(pc.binary_length(texts).to_pylist(), TEXT_BYTES):
                ids = [x + end for x in words.encode(texts.slice(low, high - low))]
                n = [len(x) // words.type.itemsize for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(n, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "n", "ids"],
                )

    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, ids binary")


def id_counts(tokens: DataFrame, size: int, width: int) -> DataFrame:
    """(id, n) over all documents."""
    prepare(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")
            total += np.bincount(ids, minlength=size)
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


BLOCK = (
    "shard bigint, number bigint, before bigint, n bigint, doc_ids array<bigint>, sizes array<bigint>, "
    "bits binary, checkpoints array<bigint>"
)
_numbers = pa.list_(pa.int64())
BLOCK_KINDS = [pa.int64()] * 4 + [_numbers] * 2 + [pa.binary(), _numbers]
BLOCK_NAMES = [field.split()[0] for field in BLOCK.split(", ")]


def to_blocks(tokens: DataFrame, lengths: np.ndarray, width: int, block_ids: int) -> DataFrame:
    """Documents of sorted rows as bits, joined to blocks that are counted in their task."""
    prepare(tokens.sparkSession)
    shared = tokens.sparkSession.sparkContext.broadcast(lengths.astype(np.uint8))  # a byte per id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, sizes, bits, marks, total, begin = [], [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            values = [
                shard, number, before, total, doc_ids, sizes, b"".join(bits), np.concatenate(marks)
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, BLOCK_KINDS)], BLOCK_NAMES)

        for batch in batches:
            counts = batch.column("n").to_numpy()
            for low, high in row_slices(counts.tolist(), SLICE_IDS):
                packed = batch.column("ids").slice(low, high - low).to_pylist()
                ids = np.frombuffer(b"".join(packed), f"<u{width}")
                names = batch.column("doc_id").slice(low, high - low).to_pylist()
                found = zip(names, counts[low:high].tolist(), *code.encode(ids, counts[low:high]))
                for doc_id, n, part, mark in found:
                    if sizes and total + n > block_ids:
                        yield block()
                        number, before = number + 1, before + total
                        doc_ids, sizes, bits, marks, total, begin = [], [], [], [], 0, 0
                    doc_ids.append(doc_id)
                    sizes.append(n)
                    bits.append(part)
                    marks.append(mark + 8 * begin)
                    total, begin = total + n, begin + len(part)
        if sizes:
            yield block()

    return tokens.select("doc_id", "n", "ids").mapInArrow(run, BLOCK)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    longest: int = LONGEST,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the file set of `docs` to `path`, which must not exist."""
    spark = docs.sparkSession
    size = _vocabulary(tokenizer, end_id)
    width = 2 if size <= 1 << 16 else 4
    with arrow_batches(spark, 10_000, "8m"):  # what is encoded, counted or written together
        tokens = materialize(tokenize(docs, tokenizer, end_id), "tokens")
        counts = np.zeros(size, np.int64)
        for row in id_counts(tokens, size, width).collect():  # a row per id of the vocabulary
            counts[row["id"]] = row["n"]
        lengths = code_lengths(counts, longest)
        used = [(i, n) for i, n in enumerate(lengths.tolist()) if n]
        spark.createDataFrame(used, "id bigint, length int").coalesce(1).write.parquet(f"{path}/code")
        # rows of one id are told apart by where the staged table has them
        order = [F.asc_nulls_first("doc_id"), F.asc("_row")]
        rows = tokens.withColumn("_row", F.monotonically_increasing_id())
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        to_blocks(rows, lengths, width, block_ids).write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("total"))
    running_offsets(totals, "shard", "total").select("shard", F.col("offset").alias("first")).coalesce(
        1
    ).write.parquet(f"{path}/shards")


def _vocabulary(path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max(*Tokenizer.from_file(path).get_vocab().values(), end_id) + 1


# --- reading


def read_code(spark: SparkSession, path: str) -> np.ndarray:
    """Lengths by id, at most one row per id of the vocabulary."""
    rows = spark.read.schema("id bigint, length int").parquet(f"{path}/code").collect()
    lengths = np.zeros(max((row["id"] for row in rows), default=0) + 1, np.uint8)
    for row in rows:
        lengths[row["id"]] = row["length"]
    return lengths


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with `first`: ids of the corpus before the block."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    shards = spark.read.schema("shard bigint, first bigint").parquet(f"{path}/shards")
    joined = blocks.join(F.broadcast(shards), "shard")  # a row per file
    return joined.withColumn("first", F.col("first") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; `ids` are little-endian unsigned 32-bit integers."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_code(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for low, high in row_slices(batch.column("n").to_pylist(), SLICE_IDS):
                part = batch.slice(low, high - low)
                raw = part.column("bits").to_pylist()
                sizes = part.column("sizes").flatten().to_numpy()
                docs = part.column("sizes").value_lengths().to_numpy()
                marks = part.column("checkpoints").flatten().to_numpy()
                lanes = part.column("checkpoints").value_lengths().to_numpy()
                base = np.cumsum([len(x) for x in raw]) - [len(x) for x in raw]
                ids = code.decode(b"".join(raw), marks + np.repeat(8 * base, lanes), runs_of(sizes))
                packed = ids.astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                edges = [0, *(4 * ends).tolist()]
                before = ends - sizes
                block = np.repeat(before[np.cumsum(docs) - docs], docs)
                start = np.repeat(part.column("first").to_numpy(), docs) + before - block
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_ids").flatten(),
                        pa.array(start),
                        pa.array(sizes),
                        pa.array([packed[a:b] for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    rows = _placed(spark, path).select("first", "n", "doc_ids", "sizes", "bits", "checkpoints")
    return rows.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_window(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """(place, ids): the corpus' ids from `begin` up to `end`, in pieces that lie next to each other.

    Only the blocks that hold them are read, and of these only what follows the nearest checkpoints.
    """
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_code(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                first = row.column("first")[0].as_py()
                counts = runs_of(row.column("sizes").flatten().to_numpy())
                marks = row.column("checkpoints").flatten().to_numpy()
                upto = first + np.cumsum(counts)
                wanted = (upto > begin) & (upto - counts < end)
                ids = code.decode(row.column("bits")[0].as_py(), marks[wanted], counts[wanted])
                place = int((upto - counts)[wanted][0])
                low, high = max(begin - place, 0), min(end - place, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([place + low], pa.int64()),
                        pa.array([ids[low:high].astype("<u4").tobytes()], pa.binary()),
                    ],
                    ["place", "ids"],
                )

    rows = _placed(spark, path).where((F.col("first") < end) & (F.col("first") + F.col("n") > begin))
    rows = rows.where(F.lit(begin < end)).select("first", "sizes", "bits", "checkpoints")
    return rows.mapInArrow(run, "place bigint, ids binary")
