"""Operator 11: documents drawn by importance, so that their words look like those of a target text set.

Features are runs of consecutive words, hashed into buckets by CRC-32. A bucket's gain is the log ratio of
its smoothed share in the target to that in the corpus; a document's weight is the sum of its features'
gains. Adding Gumbel noise that depends on the id alone to the weight and keeping the highest scores draws
documents without replacement with probabilities in proportion to exp(weight / 1000).

CRC-32 is linear but for a constant that depends on the length: the checksum of m bytes is the XOR of one
contribution per byte, which depends on the byte and its distance from the end, and of the checksum of m
zero bytes. A batch is one array of bytes in which words are parted by single spaces; contributions are
looked up in a table by position for all features at once and folded by `bitwise_xor.reduceat`. Features
longer than the table are cut into blocks of its size, counted from their end; neighbouring blocks are
folded pairwise, the left one moved past the right one by tables of that distance, until one is left.

Two passes read the texts: one counts buckets in tasks (what is shuffled is at most a row per bucket and
task), one sums gains. The gains, one number per bucket, are all that is collected and sent to tasks. Ranks
come from a sort of (score, id) over all tasks and an offset per task.

Defined cases: a null or empty text has no features and weight 0; a null doc_id counts as the empty text in
the noise and comes after all others among equal scores; rows equal in all that decides are drawn one by
one; an empty table gives no rows, and without a target every gain stems from the smoothing; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import materialize, prepare, row_slices, running_offsets, whole_text

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 1
LEAST_WORDS = 20
DRAWN_PERCENT = 10
SEED = 2024
SLICE_BYTES = 1 << 21
#: Bytes from a feature's end that the table covers; a power of two.
REACH = 64


class PositionTable:
    """Contributions to CRC-32 by distance from the end and byte."""

    def __init__(self, reach: int = REACH):
        self.reach = reach
        # a register after one more zero byte, by its lowest byte
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, step >> 1 ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
        self.step = step
        rows = [step]
        for _ in range(reach - 1):
            rows.append(step[rows[-1] & 0xFF] ^ rows[-1] >> 8)
        self.by_distance = np.stack(rows)
        self.flat = self.by_distance.ravel()
        #: moves[j] carries a register past reach * 2**j bytes, by each of its four bytes
        self.moves = [self._move_of_reach()]
        self.zeros = np.array([zlib.crc32(bytes(n)) for n in range(reach + 1)], np.uint32)

    def _move_of_reach(self) -> np.ndarray:
        register = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for _ in range(self.reach):
            register = self.step[register & 0xFF] ^ register >> 8
        return register

    def move(self, register: np.ndarray, level: int) -> np.ndarray:
        """Registers after reach * 2**level zero bytes."""
        while len(self.moves) <= level:  # twice the distance is the same move done twice
            self.moves.append(self._apply(self.moves[-1], self.moves[-1]))
        return self._apply(self.moves[level], register)

    @staticmethod
    def _apply(move: np.ndarray, register: np.ndarray) -> np.ndarray:
        out = move[0][register & 0xFF]
        for k in (1, 2, 3):
            out = out ^ move[k][register >> 8 * k & 0xFF]
        return out

    def constants(self, lengths: np.ndarray) -> np.ndarray:
        """Checksums of as many zero bytes."""
        out = self.zeros[np.minimum(lengths, self.reach)]
        for i in np.nonzero(lengths > self.reach)[0].tolist():
            out[i] = self._zero_checksum(int(lengths[i]))
        return out

    def _zero_checksum(self, n: int) -> int:
        """The start register moved past `n` zero bytes, by the powers of two in n."""
        register = np.array([0xFFFFFFFF], np.uint32)
        for _ in range(n % self.reach):
            register = self.step[register & 0xFF] ^ register >> 8
        blocks, level = n // self.reach, 0
        while blocks:
            if blocks & 1:
                register = self.move(register, level)
            blocks, level = blocks >> 1, level + 1
        return int(register[0]) ^ 0xFFFFFFFF

    def _fold(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Contributions of spans of 1 to `reach` bytes, folded; spans may overlap."""
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        distance = np.repeat(first + lengths, lengths) - 1 - np.arange(lengths.sum())
        at = np.repeat(ends, lengths) - 1 - distance
        parts = self.flat[(distance << 8) + raw[at]]
        return np.bitwise_xor.reduceat(parts, first)

    def checksums(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of raw[start:end] for each span of at least one byte."""
        if not len(starts):
            return np.empty(0, np.uint32)
        lengths = ends - starts
        linear = np.empty(len(starts), np.uint32)
        short = lengths <= self.reach
        if short.any():
            linear[short] = self._fold(raw, starts[short], ends[short])
        long = np.nonzero(~short)[0]
        if len(long):
            linear[long] = self._fold_long(raw, starts[long], ends[long])
        return linear ^ self.constants(lengths)

    def _fold_long(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        blocks = -(-(ends - starts) // self.reach)
        span = np.repeat(np.arange(len(starts)), blocks)
        # blocks of a span are counted from its end, which is what distances are counted from
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        block_end = ends[span] - number * self.reach
        value = self._fold(raw, np.maximum(block_end - self.reach, starts[span]), block_end)
        level = 0
        while number.max() > 0:
            left = number & 1 == 1
            value[np.nonzero(left)[0] - 1] ^= self.move(value[left], level)
            value, span, number = value[~left], span[~left], number[~left] >> 1
            level += 1
        return value


def _letters() -> np.ndarray:
    """What each byte is in a word: itself, the small letter of a capital, or 0 between words."""
    table = np.zeros(256, np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


LETTERS = _letters()
_tables: dict[int, PositionTable] = {}


def position_table(reach: int = REACH) -> PositionTable:
    if reach not in _tables:
        _tables[reach] = PositionTable(reach)
    return _tables[reach]


def feature_hashes(texts: list[bytes], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, checksum, words): the row and CRC-32 of every feature, and each row's number of words."""
    raw = LETTERS[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    lengths = np.array([len(x) + 1 for x in texts], np.int64)
    stops = np.cumsum(lengths)
    letter = raw > 0
    # of what lies between two words one byte is kept, as the space that joins them in a feature
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    place = np.cumsum(kept) - kept
    packed = np.where(letter, raw, 32)[kept]
    edge = np.diff(letter.astype(np.int8), prepend=0)
    begins, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    row = np.searchsorted(stops, begins, "right")
    words = np.bincount(row, minlength=len(texts))
    starts, finish = place[begins], place[ends]
    table, rows, sums = position_table(), [], []
    for n in range(1, run + 1):
        last = np.arange(n - 1, len(row))
        first = last - (n - 1)
        same = row[first] == row[last]
        rows.append(row[first[same]])
        sums.append(table.checksums(packed, starts[first[same]], finish[last[same]]))
    return np.concatenate(rows), np.concatenate(sums), words


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for low, high in row_slices(map(len, texts), SLICE_BYTES):
        yield low, high, texts[low:high]


def bucket_counts(docs: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts, buckets without features left out."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in _batches(batch):
                _, sums, _ = feature_hashes(texts, run)
                total += np.bincount(sums % np.uint32(buckets), minlength=buckets)
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    rows = docs.select(whole_text().alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket from both sides' (bucket, n)."""
    spark = corpus.sparkSession
    sides = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    )
    every = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    counts = materialize(
        sides.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")),
        "buckets",
    )
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    number = lambda name, more: (F.col(name) + more).cast("double")
    ratio = number("t", 1) * number("all_s", buckets) / (number("s", 1) * number("all_t", buckets))
    return counts.join(F.broadcast(totals), F.lit(True)).select(  # one row
        "bucket", F.floor(F.log(ratio) * 1000.0).cast("bigint").alias("gain")
    )


def noise(seed: int = SEED, key: str = "doc_id") -> Column:
    """floor(-1000 * ln(-ln(u))), u from the id's hash alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0).cast("bigint")


def weigh(docs: DataFrame, gain_of: np.ndarray, run: int = RUN) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain_of)  # a number per bucket

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for low, high, texts in _batches(batch):
                row, sums, words = feature_hashes(texts, run)
                order = np.argsort(row, kind="stable") if run > 1 else slice(None)
                row, value = row[order], gain[sums[order] % np.uint32(len(gain))]
                total = np.concatenate([[0], np.cumsum(value)])
                n = np.bincount(row, minlength=high - low)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low)]
                    + [pa.array(x.astype(np.int64)) for x in (n, words, total[ends] - total[ends - n])],
                    ["doc_id", "n_features", "n_words", "weight"],
                )

    schema = "doc_id bigint, n_features bigint, n_words bigint, weight bigint"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(sum_up, schema)


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """`rows` with `rank`: 1, 2, 3 ... by falling score, then id, for the first `drawn`."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_row")]
    placed = rows.withColumn("_row", F.monotonically_increasing_id())  # parts rows that are equal
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "by-score")
    task, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_task", task).withColumn("_at", at + 1)
    totals = placed.groupBy("_task").agg(F.count("*").alias("_total"))
    offsets = running_offsets(totals, "_task", "_total")
    rank = F.col("_at") + F.col("offset")
    found = placed.join(F.broadcast(offsets), "_task")  # a row per task that sorted
    return found.withColumn("rank", F.when(rank <= drawn, rank)).drop("_row", "_place", "_task", "_at", "offset")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; `rank` is null where it was not drawn.

    Drawn are `percent` of the documents of at least `least_words` words, those of the highest score.
    """
    found = gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets), buckets)
    gain_of = np.zeros(buckets, np.int64)
    for row in found.collect():  # one row per bucket
        gain_of[row["bucket"]] = row["gain"]
    scored = weigh(docs, gain_of, run).withColumn("score", F.col("weight") + noise(seed))
    scored = materialize(scored, "scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked(able, drawn).unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
