"""Operator 8: concatenate and cut documents into token sequences of one length.

All documents' token ids, each document followed by an end id, are thought of as one long stream
that is cut every `window` ids. Two passes find where a document begins in the stream:

1. Each task tokenizes its rows and writes them with the number of ids before them in the task.
2. The tasks' totals are summed up to one offset per task; a row's place is offset plus count.

The ids are never shuffled. A document that crosses a cut gets one boundary row on either side. All
sequences are full but the last one of the whole stream.

Defined cases: a null or empty text is the end id alone; a null doc_id is kept; repeated rows are
packed as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import arrow_batches, materialize, prepare, row_slices, running_offsets, whole_text
from fovea.llm.words import LowerWords, word_table

WINDOW = 4096
END_ID = 2
#: Bytes of text that are cut into words at a time, and ids that are cut into pieces.
TEXT_BYTES = 1 << 22
#: Rows and bytes that a task sends to its Python worker at a time while it tokenizes.
BATCH_ROWS, BATCH_BYTES = 10_000, "4m"
SLICE_IDS = 1 << 20


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, task, before, n, ids): packed ids with the end id, and the ids before them in the task."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(LowerWords, tokenizer)
        end = words.pack([end_id])
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            for low, high in row_slices(pc.binary_length(texts).to_pylist(), TEXT_BYTES):
                ids = [x + end for x in words.encode(texts.slice(low, high - low))]
                n = np.array([len(x) for x in ids], np.int64) // words.type.itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(np.full(high - low, task)),
                        pa.array(before + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "task", "before", "n", "ids"],
                )
                before += int(n.sum())

    schema = "doc_id bigint, task bigint, before bigint, n bigint, ids binary"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema)


def cut(tokens: DataFrame, width: int, window: int) -> DataFrame:
    """Pieces of rows (doc_id, place, n, ids): each ends at its document's end or at a cut."""
    prepare(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            n = batch.column("n").to_numpy()
            pieces = (place + n - 1) // window - place // window + 1
            for low, high in row_slices(n.tolist(), SLICE_IDS):
                row = np.repeat(np.arange(low, high), pieces[low:high])
                first = np.cumsum(pieces[low:high]) - pieces[low:high]
                sequence = place[row] // window + np.arange(len(row)) - first[row - low]
                begin = np.maximum(sequence * window, place[row])
                length = np.minimum((sequence + 1) * window, place[row] + n[row]) - begin
                start = begin - place[row]
                packed = batch.column("ids").slice(low, high - low).to_pylist()
                ids = [
                    np.frombuffer(packed[r - low], f"<u{width}", m, s * width).astype("<u4").tobytes()
                    for r, s, m in zip(row.tolist(), start.tolist(), length.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(ids, pa.binary()),
                        pa.array(n[row]),
                        pa.array(sequence),
                        pa.array(begin - sequence * window),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    schema = (
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    return tokens.mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    `ids` are little-endian unsigned 32-bit integers; `start` counts within the document, `offset`
    within the sequence. The broadcast offsets are one row for each task that tokenized.
    """
    width = 2 if _vocabulary(tokenizer) <= 1 << 16 else 4
    with arrow_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        staged = materialize(tokenize(docs, tokenizer, end_id), "tokens")
    totals = staged.groupBy("task").agg(F.sum("n").alias("total"))
    offsets = running_offsets(totals, "task", "total")
    placed = staged.join(F.broadcast(offsets), "task").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("place"), "n", "ids"
    )
    return cut(placed, width, window)


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
