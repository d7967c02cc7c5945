"""Operator 10: byte-level BPE, merged through a segment tree over the ranks of adjacent pairs.

Each leaf of the tree holds (rank of the pair that starts at a symbol, position); a node holds the
least of its two children, so the root is the leftmost pair of the lowest rank. A merge changes three
leaves: the merged symbol, the one it swallowed and the one before. Each is carried up to the root,
and merging goes on until the root says that no pair is left.

Short words of one power-of-two size are merged side by side, one tree per row of an array. Longer
ones are merged by the same steps in flat arrays, in n log n. Equal words are merged once per table of
`CACHED_WORDS` words in a worker.

Defined cases: a null text is empty and has no ids; special tokens in a text become their ids, as the
tokenizers library does; a null doc_id is kept; repeated rows give repeated rows; other columns are
ignored.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fovea.llm.common import prepare, row_slices, whole_text

CACHED_WORDS = 600_000
SLICE_BYTES = 1 << 20
#: Symbols of the longest words that are merged side by side.
WIDEST = 64
BATCH = 2048
NONE = np.int64(1 << 62)
PLACE_BITS = 20
#: Bits of a place in a long word, beside which a rank has room in 62.
LONG_BITS = 40

#: How this family of tokenizers cuts a text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: printable Latin-1
    characters stand for themselves, the others for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(byte if byte in plain else next(other)) for byte in range(256)]


class Bpe:
    """A byte-level BPE vocabulary with its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.of_byte = np.array([vocab[x] for x in symbols], np.int64)
        self.rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        byte_of = {x: byte for byte, x in enumerate(symbols)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        names = vocab | self.special
        self.bytes_of = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            known = all(x in byte_of for x in name)
            self.bytes_of[number] = bytes(byte_of[x] for x in name) if known else name.encode()
        self.words = regex.compile(WORDS)
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.cache: dict[str, bytes] = {}

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE for pairs that do not merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_many(self, words: list[bytes], size: int) -> list[bytes]:
        """Packed ids of words of 1 to `size` bytes; `size` is a power of two."""
        n = np.array([len(word) for word in words], np.int64)
        count = len(words)
        raw = np.frombuffer(b"".join(words), np.uint8)
        filled = np.arange(size) < n[:, None]
        token = np.full((count, size + 1), -1, np.int64)
        token[:, :size][filled] = self.of_byte[raw]
        following = np.tile(np.arange(1, size + 2), (count, 1))
        previous = np.tile(np.arange(-1, size), (count, 1))
        tree = np.full((count, 2 * size), NONE, np.int64)
        rows, at = np.nonzero(filled[:, 1:]) if size > 1 else (np.empty(0, int),) * 2
        rank = self.ranks_of(token[rows, at], token[rows, at + 1])
        tree[rows, size + at] = np.where(rank < NONE, rank << PLACE_BITS | at, NONE)
        level = size >> 1
        while level:
            children = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(children[:, ::2], children[:, 1::2])
            level >>= 1
        live = np.nonzero(tree[:, 1] < NONE)[0]
        while len(live):
            root = tree[live, 1]
            at, rank = root & ((1 << PLACE_BITS) - 1), root >> PLACE_BITS
            gone = following[live, at]
            after = following[live, gone]
            has_after = after < n[live]
            before = previous[live, at]
            has_before = before >= 0
            token[live, at] = self.merged[rank]
            token[live, gone] = -1
            following[live, at] = after
            previous[live[has_after], after[has_after]] = at[has_after]
            self._put(tree, size, live, gone, NONE)
            self._pair(tree, size, token, live, at, after, has_after)
            left = np.where(has_before, before, at)
            right = np.where(has_before, at, after)
            self._pair(tree, size, token, live, left, right, has_before | has_after)
            for place in (gone, at, left):
                node = (place + size) >> 1
                while node[0]:
                    tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] < NONE]
        kept = token >= 0
        packed = token[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    @staticmethod
    def _put(tree, size, rows, at, value) -> None:
        tree[rows, size + at] = value

    def _pair(self, tree, size, token, rows, left, right, exists) -> None:
        right = np.where(exists, right, left)
        rank = self.ranks_of(token[rows, left], token[rows, right])
        rank = np.where(exists, rank, NONE)
        self._put(tree, size, rows, left, np.where(rank < NONE, rank << PLACE_BITS | left, NONE))

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word of any length, by the same steps, in flat arrays: some 40 bytes for each of its own."""
        symbols = self.of_byte[np.frombuffer(word, np.uint8)]
        n = len(symbols)
        size = 1 << max(n - 1, 1).bit_length()
        none = 1 << 62
        leaves = np.full(size, none, np.int64)
        rank = self.ranks_of(symbols[:-1], symbols[1:])
        at = np.nonzero(rank < NONE)[0]
        leaves[at] = rank[at] << LONG_BITS | at
        tree = array("q", bytes(8 * size)) + array("q", leaves.tobytes())
        levels = np.frombuffer(tree, np.int64)
        level = size >> 1
        while level:
            np.minimum(levels[2 * level : 4 * level : 2], levels[2 * level + 1 : 4 * level : 2], out=levels[level : 2 * level])
            level >>= 1
        del levels
        token = array("i", symbols.astype(np.int32).tobytes())
        following = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        previous = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        rank_of, place = self.rank_of.get, (1 << LONG_BITS) - 1
        merged = self.merged.tolist()

        def put(i: int) -> None:
            """Leaf i anew, carried up as far as it changes something."""
            j = following[i]
            found = rank_of((token[i], token[j])) if token[i] >= 0 and j < n else None
            tree[size + i] = none if found is None else found << LONG_BITS | i
            node = size + i >> 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                a = a if a < b else b
                if tree[node] == a:
                    break
                tree[node] = a
                node >>= 1

        while tree[1] != none:
            i, found = tree[1] & place, tree[1] >> LONG_BITS
            j = following[i]
            token[i], token[j] = merged[found], -1
            following[i] = following[j]
            if following[j] < n:
                previous[following[j]] = i
            put(j)
            put(i)
            if previous[i] >= 0:
                put(previous[i])
        out = np.frombuffer(token, np.int32)
        return out[out >= 0]

    def learn(self, words: list[str]) -> None:
        """Put new words into the table."""
        raw = [word.encode() for word in words]
        lengths = np.array([len(x) for x in raw], np.int64)
        size = 2
        while size <= WIDEST:
            group = np.nonzero((lengths <= size) & (lengths > (size >> 1) * (size > 2)))[0].tolist()
            for low in range(0, len(group), BATCH):
                part = group[low : low + BATCH]
                ids = self.merge_many([raw[i] for i in part], size)
                self.cache.update(zip([words[i] for i in part], ids))
            size *= 2
        for i in np.nonzero(lengths > WIDEST)[0].tolist():
            self.cache[words[i]] = self.merge_long(raw[i]).astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        for name, number in self.special.items():
            self.cache[name] = np.array([number], "<u4").tobytes()
        find = self.words.findall
        split = []
        for text in texts:
            if self.split_special and any(name in text for name in self.special):
                words = []
                for k, part in enumerate(self.split_special.split(text)):
                    words += [part] if k % 2 else find(part)
            else:
                words = find(text)
            split.append(words)
        self.learn(list(set().union(*split).difference(self.cache)))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, numbers)).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids[, decoded]): `ids` packed little-endian unsigned 32-bit integers;
    `decoded` is the text that the ids decode to."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in row_slices(map(len, texts), SLICE_BYTES):
                ids = model.encode(texts[low:high])
                columns = [
                    batch.column("doc_id").slice(low, high - low),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array([model.decode(x) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_tokens bigint, ids binary" + ", decoded string" * decoded
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids)."""
    prepare(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(tokenizer)
        for batch in batches:
            texts = [model.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "decoded"]
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded string")
