"""Operator 1: text quality by a generalised additive model with pairwise interactions.

Numbers that describe a text (never its id, source, language column or labels) are cut into bins.
Boosting goes round the features in turn; each step fits a shallow tree on one feature's bins and adds
it to that feature's table. Then the pairs that explain most of what is left get tables of two
dimensions in the same way. A score is the sum of one cell of each table, by array lookups for a
whole batch of texts, put through the logistic function.

The model is fitted on the driver from at most `max_labelled` labelled rows (those with the least
hash of their id); everything else runs in tasks, one pass over the texts.

Defined cases: a null text is empty; empty texts are scored like any other; labels that are null or
neither 0 nor 1 are ignored; a document with several labels counts once for each; without usable
labels, or with only one kind, all scores are the share of label 1 among them (0.5 if none); null ids
are never labelled; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import prepare, row_slices, whole_text

MAX_LABELLED = 20_000
KEEP_FROM = 0.3
SLICE_BYTES = 1 << 20

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "distinct_words", "top_word",
    "repeated_next", "capitals", "capital_starts", "digits", "marks", "odd_marks", "bars",
    "marks_per_word", "wide_letters", "line_length", "repeated_lines", "short_lines", "sentences",
    "distinct_pairs",
)

CLASSES = np.zeros((256, 8), np.float64)
for _k, _members in enumerate(
    (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~",
        b"#$%&*+<=>@[\\]^_`{}~!",
        b"|",
        bytes(range(128, 256)),
        b".?!",
        b" \t\n\r\x0b\x0c",
    )
):
    CLASSES[list(_members), _k] = 1.0


def describe(text: bytes) -> list[float]:
    """The features of one whole text."""
    n = max(len(text), 1)
    upper, digit, mark, odd, bar, wide, stop, _ = (
        np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASSES
    )
    words = text.split()
    count = max(len(words), 1)
    kinds = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split(b"\n") if x]
    rows = max(len(lines), 1)
    pairs = max(len(words) - 1, 1)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        float(lengths.mean()) if words else 0.0,
        float((lengths > 15).mean()) if words else 0.0,
        len(kinds) / count,
        max(kinds.values(), default=0) / count,
        sum(map(bytes.__eq__, words, words[1:])) / pairs,
        upper / n,
        sum(map(bytes.istitle, words)) / count,
        digit / n,
        mark / n,
        odd / n,
        bar / count,
        mark / count,
        wide / n,
        np.log1p(n / rows),
        1 - len(set(lines)) / rows,
        sum(len(x) < 30 for x in lines) / rows,
        stop / count,
        len(set(zip(words, words[1:]))) / pairs,
    ]


def describe_all(texts: list[bytes]) -> np.ndarray:
    return np.array([describe(x) for x in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    """Bin edges of each feature, one table per feature, tables for pairs, and a constant."""

    edges: list[np.ndarray] = field(default_factory=list)
    constant: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1
        )

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.constant)
        if self.edges:
            bins = self.bins(x)
            for f, t in enumerate(self.tables):
                out += t[bins[:, f]]
            for (f, g), t in self.pairs.items():
                out += t[self.coarse[f][bins[:, f]], self.coarse[g][bins[:, g]]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cut(gain_g: np.ndarray, gain_h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best cut of bins into a left and a right part: (gain, first bin on the right)."""
    g, h = np.cumsum(gain_g), np.cumsum(gain_h)
    left = g[:-1] ** 2 / (h[:-1] + ridge)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
    if not len(left):
        return 0.0, 0
    at = int(np.argmax(left + right))
    return float(left[at] + right[at] - g[-1] ** 2 / (h[-1] + ridge)), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float, leaves: int = 4) -> np.ndarray:
    """A tree of a few leaves over ordered bins, as the value of each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_cut(g[a:b], h[a:b], ridge), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    value = np.zeros(len(g))
    for a, b in parts:
        value[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return value


def crossed_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The better of two trees of four leaves: cut one axis, then the other in either part."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        value, gain = np.zeros_like(a), 0.0
        _, at = _cut(a.sum(1), b.sum(1), ridge)
        for rows in (slice(0, at), slice(at, len(a))):
            ga, hb = a[rows].sum(0), b[rows].sum(0)
            _, k = _cut(ga, hb, ridge)
            for columns in (slice(0, k), slice(k, len(ga))):
                x, y = ga[columns].sum(), hb[columns].sum() + ridge
                value[rows, columns] = x / y
                gain += x * x / y
        if gain > best[0]:
            best = gain, value.T if flip else value
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 150,
    pair_rounds: int = 60,
    pairs: int = 8,
    bins: int = 32,
    rate: float = 0.15,
    ridge: float = 2.0,
) -> AdditiveModel:
    """Boost one table per feature in turn, then tables for the most useful pairs."""
    model = AdditiveModel()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.constant = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return model
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])]
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in size]
    where = model.bins(x)
    logit = np.full(len(y), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            sums = [np.bincount(where[:, f], v, size[f]) for v in (g, h)]
            step = rate * shallow_tree(*sums, ridge)
            table += step
            logit += step[where[:, f]]

    model.coarse = [np.arange(n) * min(n, 8) // n for n in size]
    rough = [c[where[:, f]] for f, c in enumerate(model.coarse)]
    shape = [min(n, 8) for n in size]

    def sums_of(f: int, g: int) -> list[np.ndarray]:
        cell = rough[f] * shape[g] + rough[g]
        n = shape[f] * shape[g]
        return [np.bincount(cell, v, n).reshape(shape[f], shape[g]) for v in slopes()]

    gains = {p: crossed_tree(*sums_of(*p), ridge)[0] for p in combinations(range(len(size)), 2)}
    for f, g in sorted(gains, key=gains.get, reverse=True)[:pairs]:
        model.pairs[f, g] = np.zeros((shape[f], shape[g]))
    for _ in range(pair_rounds):
        for (f, g), table in model.pairs.items():
            step = rate * crossed_tree(*sums_of(f, g), ridge)[1]
            table += step
            logit += step[rough[f], rough[g]]
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = describe_all(batch.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "features"],
            )

    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, features array<double>")


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED
) -> AdditiveModel:
    """Fit on at most `max_labelled` labelled documents that are not held out.

    The labels are broadcast after the limit, so the broadcast has at most `max_labelled` small rows.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
    chosen = (
        usable.select("doc_id", F.col(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_label")
        .limit(max_labelled)
    )
    ids = chosen.select("doc_id").distinct()
    known = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    known = features(known).dropDuplicates(["doc_id"])
    rows = known.join(F.broadcast(chosen), "doc_id").select("_label", "features").collect()
    rows.sort(key=lambda row: (row["features"], row["_label"]))
    x = np.array([row["features"] for row in rows], np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array([row["_label"] for row in rows], np.float64))


def score(docs: DataFrame, model: AdditiveModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every document with its score."""
    prepare(docs.sparkSession)
    schema = docs.select(*keep).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            found = [np.empty(0)]
            for low, high in row_slices(map(len, texts), SLICE_BYTES):
                found.append(model.scores(describe_all(texts[low:high])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(np.concatenate(found))],
                [*keep, "score"],
            )

    rows = docs.select(*keep, whole_text().alias("_text"))
    return rows.mapInArrow(run, schema)
