"""Operator 3: I-Match fingerprints from randomised lexicons.

The lexicon holds the terms whose inverse document frequency over all documents lies in a band. A
fingerprint takes a text's distinct terms of the lexicon in sorted order and hashes, for each of
several random subsets of the lexicon, those in the subset. Subsets come in scales: one of scale s
holds each term with probability 2^-s. A text with about 2^s terms is hashed with the subsets of scales
s+1 to s+3, which take about one of its terms each, or none; so whatever the length, a small change
leaves many of the hashes as they are. Likeness is the share of equal hashes at the scales both texts have.

The lexicon has at most e^max_idf times as many terms as a document has distinct terms on average,
however many documents there are; so it is collected and shipped to tasks.

Defined cases: a null text is empty; a text without words has the fingerprint `empty`, one without terms of
the lexicon is hashed in the same way with all its distinct terms, and is like none that has some; equal texts have equal fingerprints and likeness 1; null
ids sort after all others; among rows with one id the order is that of a hash of the text; the only
document is its own next one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fovea.llm.common import prepare, whole_text

MIN_IDF, MAX_IDF = 1.5, 7.0
SUBSETS = 32
SCALES = 3
HELD_TERMS = 200_000
#: ASCII punctuation separates terms.
SPACED = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))
MASK = np.uint64(0xFFFF)


def terms(text: str) -> list[bytes]:
    """Small-letter words without ASCII punctuation."""
    return text.lower().encode().translate(SPACED).split()


def term_hash(term: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")


def mix(x: np.ndarray) -> np.ndarray:
    """A mixing bijection of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df): counted in tasks first, then over all."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "df"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(set(terms(text)))
                if len(held) > HELD_TERMS:
                    yield out()
        yield out()

    counts = docs.select(whole_text().alias("text")).mapInArrow(run, "term binary, df bigint")
    return counts.groupBy("term").agg(F.sum("df").alias("df"))


@dataclass
class Lexicon:
    """Sorted terms of the band."""

    terms: list[bytes]
    subsets: int = SUBSETS

    def load(self) -> Loaded:
        return Loaded(self)


class Loaded:
    """A lexicon as tables in a worker."""

    def __init__(self, lexicon: Lexicon):
        self.place = {term: i for i, term in enumerate(lexicon.terms)}
        self.hash = np.array([term_hash(x) for x in lexicon.terms], np.uint64)
        self.subsets = lexicon.subsets
        self.seeds = mix(np.arange(1, lexicon.subsets + 1, dtype=np.uint64))
        self.level = self._levels(self.hash)

    def _levels(self, hashes: np.ndarray) -> np.ndarray:
        """A term is in subset k of all scales up to its level there."""
        drawn = mix(hashes[:, None] ^ self.seeds) >> np.uint64(11)
        return 53 - np.frexp(drawn.astype(np.float64))[1].astype(np.int8)

    def _hashes(self, hashes: np.ndarray, level: np.ndarray, mark: str = "") -> str:
        """Hashes of the terms in each subset, 0 for those that hold none, at the scales for so many terms."""
        scale = int(math.log2(len(hashes)))
        term, subset = np.nonzero(level > scale)
        level = level[term, subset]
        with np.errstate(over="ignore"):
            value = mix(hashes[term] + self.seeds[subset])
        out = []
        for s in range(scale + 1, scale + 1 + SCALES):
            held = level >= s
            total = np.zeros(self.subsets, np.uint64)
            # terms are distinct, so equal sets give equal sums of their mixed hashes
            np.add.at(total, subset[held], value[held])
            some = np.bincount(subset[held], minlength=self.subsets) > 0
            short = np.where(some, np.maximum(mix(total) & MASK, 1), 0)
            out.append(f"{mark}{s}:{short.astype('>u2').tobytes().hex()}")
        return ";".join(out)

    def fingerprint(self, text: str) -> str:
        distinct = set(terms(text))
        if not distinct:
            return "empty"
        places = np.array(sorted(self.place[x] for x in distinct & self.place.keys()), np.int64)
        if not len(places):
            # no term of the band: all terms take part, each by its own hash
            hashes = np.array(sorted(map(term_hash, distinct)), np.uint64)
            return self._hashes(hashes, self._levels(hashes), "all")
        return self._hashes(self.hash[places], self.level[places])


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets in which either text has terms."""
    if a == b:
        return 1.0
    if ";" not in a or ";" not in b:
        return 0.0
    x, y = (dict(part.split(":") for part in z.split(";")) for z in (a, b))
    same = used = 0
    for scale in x.keys() & y.keys():
        p, q = (np.frombuffer(bytes.fromhex(z[scale]), ">u2") for z in (x, y))
        used += int(((p > 0) | (q > 0)).sum())
        same += int(((p == q) & (p > 0)).sum())
    return same / used if used else 0.0


def build_lexicon(
    docs: DataFrame, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF, subsets: int = SUBSETS
) -> Lexicon:
    """Terms whose ln(documents / document frequency) lies in [min_idf, max_idf]."""
    n = docs.count()
    band = document_frequencies(docs).where(
        (F.col("df") >= n * math.exp(-max_idf)) & (F.col("df") <= n * math.exp(-min_idf))
    )
    return Lexicon(sorted(bytes(row["term"]) for row in band.select("term").collect()), subsets)


def fingerprints(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, fingerprint)."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = sent.value.load()
        for batch in batches:
            found = [loaded.fingerprint(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"]
            )

    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fingerprint string")


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, place, doc_id, text, next_text, tail) in descending order of ids.

    Ids are cut into buckets of about equal size. The first document of each bucket is also sent to
    the bucket before it as a `tail` row, which only serves as the next one of that bucket's last row.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = docs.select(
        "doc_id", whole_text().alias("text"), key.alias("_key"),
    )
    cuts = rows.select("_key").agg(
        F.percentile_approx("_key", [k / buckets for k in range(1, buckets)], 100 * buckets)
    ).first()[0] if buckets > 1 else []
    cuts = sorted(set(cuts or []))
    known = F.array(*map(F.lit, cuts)) if cuts else None
    bucket = F.lit(0) if known is None else F.size(F.filter(known, lambda c: c < F.col("_key")))
    rows = rows.withColumn("bucket", bucket)
    heads = rows.groupBy("bucket").agg(F.max("_key").alias("_key")).collect()  # one row a bucket
    order = sorted((row["bucket"], row["_key"]) for row in heads)
    before = {key: order[(k + 1) % len(order)][0] for k, (_, key) in enumerate(order)}
    pairs = [(key, to) for key, to in before.items()]
    extra = spark.createDataFrame(pairs, "_key bigint, _to int")
    rows = rows.join(F.broadcast(extra), "_key", "left")
    own = F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(0).alias("tail"))
    tail = F.struct(F.col("_to").alias("bucket"), F.lit(1).alias("tail"))
    places = F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, tail))
    spread = rows.select("doc_id", "text", "_key", F.explode(places).alias("_at")).select(
        "doc_id", "text", "_key", "_at.bucket", "_at.tail"
    )
    falling = Window.partitionBy("bucket").orderBy("tail", F.desc("_key"), F.xxhash64("text"))
    return spread.withColumn("next_text", F.lead("text").over(falling)).drop("_key")


def compare_edited(docs: DataFrame, lexicon: Lexicon, buckets: int) -> DataFrame:
    """Fingerprints of texts and of texts whose last third is replaced by the start of the next one.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    """
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)
    )
    rows = with_next(docs, buckets).select(
        "bucket", "tail", "doc_id", n.cast("bigint").alias("n_chars"), "text",
        F.when(F.col("tail") == 0, edited).alias("edited"),
    )
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]
    taken = ["bucket", "tail", "doc_id", "n_chars", "text", "edited", "edited_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = sent.value.load()
        last = None  # a row of the batch before whose next one has not come yet

        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(x).to_pylist() for x in taken]
            for bucket, tail, doc_id, chars, text, changed, sha in zip(*columns):
                own = loaded.fingerprint(text)
                if last is not None and last[0] == bucket:
                    out.append((*last[1:], likeness(last[4], own)))
                last = None
                if not tail:
                    other = loaded.fingerprint(changed)
                    last = (bucket, doc_id, chars, sha, own, other, likeness(own, other))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), KINDS)], names
                )

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return rows.mapInArrow(run, schema)


KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
