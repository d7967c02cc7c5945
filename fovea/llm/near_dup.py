"""Operator 6: near-duplicates by circulant MinHash.

A text's distinct word shingles are put at random places of a circle (the first permutation, sigma). All
signature coordinates come from one second permutation pi: coordinate k is the least pi of the places shifted
by k. Bands of equal coordinates give buckets; the threshold fixes how many coordinates, so that a
pair at the threshold is missed with probability 1e-7 at most.

Texts with equal shingle sets are one class, of which the smallest id goes on. In each bucket every member
is compared with one leader, the text whose buckets are largest in total: the original among its copies. First each
member meets its most central leader, then the others of other components. What may still be missed are
links between components that share a bucket. For those, exact prefix filtering over the members of such buckets takes the
place of pairs: two sets that are similar enough share one of their rarest shingles, early enough in both.
So a group of copies is never paired with itself, and no link that a bucket shows is lost. Links are
confirmed on the full sets of shingles, taken from the texts. Components come from repeated
contraction to the smallest neighbour. What a join meets on a key
that may be hot is written first: two shuffled tables let Spark split the hot key.

Defined cases: texts that are null, empty or without words have no shingles and no links; with fewer words
than a shingle has, the words are one shingle; a null id has no links and is kept; rows of one id are
one document, linked by any of its texts; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fovea.llm.common import arrow_batches, materialize, prepare, whole_text

WORDS, PERCENT = 3, 85
MISSED = 1e-7
MOST_COORDINATES = 144
#: Sizes of shingle sets are told apart in steps of this factor where prefixes are joined.
SIZE_STEP = 1.05
BLOCK = 4096
#: Rows and bytes that go to a Python worker at a time: pairs come with both their texts.
BATCH_ROWS, BATCH_BYTES = 1024, "8m"


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, coordinates per band): the narrowest buckets that miss a pair with chance `MISSED`."""
    t = min(percent / 100, 0.99)
    best = (math.ceil(math.log(MISSED) / math.log(1 - t)), 1)
    for rows in range(2, 9):
        bands = math.ceil(math.log(MISSED) / math.log(1 - t**rows))
        if bands * rows <= MOST_COORDINATES:
            best = bands, rows
    return best


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def shingles(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if not words:
        return set()
    if len(words) <= size:
        return {tuple(words)}
    return set(zip(*(words[k:] for k in range(size))))


def linked(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    mixed = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            mixed = _mix64(mixed + own[k : k + n])
    return np.unique(mixed)


def pi(x: np.ndarray) -> np.ndarray:
    """The second permutation, of the 2^32 places."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Coordinate k: the least pi over the shingles' places shifted by k round the circle."""
    places = (_mix64(hashes) >> np.uint64(32)).astype(np.uint32)  # sigma
    shifts = np.arange(1, coordinates + 1, dtype=np.uint32)[:, None]
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for low in range(0, len(places), BLOCK):
            np.minimum(out, pi(places[low : low + BLOCK] + shifts).min(1), out=out)
    return out


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, class, bands): the class is a hash of the whole shingle set."""
    prepare(docs.sparkSession)
    bands, rows = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, classes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, words)
                n.append(len(hashes))
                if not len(hashes):
                    classes.append(None)
                    keys.append(None)
                    continue
                classes.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                band = signature(hashes, bands * rows).reshape(bands, rows).astype(np.uint64)
                mixed = np.arange(bands, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(rows):
                        mixed = _mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + band[:, k])
                keys.append(mixed.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "class", "bands"],
            )

    schema = "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>"
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, schema)


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are linked, by their full shingle sets."""
    prepare(pairs.sparkSession)
    left = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    rows = pairs.join(left, "b").join(right, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, set()
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if x != last_text:
                    last_text, last = x, shingles(x, words)
                kept.append(linked(last, shingles(y, words), percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return rows.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of (a, b) can reach, roots not listed.

    Each round links every larger neighbour of a node to its smallest one, then every node and its smaller
    neighbours to the smallest of them; it ends when the edges are stars.
    """
    # a is the smaller end throughout
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges = materialize(edges.distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = materialize(least.select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
        large = large.where("a < b").distinct()
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lower, "b").select(
            F.inline(
                F.array(
                    F.struct(F.col("m").alias("a"), F.col("b").alias("b")),
                    F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                )
            )
        )
        edges = materialize(small.where("a < b").distinct(), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node is either a root or linked to one root and to nothing else."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down"))
    return nodes.where("down > 1 or down = 1 and up = 1").isEmpty()


def similar_prefixes(rows: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): pairs of (doc_id, root) with different roots that can be similar enough, by their prefixes.

    Shingles are put in one order for all texts, rarest first. If two sets share `percent` of their union,
    their first common shingle is among the first n - ceil(n * percent / 100) + 1 of either, and enough
    others follow it in both. Sizes that fit are part of what is joined, so that texts of one template that
    are all just too different meet no one.
    """
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(x or "", words).view(np.int64) for x in batch.column("text").to_pylist()]
            hashes = pa.array(sets, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("root"), hashes], ["doc_id", "root", "hashes"]
            )

    schema = "doc_id bigint, root bigint, hashes array<bigint>"
    sets = rows.join(texts, "doc_id").select("doc_id", "root", "text").mapInArrow(run, schema)
    # a text is told apart by its shingles too: an id may have several
    sets = materialize(sets.withColumn("set", F.xxhash64("hashes")), "sets")
    spread = sets.select("doc_id", "root", "set", F.size("hashes").alias("n"), F.explode("hashes").alias("s"))
    often = spread.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    often = materialize(often, "frequencies")
    ranked = (
        spread.join(often, "s", "left")
        .groupBy("doc_id", "root", "set", "n")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "s"))).alias("all"))
    )
    first = F.slice("all", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    prefixes = ranked.select("doc_id", "root", "n", F.posexplode(first).alias("at", "shingle"))
    # a shingle of one text alone has no one to meet
    prefixes = prefixes.where("shingle.df > 1").select("doc_id", "root", "n", "at", F.col("shingle.s").alias("s"))
    prefixes = materialize(prefixes, "prefixes")
    # what is common from a place on is at most what is left there: that bounds the other text's size
    left = (100 + percent) * (F.col("n") - F.col("at"))
    prefixes = prefixes.withColumn("most", F.floor(left / percent).cast("bigint") - F.col("n"))
    size_class = lambda size: F.floor(F.log(size) / math.log(SIZE_STEP)).cast("int")
    # of a pair the smaller one looks, among the sizes it can match; most places cannot match their own size
    small = prefixes.where("most >= n").withColumn(
        "sizes", F.explode(F.sequence(size_class(F.col("n")), size_class(F.col("most"))))
    )
    large = prefixes.where(100 * F.col("most") >= percent * F.col("n")).select(
        F.col("s").alias("s_b"), F.col("doc_id").alias("b"), F.col("root").alias("root_b"),
        F.col("n").alias("m"), F.col("most").alias("most_b"), size_class(F.col("n")).alias("sizes_b"),
    )
    meet = (F.col("s") == F.col("s_b")) & (F.col("sizes") == F.col("sizes_b"))
    fits = (F.col("n") <= F.col("m")) & (F.col("m") <= F.col("most")) & (F.col("n") <= F.col("most_b"))
    apart = (F.col("doc_id") != F.col("b")) & (F.col("root") != F.col("root_b"))
    pair = (F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b"))
    return small.join(large, meet & fits & apart).select(*pair).distinct()


def _labelled(rows: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    named = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(named, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    rows = _labelled(_labelled(pairs, roots, "a", "_a"), roots, "b", "_b")
    return rows.where("_a <> _b").drop("_a", "_b")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; links have 100 * both >= percent * either.

    All that needs Python is computed here, into staged tables: the result is joins of these.
    """
    with arrow_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _near_duplicates(docs, words, percent)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    signed = materialize(signatures(docs, words, percent), "signatures")
    usable = signed.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(usable.groupBy("class").agg(F.min("doc_id").alias("first")), "classes")
    ones = usable.join(classes, "class")
    firsts = ones.where("doc_id = first").dropDuplicates(["class"])
    banded = firsts.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.count("*").alias("size"))
    buckets = materialize(buckets.where("size > 1"), "buckets")
    members = materialize(
        banded.join(buckets, ["band", "key"]).select("band", "key", "doc_id", "n_shingles", "size"), "members"
    )
    # the larger a text's buckets, the more copies it is an original of
    weights = members.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    weighed = members.join(weights, "doc_id").withColumn("by", F.struct("weight", -F.col("doc_id")))
    leaders = weighed.groupBy("band", "key").agg(
        F.max_by("doc_id", "by").alias("leader"), F.max("by").alias("by")
    )
    members = materialize(
        members.join(materialize(leaders, "leaders"), ["band", "key"]).drop("size"), "members"
    )
    texts = materialize(
        docs.select("doc_id", "text").join(members.select("doc_id").distinct(), "doc_id", "left_semi"),
        "candidate-texts",
    )
    led = members.where("doc_id <> leader")
    pair = (F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b"))

    main = led.groupBy("doc_id").agg(F.max_by("leader", "by").alias("leader")).select(*pair).distinct()
    tried = materialize(main, "pairs")
    links = materialize(confirm(tried, texts, words, percent), "links")
    roots = components(links)
    others = led.select(*pair).distinct().join(tried, ["a", "b"], "left_anti")
    second = materialize(_apart(others, roots), "pairs")
    more = materialize(confirm(second, texts, words, percent), "links")
    roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more))

    placed = _labelled(members.select("band", "key", "doc_id"), roots, "doc_id", "root")
    placed = materialize(placed, "members")
    mixed = placed.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = materialize(mixed.where("low <> high").drop("low", "high"), "buckets")
    open_ones = materialize(
        placed.join(mixed, ["band", "key"]).select("doc_id", "root").distinct(), "open"
    )
    rest = similar_prefixes(open_ones, texts, words, percent)
    rest = rest.join(tried.unionByName(second), ["a", "b"], "left_anti")
    last = materialize(confirm(materialize(rest, "pairs"), texts, words, percent), "links")
    # an id with several texts joins their classes
    firsts_of = ones.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("z"))
    several = materialize(firsts_of.where("a <> z").drop("z"), "several")
    shared = ones.select("doc_id", F.col("first").alias("b")).join(several, "doc_id").select("a", "b")
    found = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(found.unionByName(last).unionByName(shared))
    rows = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    rows = rows.join(classes, "class", "left").withColumn("first", F.coalesce("first", "doc_id"))
    rows = _labelled(rows, roots, "first", "component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return rows.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
