"""Importance resampling, token files and centroids."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import documents, no_documents, odd_documents, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fovea.llm import centroids, importance, queries, token_files
from fovea.llm.common import tokenizer_path

BYTE = tokenizer_path("byte_bpe_50k.json")

# --- importance


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=700), min_size=1, max_size=12), st.sampled_from([1, 4, 64]))
def test_position_table_is_crc32(spans, reach):
    raw = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(x) for x in spans])
    starts = ends - [len(x) for x in spans]
    found = importance.PositionTable(reach).checksums(raw, starts, ends)
    assert found.tolist() == [zlib.crc32(x) for x in spans]


def test_a_long_span_is_folded():
    raw = np.random.default_rng(0).integers(0, 256, 3_000_001).astype(np.uint8)
    found = importance.position_table().checksums(raw, np.array([1, 0]), np.array([3_000_001, 65]))
    assert found.tolist() == [zlib.crc32(raw[1:].tobytes()), zlib.crc32(raw[:65].tobytes())]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(small)


def plain_features(text, run):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]


TEXTS = st.text(alphabet=st.sampled_from(list("aZ09 -_'\n\x00\x7f\x80é漢😀[`{@/:")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=6), st.integers(1, 3))
def test_features_of_a_batch(texts, run):  # noqa: F811
    row, sums, words = importance.feature_hashes([t.encode() for t in texts], run)
    expected = Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in plain_features(t, run))
    assert Counter(zip(row.tolist(), sums.tolist())) == expected
    assert words.tolist() == [len(plain_words(t)) for t in texts]


def plain_resample(docs, target, percent, least, run, buckets, seed):
    """Row by row, with the standard library's CRC-32."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, plain_features(text, run)))
    for text in target:
        t.update(map(bucket, plain_features(text, run)))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    }
    rows = []
    for i, text in docs:
        features = plain_features(text, run)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(features), weight, score, len(plain_words(text)) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k for k, r in enumerate(able[: len(able) * percent // 100], 1)}
    return Counter((*r[:4], rank.get(id(r))) for r in rows)


@pytest.mark.parametrize("run", [1, 2])
def test_resampling_is_brute_force(spark, texts, odd_documents, run):
    odd = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    docs = [*texts.items(), *odd, *[(77, "aus " * 30)] * 40]
    target = ["aus aus aus", "Über 100 DINGE", "", None]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5).withColumn("rank", F.lit("own"))
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    rows = importance.resample(df, goal, 40, 5, run, 300, 7).collect()
    expected = plain_resample(docs, target, 40, 5, run, 300, 7)
    assert Counter(tuple(r) for r in rows) == expected
    drawn = sorted(r["rank"] for r in rows if r["rank"] is not None)
    assert drawn == list(range(1, len(drawn) + 1)) and len(drawn) > 20


def test_resampling_moves_towards_the_target(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(50)]
    docs = [(i, " ".join(rng.choice(words[:25] if i % 10 else words[25:], 30))) for i in range(500)]
    goal = [(" ".join(rng.choice(words[25:], 200)),)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = importance.resample(df, spark.createDataFrame(goal, "text string"), 10, 20).where("rank is not null")
    assert {r["doc_id"] for r in rows.collect()} == set(range(0, 500, 10))


def test_resampling_without_rows(spark, no_documents, odd_documents):
    assert importance.resample(no_documents, odd_documents.select("text")).count() == 0
    rows = importance.resample(odd_documents, no_documents.select("text")).collect()
    assert len(rows) == odd_documents.count()


# --- token files


def best_cost(counts, longest):
    """Bits of the best limited code by dynamic programming over full trees, for few symbols."""
    weights = sorted(counts, reverse=True)

    def cost(i, level, open_nodes):
        if i == len(weights):
            return 0 if open_nodes >= 0 else math.inf
        if level > longest or open_nodes <= 0:
            return math.inf
        best = math.inf
        for leaves in range(0, min(open_nodes, len(weights) - i) + 1):
            here = level * sum(weights[i : i + leaves])
            if i + leaves == len(weights):
                best = min(best, here)
            elif open_nodes - leaves > 0:
                best = min(best, here + cost(i + leaves, level + 1, 2 * (open_nodes - leaves)))
        return best

    return cost(0, 1, 2)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), min_size=2, max_size=7), st.integers(1, 6))
def test_code_is_the_best_of_its_length(counts, longest):
    lengths = token_files.code_lengths(np.array([0, *counts, 0]), longest)
    limit = max(longest, (len(counts) - 1).bit_length())
    assert lengths[0] == lengths[-1] == 0 and lengths.max() <= limit
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1
    assert int((lengths[1:-1] * counts).sum()) == best_cost(counts, limit)


def test_code_words_are_canonical_and_free_of_prefixes():
    counts = np.random.default_rng(1).zipf(1.3, 5000).clip(0, 10**6)
    code = token_files.Code(token_files.code_lengths(counts, 14))
    words = [f"{int(w):0{n}b}" for w, n in zip(code.words, code.lengths)]
    order = sorted(range(5000), key=lambda i: (code.lengths[i], i))
    in_order = [words[i] for i in order]
    assert in_order == sorted(in_order)
    assert not any(b.startswith(a) for a, b in zip(in_order, in_order[1:]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=700), min_size=1, max_size=5))
def test_bits_are_read_back(documents):  # noqa: F811
    ids = np.concatenate([np.array(d) for d in documents])
    code = token_files.Code(token_files.code_lengths(np.bincount(ids, minlength=41), 7))
    sizes = np.array([len(d) for d in documents])
    bits, marks = code.encode(ids, sizes)
    counts = token_files.runs_of(sizes)
    base = 8 * (np.cumsum([len(b) for b in bits]) - [len(b) for b in bits])
    begins = np.concatenate([m + b for m, b in zip(marks, base)])
    assert code.decode(b"".join(bits), begins, counts).tolist() == ids.tolist()
    # any run alone, in any order
    some = np.random.default_rng(0).permutation(len(counts))[:2]
    ends = np.cumsum(counts)
    expected = np.concatenate([ids[ends[k] - counts[k] : ends[k]] for k in some])
    assert code.decode(b"".join(bits), begins[some], counts[some]).tolist() == expected.tolist()


def plain_ids(text):
    return [*Tokenizer.from_file(BYTE).encode(text or "", add_special_tokens=False).ids, 2]


def test_token_files_hold_the_corpus(spark, tmp_path, odd_documents):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(odd_documents.repartition(4), path, BYTE, block_ids=300)
    rows = token_files.read_documents(spark, path).orderBy("start").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    found = [np.frombuffer(r["ids"], "<u4") for r in rows]
    starts = np.cumsum([len(x) for x in found]) - [len(x) for x in found]
    assert [r["start"] for r in rows] == starts.tolist()
    assert [r["n_tokens"] for r in rows] == [len(x) for x in found]
    expected = Counter((r["doc_id"], *plain_ids(r["text"])) for r in odd_documents.collect())
    assert Counter((i, *x.tolist()) for i, x in zip(ids, found)) == expected
    corpus = np.concatenate(found)
    for begin, end in ((0, 1), (3, 700), (255, 257), (len(corpus) - 300, len(corpus) + 9), (5, 5)):
        pieces = sorted((r["place"], r["ids"]) for r in token_files.read_window(spark, path, begin, end).collect())
        got = np.frombuffer(b"".join(x for _, x in pieces), "<u4")
        assert got.tolist() == corpus[begin:end].tolist()
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.where((F.col("n") > 300) & (F.size("sizes") > 1)).count() == 0


def test_token_files_of_equal_rows_and_none(spark, tmp_path, no_documents):
    many = spark.createDataFrame([(None if i % 3 else 5, "same text") for i in range(300)], "doc_id bigint, text string")
    token_files.write_tokens(many, str(tmp_path / "many"), BYTE)
    rows = token_files.read_documents(spark, str(tmp_path / "many")).orderBy("start").collect()
    size = len(plain_ids("same text"))
    assert [r["start"] for r in rows] == [size * i for i in range(300)]
    assert [r["doc_id"] for r in rows] == [None] * 200 + [5] * 100
    token_files.write_tokens(no_documents, str(tmp_path / "none"), BYTE)
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0
    only = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    token_files.write_tokens(only, str(tmp_path / "only"), BYTE)
    assert [r["n_tokens"] for r in token_files.read_documents(spark, str(tmp_path / "only")).collect()] == [1, 1]


def test_token_files_query(spark, sf_dir, texts):
    before = 0
    rows = {r["doc_id"]: r for r in queries.op12_token_files(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for i in sorted(texts):
        ids = plain_ids(texts[i])
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (before, len(ids), crc)
        before += len(ids)


# --- centroids


def plain_clusters(rows, clusters, rounds, seed):
    """In whole numbers of any size: {(id, vector): (cluster, distance)} and the centroids."""
    key = lambda r: hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    fixed = [r[1] for r in sorted(rows, key=lambda r: (key(r), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(fixed))[::-1]
    for _ in range(rounds):
        members = [[] for _ in fixed]
        for _, v in rows:
            members[near(v)[0]].append(v)
        fixed = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, fixed)]
    return Counter((i, *near(v)) for i, v in rows), fixed


@pytest.mark.parametrize("spread", [3, 1000, 1 << 24, 1 << 40])
def test_centroids_are_brute_force(spark, spread):
    rng = np.random.default_rng(spread)
    rows = [(i // 2, rng.integers(-spread, spread, 5).tolist()) for i in range(150)]
    rows += [(None, rows[0][1]), (None, rows[1][1]), rows[3], rows[3]] + [(9000 + i, rows[5][1]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>").repartition(6)
    found, fixed = centroids.cluster(df, 6, 7, 11)
    expected, centers = plain_clusters(rows, 6, 7, 11)
    assert fixed == centers
    expected = Counter((i, c, min(d, centroids.LARGEST)) for i, c, d in expected.elements())
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, None), (3, [0.1]), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [None, 1.0]), (7, []),
            (8, [1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("v", F.lit("own"))
    vectors = centroids.integer_vectors(df, 2)
    assert {r["vec_id"]: r["v"] for r in vectors.collect()} == {1: [512, -512], 8: [1 << 62, -(1 << 62)]}
    found, fixed = centroids.cluster(vectors, 8, 3)
    assert len(fixed) == 2 and {r["distance"] for r in found.collect()} == {0}
    none, fixed = centroids.cluster(vectors.where("vec_id = 99"))
    assert fixed == [] and centroids.with_inertia(none, fixed).count() == 0


def test_ties_go_to_the_smaller_number():
    cluster, distance = centroids.nearest(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [5, 5], [5, 5]]))
    assert cluster.tolist() == [0, 2] and distance.tolist() == [1, 0]
