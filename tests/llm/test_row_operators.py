"""Operators that relate rows: line dedup, near-duplicates, top-k, URL trust, shards; and the pipeline."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import documents, no_documents, odd_documents, texts  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from fovea.llm import line_dedup, near_dup, packing, quality, queries, secret_scan, sharding, topk, url_trust
from fovea.llm.common import table

# --- line dedup


WORD = re.compile(line_dedup.WORD, re.ASCII)


def plain_line_dedup(docs, min_words):
    """{id: text}: a line goes if it lies in a run of enough words that also begins earlier."""
    split = [(i, t.split("\n")) for i, t in sorted(docs.items())]
    places = defaultdict(list)
    for a, (_, lines) in enumerate(split):
        for p, line in enumerate(lines):
            places[line].append((a, p))
    out = {}
    for a, (i, lines) in enumerate(split):
        gone = set()
        for p, line in enumerate(lines):
            best = 0
            for b, q in places[line]:
                if (b, q) >= (a, p):
                    break
                n, other = 0, split[b][1]
                while p + n < len(lines) and q + n < len(other) and lines[p + n] == other[q + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(WORD.findall(x)) for x in lines[p : p + best]) >= min_words:
                gone.update(range(p, p + best))
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 12])
def test_line_dedup_is_brute_force(spark, texts, least):
    """The small table, and texts of few different lines, which repeat in runs of all lengths."""
    rng = np.random.default_rng(3)
    words = ["a", "b c", "d e f", "", "g h i j k l m n o p q"]
    docs = dict(texts)
    for k in range(60):
        docs[10_000 + k] = "\n".join(rng.choice(words, rng.integers(0, 40), p=[0.3, 0.3, 0.2, 0.15, 0.05]))
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(7)
    rows = line_dedup.dedup_lines(df, least).collect()
    expected = plain_line_dedup(docs, least)
    assert {r["doc_id"]: r["text"] for r in rows} == expected
    for r in rows:
        assert r["n_lines"] == len(docs[r["doc_id"]].split("\n"))
        left = 0 if r["n_lines"] == r["n_deleted"] else len(r["text"].split("\n"))
        assert r["n_lines"] - r["n_deleted"] == left


def test_short_lines_and_scripts_without_spaces_repeat(spark):
    long = "漢字" * 40
    docs = [(1, f"a\n\nb\n{long}\nown"), (2, f"x\na\n\nb\ny\na\n{long}\n\n"), (3, f"\n\n{long}\nb b")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert found == {1: docs[0][1], 2: "x\ny\n\n", 3: "\n\nb b"}
    # with the pipeline's guard a line without spaces still counts by its length, and short lines stay
    found = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, corpus_pipeline.RUN_WORDS).collect()}
    assert found == {1: docs[0][1], 2: "x\na\n\nb\ny\na\n\n", 3: "\n\nb b"}


def test_a_long_document_of_repeated_lines(spark):
    """Time must not grow with the square of a document's lines."""
    text = "\n".join(f"line {i}" for i in range(40_000))
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string")
    lines = line_dedup.repeated_lines(df)
    begin = time.monotonic()
    assert line_dedup.shortest_runs(lines, 3).count() == 2 * 39_999
    assert time.monotonic() - begin < 30
    found = {r["doc_id"]: r["n_deleted"] for r in line_dedup.dedup_lines(df).collect()}
    assert found == {1: 0, 2: 40_000}


def test_ranks_are_the_suffix_order(spark):
    """Ranks by four lines order the repeated suffixes as their lines' ranks do."""
    text = "\n".join("abcabcabcabdabcabcabd")
    df = spark.createDataFrame([(1, text), (2, text[2:])], "doc_id bigint, text string")
    lines = line_dedup.repeated_lines(df)
    ranks = line_dedup.doubled(line_dedup.doubled(lines.select("_id", "_text", "at", "rank"), 1), 2)
    of_line = {(r["_id"], r["at"]): r["rank"] for r in lines.collect()}
    found = {(r["_id"], r["at"]): r["rank"] for r in ranks.collect()}
    key = {p: tuple(of_line[p[0], p[1] + k] for k in range(4)) for p in found}
    order = sorted(found, key=lambda p: (key[p], p))
    for p, q in zip(order, order[1:]):
        assert (found[p] < found[q]) if key[p] < key[q] else found[p] == found[q]


def test_line_dedup_of_odd_documents(odd_documents, no_documents):
    rows = line_dedup.dedup_lines(odd_documents)
    own = [c for c in odd_documents.columns if c != "runs"]
    assert rows.columns == [*own, "runs", "n_lines", "n_deleted"]
    found = defaultdict(list)
    for r in rows.collect():
        found[r["doc_id"]].append(r["text"])
        assert r["_id"] == "own _id" and r["rank"] == "own rank"
    passage = " ".join(f"wort{i}" for i in range(60))
    # the one without an id comes first
    assert sorted(found[None], key=str) == [None, f"{passage}\nno id"]
    assert found[1] == ["one two three four five six seven eight nine ten eleven\nlast line"]
    assert found[2] == ["another end with other words"] * 2 and found[3] == [None] and found[4] == [""]
    assert found[5] == ["\n\n\n"] and found[7] == ["password=0123456789abcdef0123456789abcdef01\n"]
    assert passage not in found[8][0] and len(found[8][0]) == 5 * 60_000
    assert line_dedup.dedup_lines(no_documents).count() == 0


# --- near-duplicates


def plain_components(docs, words, percent):
    """{id: smallest id} over all linked pairs, found by a full count of common shingles."""
    sets = {i: near_dup.shingles(t or "", words) for i, t in docs.items()}
    holders, common = defaultdict(list), Counter()
    for i in sorted(sets):
        for x in sets[i]:
            for j in holders[x]:
                common[j, i] += 1
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates_are_brute_force(spark, texts, words, percent):
    """The small table; a chain whose ends are far apart; and a cloud of copies around one text."""
    rng = np.random.default_rng(4)
    docs = dict(texts)
    base = [f"w{x}" for x in rng.integers(0, 10_000, 200)]
    for k in range(30):  # each differs from the one before by a few words
        docs[20_000 + 7 * k % 31] = " ".join([*base[4 * k :], *base[: 4 * k][::-1]])
    for k in range(150):
        changed = list(base)
        for at in rng.integers(0, 200, 5):
            changed[at] = f"new{rng.integers(0, 50)}"
        docs[30_000 + k] = " ".join(changed)
    docs |= {40_000: "", 40_001: None, 40_002: "one TWO", 40_003: "One two", 40_004: "\x1c one two"}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(6)
    rows = near_dup.near_duplicates(df, words, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain_components(docs, words, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_signatures_estimate_the_similarity():
    """Two permutations are enough: equal coordinates come as often as common shingles."""
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.8):
        found = []
        for _ in range(40):
            n = 300
            both = int(2 * n * share / (1 + share))
            x = rng.integers(0, 1 << 63, 2 * n - both).astype(np.uint64)
            a, b = (near_dup.signature(y, 128) for y in (x[:n], x[n - both :]))
            found.append((a == b).mean())
        assert abs(np.mean(found) - share) < 0.03


@pytest.mark.parametrize("percent", [50, 80, 85, 95, 100])
def test_bands_miss_next_to_nothing(percent):
    bands, rows = near_dup.bands_for(percent)
    assert (1 - min(percent / 100, 0.99) ** rows) ** bands <= near_dup.MISSED


def test_components_of_long_chains_and_stars(spark):
    rng = np.random.default_rng(6)
    chain = rng.permutation(400)
    pairs = [(int(a), int(b)) for a, b in zip(chain, chain[1:])]
    pairs += [(1000, 1000 + k) for k in range(1, 300)] + [(2001, 2000), (2000, 2001)]
    found = near_dup.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    expected = {k: 0 for k in range(1, 400)} | {1000 + k: 1000 for k in range(1, 300)} | {2001: 2000}
    assert {r["node"]: r["root"] for r in found} == expected


def test_near_duplicates_bound_what_goes_to_python(spark, monkeypatch):
    """Workers get few rows at a time; the session's own setting is back afterwards."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    write = near_dup.materialize

    def noting(df, purpose):
        seen.append((purpose, int(spark.conf.get(name))))
        return write(df, purpose)

    spark.conf.set(name, "10000")
    monkeypatch.setattr(near_dup, "materialize", noting)
    try:
        docs = spark.createDataFrame([(i, "a b c d e f g") for i in range(4)], "doc_id long, text string")
        kept = near_dup.near_duplicates(docs).where("kept").collect()
        assert spark.conf.get(name) == "10000"
    finally:
        spark.conf.set(name, before)
    assert [r["doc_id"] for r in kept] == [0]
    assert {"signatures", "links", "sets"} <= {purpose for purpose, _ in seen}
    assert all(rows <= near_dup.BATCH_ROWS for _, rows in seen)


def test_near_duplicates_of_odd_documents(odd_documents, no_documents):
    rows = near_dup.near_duplicates(odd_documents).collect()
    assert len(rows) == 15
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    roots = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"]}
    # 2, 10 and 11 share 58 shingles of the passage
    assert roots[2] == roots[10] == roots[11] == 2 and roots[1] == 1 and roots[4] == 4
    assert near_dup.near_duplicates(no_documents).count() == 0


def test_prefixes_lose_no_similar_pair(spark):
    """Alone, on rows that all have roots of their own: every linked pair is among those found."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for family in range(12):
        stem = rng.choice(vocabulary, rng.integers(3, 120)).tolist()
        for copy in range(6):
            words = list(stem)
            for at in rng.integers(0, len(words), copy):
                words[at] = rng.choice(vocabulary)
            texts[100 * family + copy] = " ".join(words + [f"end{copy}"] * int(rng.integers(0, 3)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = docs.select("doc_id", F.col("doc_id").alias("root"))
    for words, percent in ((3, 85), (2, 50)):
        found = {(r["a"], r["b"]) for r in near_dup.similar_prefixes(rows, docs, words, percent).collect()}
        sets = {i: near_dup.shingles(t, words) for i, t in texts.items()}
        linked = {(i, j) for i in sets for j in sets if i < j and near_dup.linked(sets[i], sets[j], percent)}
        assert linked <= found and len(linked) > 10
        assert len(found) < 0.2 * len(texts) ** 2 / 2


def test_a_template_under_the_threshold_meets_no_one(spark):
    """Texts of 300 common words and 30 of their own, similarity about 0.83: no pair may even be formed."""
    common = " ".join(f"c{i}" for i in range(300))
    docs = spark.range(12_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(29)), lambda k: F.concat_ws("o", "id", k)), F.lit(common)).alias("text"),
    )
    rows = docs.select("doc_id", F.col("doc_id").alias("root"))
    begin = time.monotonic()
    assert near_dup.similar_prefixes(rows, docs, 3, 85).count() == 0
    assert time.monotonic() - begin < 60


# --- top-k


def plain_top(rows, top):
    """{query: [(id, score)]} of integer vectors by all products, exactly."""
    out = {}
    for i, q in rows:
        if i % 100 == 0:
            scores = [(j, sum(int(a) * int(b) for a, b in zip(q, x))) for j, x in rows if j != i and len(x) == len(q)]
            out[i] = sorted(scores, key=lambda s: (-s[1], s[0]))[:top]
    return out


@pytest.mark.parametrize("cell, block", [(2048, 512), (37, 2)])
def test_top_k_is_brute_force(spark, sf_dir, cell, block):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    found = defaultdict(list)
    for r in topk.search(vectors, vectors.where("vec_id % 100 = 0"), 10, cell, block).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r["query_id"]]) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found == plain_top([(r["vec_id"], r["v"]) for r in vectors.collect()], 10)


def test_top_k_of_odd_vectors(spark):
    big = 3e15
    rows = [(0, [0.5, -0.25]), (1, None), (2, [0.5, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (100, [1.0]), (101, [2.0]), (200, []), (201, []),
            (300, [big, big, 1.0]), (301, [big, -big, 0.0]), (302, [1.0, 0.0, 0.0])]
    rows += [(400 + k, [1.0, 1.0]) for k in range(30)] + [(405, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumns({"v": F.lit("own"), "cell": F.lit("own"), "score": F.lit("own")})
    vectors = topk.integer_vectors(df)
    found = topk.search(vectors, vectors.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    best = defaultdict(list)
    for r in found:
        best[r["query_id"]].append((r["vec_id"], r["score"]))
    assert best[0] == [(400 + k, 1024 * 256) for k in range(10)]  # ties go to the smaller id
    assert best[400] == [(401 + k, 2 * 1024 * 1024) for k in range(10)]
    assert best[100] == [(101, 2 * 1024 * 1024)] and best[200] == [(201, 0)]
    assert best[300] == [(302, (1 << 63) - 1), (301, 0)]  # 3e21 is beyond 64 bits
    assert topk.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_segment_bound_holds():
    rng = np.random.default_rng(7)
    x, q = (np.cumsum(rng.integers(-50, 50, (n, 64)), axis=1) for n in (500, 20))
    for segments in topk.LEVELS:
        bound = topk.segment_statistics(q, segments) @ topk.segment_statistics(x, segments).T
        assert (bound + 1e-6 * np.abs(bound) >= q @ x.T).all()


def test_each_level_prunes_vectors_that_fall_into_groups(spark):
    """Walks around forty centres: whole groups drop, then pairs by coarse and by fine statistics; results stay exact."""
    rng = np.random.default_rng(8)
    centres = np.repeat(rng.integers(-400, 400, (40, 16)), 4, axis=1)
    rows = [(i, (centres[i % 40] + rng.integers(-60, 60, 64)).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    queries = df.where("vec_id % 100 = 0")
    report = {r["step"]: (r["pairs"], r["dropped"]) for r in topk.pruning(df, queries, 10, 500).collect()}
    assert report["boxes"][0] == 60 * 6000 and report["boxes"][1] > 0.3 * report["boxes"][0]
    assert report["coarse"][1] > 0.5 * report["coarse"][0] and report["fine"][1] > 0.05 * report["fine"][0]
    found = defaultdict(list)
    for r in topk.search(df, queries, 10, 500).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    x = np.array([v for _, v in rows])
    for i, best in found.items():
        scores = x @ x[i]
        order = [int(j) for j in np.lexsort((np.arange(6000), -scores)) if j != i][:10]
        assert best == [(j, int(scores[j])) for j in order]
    assert len(found) == 60


def test_pruning_report_of_vectors_without_groups(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    report = {r["step"]: r["pairs"] for r in topk.pruning(vectors, vectors.where("vec_id % 100 = 0")).collect()}
    assert report["boxes"] >= report["coarse"] >= report.get("fine", 0)


# --- URL trust


def plain_trust(links, seeds, damping, iterations):
    ranks = dict(seeds)
    out = Counter()
    for (a, _), n in links.items():
        out[a] += n
    start = {h: (1 - damping) * w / sum(seeds.values()) for h, w in seeds.items()}
    ranks = dict(start)
    for _ in range(iterations):
        after = Counter(start)
        for (a, b), n in links.items():
            if a in ranks:
                after[b] += damping * ranks[a] * n / out[a]
        ranks = after
    return ranks


def test_trust_spreads_along_links_and_distrust_against_them(spark):
    def page(i, url, *targets):
        return (i, url, "".join(f'<a  HREF = "{t}">x</a><img src=//{t.split("//")[-1]}>' for t in targets) or None)

    pages = [
        page(1, "http://good.com/a", "https://friend.org/x", "http://GOOD.com/self"),
        page(2, "http://friend.org/", "http://far.org"),
        page(3, "http://spam.net/es/1", "http://friend.org/"),
        page(4, "http://linker.org/", "http://spam.net/es/1", "http://spam.net/other"),
        page(5, "http://far.org?x://y", "/relative"),
        page(6, "http://nowhere.org/"),
        page(7, "http://www.linker.org/"),
        page(8, None), page(8, None), (None, "no scheme", "<a href='http://far.org'>"),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    df = df.withColumns({"host": F.lit("own"), "rank": F.lit("own"), "rule": F.lit("own")})
    rows = url_trust.judge(df).collect()
    assert len(rows) == 10
    verdicts = {r["page_id"]: r["verdict"] for r in rows}
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow",
                        None: "allow"}
    links = {(r["source"], r["target"]): r["links"] for r in url_trust.host_links(df).collect()}
    assert links == {("good.com", "friend.org"): 1, ("friend.org", "far.org"): 1, ("spam.net", "friend.org"): 1,
                     ("linker.org", "spam.net"): 1, ("www.linker.org", "linker.org"): 1,
                     ("linker.org", "www.linker.org"): 1}
    trust = plain_trust(links, {"good.com": 1}, url_trust.DAMPING, 60)
    turned = {(b, a): n for (a, b), n in links.items()}
    distrust = plain_trust(turned, {"spam.net": 1}, url_trust.DAMPING, 60)
    for r in rows:
        assert np.isclose(r["trust"], trust.get(r["host"], 0))
        assert np.isclose(r["distrust"], distrust.get(r["host"], 0))
    assert url_trust.judge(df.limit(0)).count() == 0


def test_distrust_reaches_the_end_of_a_chain(spark):
    """Twenty hosts that each link to the next, the last one blocked by a rule; and evidence for a distant domain."""
    pages = [(i, f"http://h{i}.org/", f"<a href='http://h{i + 1}.org/'>") for i in range(19)]
    pages += [(19, "http://h19.org/", "<a href='http://spam.net/'>"), (20, "http://spam.net/es/", None),
              (21, "http://a.b.example.net/", None), (22, "http://example.net/", "<a href='http://spam.net/'>"),
              (23, "http://other.org/", None), (24, "http://" + "x." * 300 + "net/", None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_trust.judge(df).collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {*range(23)}
    links = {(r["source"], r["target"]) for r in url_trust.host_links(df).collect()}
    levels = [("a.b.example.net", "b.example.net"), ("b.example.net", "example.net")]
    assert {*levels, *((b, a) for a, b in levels)} <= links and not any("x.x" in a for a, _ in links)


def test_rules(spark):
    urls = {
        "https://A.Com/x?y": ("a.com", "/x", "com/"), "http://com/": ("com", "/", "com/"), "http://acom/": ("acom", "/", None),
        "http://x.com": ("x.com", "", None), "x://example.com/en/1": ("example.com", "/en/1", "example.com/en/"),
        "x://m.www.example.com/en/#": ("m.www.example.com", "/en/", "www.example.com/en/"),
        "x://www.example.com/de/": ("www.example.com", "/de/", "com/"), "x://a.net/es/": ("a.net", "/es/", "net/es/"),
        "x://a.net/es": ("a.net", "/es", None), "x://net/fr/?": ("net", "/fr/", "net/fr/"), "a.com/": ("", "", None),
        "x://É.com/a://b.net/": ("É.com", "/a://b.net/", "com/"), "": ("", "", None),
    }
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_trust.with_rules(df).collect()}
    assert found == dict(enumerate(urls.values()))


# --- shards


def check_shards(rows, shards):
    slots = defaultdict(list)
    sizes = Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(slots) <= set(range(shards))
    return sizes


def test_shards_have_equal_bytes(spark):
    rows = queries.op9_sharding(spark, "/root/testdata/sf0.1").collect()
    sizes = check_shards(rows, 24)
    assert len(sizes) == 24 and max(sizes.values()) < 1.03 * min(sizes.values())
    texts = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.1", "documents").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    groups = defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        groups[texts[r["doc_id"]]].add(r["shard"])
    several = [len(x) for x in groups.values()]
    assert sum(n > 1 for n in several) <= 23 and max(several) <= 2


def test_a_hot_group_is_split(spark):
    rows = [(i, "the same text" if i % 3 else f"text number {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = check_shards(sharding.shard(df, rows_per_bucket=40).collect(), 24)
    assert len(sizes) == 24 and max(sizes.values()) < 1.05 * min(sizes.values())


def test_many_copies_of_one_row_are_numbered_in_several_buckets(spark):
    """A third of all rows equal in id and text."""
    rows = [(7, "the same row")] * 1000 + [(i, f"text number {i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    found = sharding.shard(df, 4, rows_per_bucket=40).collect()
    check_shards(found, 4)
    assert len(found) == 3000


def test_shards_of_odd_documents(odd_documents, no_documents):
    rows = sharding.shard(odd_documents, 4).collect()
    check_shards(rows, 4)
    assert len(rows) == 15 and {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {8}
    assert {r["checksum"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert sharding.shard(no_documents).count() == 0


# --- the pipeline


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_stage", "line_stage", "near_stage", "secret_stage", "packing_stage"
    ]


def test_pipeline_is_its_operators(spark, sf_dir, texts):
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    good = {i: t for i, t in texts.items() if model.scores(quality.describe_all([t.encode()]))[0] >= 0.3}
    first = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    assert first.columns == list(corpus_pipeline.COLUMNS)
    assert {r["doc_id"]: r["text"] for r in first.collect()} == good

    lines = plain_line_dedup(good, corpus_pipeline.RUN_WORDS)
    lines = {i: t for i, t in lines.items() if t.strip() or t == good[i]}
    start = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in good.items()], docs.schema)
    second = corpus_pipeline.line_stage(spark, start, sf_dir)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in second.collect()} == {
        i: (t, len(t)) for i, t in lines.items()
    }

    roots = plain_components(texts, 5, 80)
    third = corpus_pipeline.near_stage(spark, docs, sf_dir)
    assert {r["doc_id"] for r in third.collect()} == {i for i, (_, root) in roots.items() if i == root}

    fourth = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_stage(spark, docs, sf_dir).collect()}
    assert set(fourth) == set(texts)
    for i, t in texts.items():
        assert not secret_scan.base_spans(fourth[i])
        assert (fourth[i] == t) or secret_scan.base_spans(t) or "[secret]" in fourth[i]

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} <= set(good) and rows
    filled = Counter()
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert all(n == packing.WINDOW for k, n in filled.items() if k != max(filled))


def test_stages_take_odd_documents(spark, odd_documents, no_documents, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd_documents, sf_dir)
        assert found.count() > 0
        if stage is not corpus_pipeline.packing_stage:
            assert found.columns == list(corpus_pipeline.COLUMNS)
        assert stage(spark, no_documents, sf_dir).count() == 0
