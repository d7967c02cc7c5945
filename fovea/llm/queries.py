"""Registered queries of this subpackage and the SQL that some of them are checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.llm import (
    bpe, centroids, fingerprints, importance, line_dedup, near_dup, packing, quality, secret_scan, sharding,
    token_files, topk, url_trust,
)
from fovea.llm.common import table, tokenizer_path
from fovea.session import shared_dir


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        (F.col("score") >= quality.KEEP_FROM).cast("int").alias("predicted"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    deleted = F.transform("runs", lambda r: F.concat_ws("-", r["first"], r["last"]))
    return rows.select(
        "doc_id", "n_lines", "n_deleted", F.array_join(deleted, ",").alias("deleted"), "text"
    )


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = fingerprints.build_lexicon(docs)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprints.compare_edited(docs, lexicon, buckets)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint")
    spans = lambda x, kind: F.struct(x["start"], kind, x["end"])
    base = F.transform("base", lambda x: spans(x, x["kind"]))
    added = F.transform("added", lambda x: spans(x, F.lit(len(secret_scan.KINDS)).alias("kind")))
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS)],
        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(F.concat(base, added)).alias("spans"),
    )


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_trust.judge(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "host", "path", "rule", "verdict")


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", F.col("checksum").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), decoded=True)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    rows = token_files.read_documents(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = centroids.integer_vectors(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(*centroids.cluster(vectors))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_line_dedup, op3_imatch, op4_secrets, op5_url_trust, op6_near_dup, op7_topk,
        op8_packing, op9_sharding, op10_bpe, op11_importance, op12_token_files, op13_centroids,
    )
}


def line_dedup_sql(min_words: int = line_dedup.MIN_WORDS) -> str:
    """Every run of lines is compared as a list; deleted lines are collected per document."""
    return f"""
    WITH docs AS (
      SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
    ),
    counted AS (
      SELECT doc_id, lines,
             list_transform(lines, lambda x: len(regexp_extract_all(x, '{line_dedup.WORD}'))) AS words
      FROM docs
    ),
    spots AS (
      SELECT doc_id, lines, words, unnest(range(1, len(lines) + 1)) AS p FROM counted
    ),
    ends AS (
      SELECT doc_id, lines, p,
             list_filter(range(p, len(lines) + 1), lambda e: list_sum(words[p:e]) >= {min_words})[1] AS e,
             list_filter(range(p, 0, -1), lambda s: list_sum(words[s:p]) >= {min_words})[1] AS s
      FROM spots
    ),
    runs AS (
      SELECT doc_id, p AS first, e AS last, lines[p:e] AS content FROM ends WHERE e IS NOT NULL
      UNION
      SELECT doc_id, s, p, lines[s:p] FROM ends WHERE s IS NOT NULL
    ),
    leads AS (
      SELECT *, min(doc_id * 1000000 + first) OVER (PARTITION BY content) AS lead FROM runs
    ),
    gone AS (
      SELECT doc_id, unnest(range(first, last + 1)) AS p
      FROM leads WHERE doc_id * 1000000 + first > lead
    ),
    marked AS (
      SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island
      FROM (SELECT DISTINCT doc_id, p FROM gone)
    ),
    islands AS (
      SELECT doc_id, min(p) - 1 AS a, max(p) - 1 AS b, count(*) AS n
      FROM marked GROUP BY doc_id, island
    ),
    texts AS (
      SELECT doc_id, sum(n)::INTEGER AS n_deleted,
             string_agg(a || '-' || b, ',' ORDER BY a) AS deleted
      FROM islands GROUP BY doc_id
    ),
    kept AS (
      SELECT s.doc_id, string_agg(s.lines[s.p], chr(10) ORDER BY s.p) AS text
      FROM spots s WHERE (s.doc_id, s.p) NOT IN (SELECT (doc_id, p) FROM gone) GROUP BY s.doc_id
    )
    SELECT d.doc_id, len(d.lines)::INTEGER AS n_lines, coalesce(t.n_deleted, 0)::INTEGER AS n_deleted,
           coalesce(t.deleted, '') AS deleted, coalesce(k.text, '') AS text
    FROM docs d LEFT JOIN texts t USING (doc_id) LEFT JOIN kept k USING (doc_id)
    """


def near_dup_sql(words: int = near_dup.WORDS, percent: int = near_dup.PERCENT) -> str:
    """All pairs that share a shingle are counted; components by walking the links."""
    grams = "[" + ", ".join(f"w[i + {k}]" for k in range(words)) + "]"
    return f"""
    WITH RECURSIVE texts AS (
      SELECT doc_id, list_filter(
        regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[ \\t\\n\\r\\x0B\\f]+'), lambda x: x <> '') AS w
      FROM documents
    ),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [hash(w)]
        ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: hash({grams}))) END AS s
      FROM texts
    ),
    spread AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
      SELECT a.doc_id AS x, b.doc_id AS y
      FROM spread a JOIN spread b ON a.g = b.g AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
    ),
    reach AS (
      SELECT doc_id, doc_id AS root FROM documents
      UNION
      SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.doc_id
    ),
    roots AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN roots USING (doc_id)
    """


def topk_sql(top: int = topk.TOP, scale: int = topk.SCALE) -> str:
    return f"""
    WITH vectors AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scores AS (
      SELECT q.vec_id AS query_id, x.vec_id,
             list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::BIGINT AS score
      FROM vectors q JOIN vectors x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id, score
    FROM scores
    QUALIFY rank <= {top}
    """


def url_trust_sql(
    rules=url_trust.RULES,
    damping: float = url_trust.DAMPING,
    turns: int = 64,
    threshold: float = url_trust.THRESHOLD,
) -> str:
    """The rules as a table; one common table expression for each turn of the walks.

    After `turns` turns what is missing from any rank is below damping to that power, here 1e-14; no host
    of the given tables is as many links from a seed.
    """
    values = ", ".join(f"('{what}', '{host}', '{path}')" for what, host, path in rules)
    walks = ", ".join(
        f"""r{k} AS MATERIALIZED (
      SELECT walk, host, sum(rank) AS rank FROM (
        SELECT r.walk, s.target AS host, r.rank * s.part AS rank
        FROM r{k - 1} r JOIN steps s ON s.walk = r.walk AND s.host = r.host
        UNION ALL SELECT walk, host, rank FROM r0
      ) GROUP BY walk, host)"""
        for k in range(1, turns + 1)
    )
    return f"""
    WITH cut AS (
      SELECT page_id, html,
             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages
    ),
    parsed AS (
      SELECT page_id, html,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut
    ),
    rules(ruled, rule_host, rule_path) AS (VALUES {values}),
    fitting AS (
      SELECT p.page_id, rule_host || rule_path AS rule, ruled
      FROM parsed p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(rule_host || rule_path) DESC) = 1
    ),
    judged AS (SELECT p.*, f.rule, f.ruled FROM parsed p LEFT JOIN fitting f USING (page_id)),
    named AS (
      SELECT page_id, host AS source, lower(unnest(list_distinct(
        regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s>]+)', 1)
      ))) AS target FROM parsed
    ),
    labels AS (
      SELECT DISTINCT string_split(host, '.') AS l
      FROM (SELECT source AS host FROM named UNION SELECT target FROM named UNION SELECT host FROM parsed)
      WHERE length(host) <= {url_trust.LONGEST_HOST}
    ),
    above AS (
      SELECT DISTINCT array_to_string(l[i:], '.') AS source, array_to_string(l[i + 1:], '.') AS target
      FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM labels)
    ),
    links AS (
      SELECT source, target, sum(n) AS n FROM (
        SELECT source, target, 1 AS n FROM named
        UNION ALL SELECT source, target, 1 FROM above
        UNION ALL SELECT target, source, 1 FROM above
      ) WHERE source <> target AND source <> '' AND target <> '' GROUP BY source, target
    ),
    ways AS (
      SELECT 0 AS walk, source AS host, target, n FROM links
      UNION ALL SELECT 1, target, source, n FROM links
    ),
    steps AS MATERIALIZED (
      SELECT walk, host, target, n / sum(n) OVER (PARTITION BY walk, host) * {damping}::DOUBLE AS part FROM ways
    ),
    seeds AS (
      SELECT 0 AS walk, host, count(*) AS rank FROM judged WHERE ruled = 'allow' GROUP BY host
      UNION ALL SELECT 1, host, count(*) FROM judged WHERE ruled = 'block' GROUP BY host
    ),
    r0 AS MATERIALIZED (
      SELECT walk, host, rank / sum(rank) OVER (PARTITION BY walk) * (1 - {damping}::DOUBLE) AS rank FROM seeds
    ),
    {walks},
    hosts AS (
      SELECT host, sum(CASE WHEN walk = 0 THEN rank ELSE 0 END) AS trust,
             sum(CASE WHEN walk = 1 THEN rank ELSE 0 END) AS distrust
      FROM r{turns} GROUP BY host
    )
    SELECT page_id, j.host, path, rule, coalesce(ruled, CASE
      WHEN coalesce(distrust, 0) > {threshold} * (1 + 1e-9) * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged j LEFT JOIN hosts h ON h.host = j.host
    """


def importance_sql(
    percent: int = importance.DRAWN_PERCENT,
    least_words: int = importance.LEAST_WORDS,
    buckets: int = importance.BUCKETS,
    seed: int = importance.SEED,
) -> str:
    """CRC-32 byte by byte, for each different word once; features are single words."""
    return f"""
    WITH steps AS (
      -- the register is put before eight turns, as the first element of what is folded
      SELECT list(r ORDER BY b) AS step FROM (
        SELECT b, list_reduce([b] || range(0, 8)::BIGINT[],
          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS r
        FROM (SELECT unnest(range(0, 256))::BIGINT AS b)
      )
    ),
    corpus AS (
      SELECT 'document' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 'benchmark', item_id, coalesce(text, '') FROM benchmark
    ),
    split AS (
      SELECT side, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
      FROM corpus
    ),
    spread AS (SELECT side, id, unnest(words) AS word FROM split),
    hashed AS (
      SELECT word, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(1, strlen(word) + 1),
          lambda i: ('0x' || substr(hex(word), 2 * i - 1, 2))::BIGINT),
        lambda c, x: xor((c // 256), step[(xor(c, x) & 255) + 1])), 4294967295) % {buckets} AS bucket
      FROM (SELECT DISTINCT word FROM spread), steps
    ),
    features AS (SELECT side, id, bucket FROM spread JOIN hashed USING (word)),
    counts AS (
      SELECT bucket, sum((side = 'document')::BIGINT) AS s, sum((side = 'benchmark')::BIGINT) AS t
      FROM features GROUP BY bucket
    ),
    gains AS (
      SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + {buckets})::DOUBLE
        / ((s + 1)::DOUBLE * (all_t + {buckets})::DOUBLE)))::BIGINT AS gain
      FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)
    ),
    weights AS (
      SELECT id, sum(gain)::BIGINT AS weight FROM features JOIN gains USING (bucket)
      WHERE side = 'document' GROUP BY id
    ),
    scored AS (
      SELECT id AS doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('{seed}:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
             ))))::BIGINT AS score
      FROM split LEFT JOIN weights USING (id) WHERE side = 'document'
    ),
    placed AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
      FROM scored WHERE n_features >= {least_words}
    )
    SELECT s.doc_id, n_features, weight, score,
           (CASE WHEN place <= {percent} * n // 100 THEN place END)::BIGINT AS rank
    FROM scored s LEFT JOIN placed USING (doc_id)
    """


def centroids_sql(
    clusters: int = centroids.CLUSTERS,
    rounds: int = centroids.ROUNDS,
    width: int = centroids.WIDTH,
    scale: int = centroids.SCALE,
    seed: int = centroids.SEED,
) -> str:
    """One pair of common table expressions for each round."""
    distance = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))"
    parts = []
    for k in range(rounds + 1):
        parts.append(
            f"""near{k} AS MATERIALIZED (
      SELECT vec_id, any_value(v) AS v, arg_min(c, d * {clusters} + c) AS c, min(d)::BIGINT AS d FROM (
        SELECT x.vec_id, x.v, c.c, {distance} AS d FROM vectors x, cents{k} c
      ) GROUP BY vec_id)"""
        )
        if k < rounds:
            parts.append(
                f"""cents{k + 1} AS MATERIALIZED (
      SELECT o.c, coalesce(m.v, o.v) AS v FROM cents{k} o LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
          SELECT c, i, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n
          FROM (SELECT c, unnest(v) AS e, unnest(range(1, {width + 1})) AS i FROM near{k}) GROUP BY c, i
        ) GROUP BY c) m ON m.c = o.c)"""
            )
    return f"""
    WITH vectors AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE len(embedding) = {width}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    cents0 AS MATERIALIZED (
      SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INTEGER AS c, v FROM vectors
      QUALIFY c < {clusters}
    ),
    {", ".join(parts)}
    SELECT vec_id, n.c AS cluster, d AS distance,
           (sum(d) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(e.v, ',')) AS centroid_sha256
    FROM near{rounds} n JOIN cents{rounds} e ON e.c = n.c
    """


ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup_sql(),
    "op5_url_trust": url_trust_sql(),
    "op6_near_dup": near_dup_sql(),
    "op7_topk": topk_sql(),
    "op11_importance": importance_sql(),
    "op13_centroids": centroids_sql(),
}
