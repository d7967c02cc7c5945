"""SQL that yields the same rows as each query of the catalogue, on the same tables.

`pca_*_2d` and the feature tables of two features use the closed form of a 2 x 2 eigenproblem: with
variances a, c and covariance b the eigenvalues are (a+c)/2 +- sqrt(((a-c)/2)^2 + b^2), and for
standardized features 1 +- |correlation| with loadings (1, +-1)/sqrt(2).

`feature_table` and `scree_embeddings` take all 64 eigenvectors from Jacobi rotations.

In `feature_table_ends`, 99 % of the variance of 64 standardized features is 0.64 short of all:
all 64 components are needed if the smallest eigenvalue is above that, and 63 if twice it is.
"""

from __future__ import annotations

from fovea.plans.staging import bitmap_header

# one row per embedding element
ELEMENTS = """
elements AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
         generate_subscripts(embedding, 1) - 1 AS d
  FROM embeddings)"""

# one row per pixel of the staged bitmaps; stored bottom row first, shown top row first
PIXELS = f"""{ELEMENTS},
pixels AS (
  SELECT vec_id, label, d, (7 - d // 8) * 8 + d % 8 AS shown,
         CAST(least(255, greatest(0, floor(128 + 400 * v))) AS INTEGER) AS p
  FROM elements),
coded AS (
  SELECT *, lpad(hex((7 * p) % 256), 2, '0') || lpad(hex(255 - p), 2, '0')
            || lpad(hex(p), 2, '0') AS bgr
  FROM (SELECT vec_id, label, d, shown, p::UTINYINT::INTEGER AS p FROM pixels)),
images AS (
  SELECT vec_id, 'label=' || label AS class,
         string_agg(bgr, '' ORDER BY d) AS stored_hex,
         string_agg(bgr, '' ORDER BY shown) AS shown_hex
  FROM coded GROUP BY vec_id, label)"""

FILE_BYTES = f"unhex('{bitmap_header().hex()}' || stored_hex || '0A')"

CHANNELS = f"""{PIXELS},
channels AS (
  SELECT vec_id, shown * 3 + 0 AS i, (7 * p) % 256 - 103.939::DOUBLE AS x FROM pixels
  UNION ALL SELECT vec_id, shown * 3 + 1, 255 - p - 116.779::DOUBLE FROM pixels
  UNION ALL SELECT vec_id, shown * 3 + 2, p - 123.68::DOUBLE FROM pixels)"""


def _image_features(key: str) -> str:
    return f"""
WITH {CHANNELS},
features AS (
  SELECT vec_id, j, greatest(sum(x * ((7 * i + 3 * j) % 5 - 2)), 0) AS f
  FROM channels, range(4) outputs(j) GROUP BY vec_id, j)
SELECT class, md5({key}) AS image_key, j::INTEGER AS dim, round(f, 4) + 0.0 AS value
FROM features JOIN images USING (vec_id)"""


def _principal_axes(matrix: str, n: int = 64, sweeps: int = 9) -> str:
    """Eigenvalues and eigenvectors of an n x n matrix (n even), largest first, by Jacobi rotations.

    `matrix` yields (i, j, m). A step turns n/2 disjoint pairs of dimensions at once so that each
    pair's cell becomes zero; n - 1 steps, as in a round-robin tournament, meet every pair once. Kind
    0 is the matrix, kind 1 the product of all rotations, whose columns become the eigenvectors.
    """
    last = n - 1
    return f"""
matrix AS MATERIALIZED ({matrix}),
turned(step, kind, i, j, v) AS (
  SELECT 0, kind, i, j, v FROM (
    SELECT 0 AS kind, i, j, m AS v FROM matrix
    UNION ALL SELECT 1, i, j, (i = j)::DOUBLE FROM matrix)
  UNION ALL (
    WITH now AS (SELECT * FROM turned WHERE step < {last * sweeps}),
    cells AS (
      SELECT i AS p, j AS q, v AS shared,
             CASE WHEN i = {last} THEN step % {last} WHEN i = step % {last} THEN {last}
                  ELSE (2 * (step % {last}) - i + {2 * last}) % {last} END AS partner
      FROM now WHERE kind = 0),
    diagonal AS (SELECT i AS p, v AS d FROM now WHERE kind = 0 AND i = j),
    tangents AS (
      SELECT c.p, c.q, y.d - x.d AS apart,
             CASE WHEN shared = 0 THEN 0
                  ELSE CASE WHEN apart * shared < 0 OR apart = 0 AND c.p > c.q THEN -2 ELSE 2 END
                       * abs(shared) / (abs(apart) + sqrt(apart * apart + 4 * shared * shared)) END AS t
      FROM cells c JOIN diagonal x ON x.p = c.p JOIN diagonal y ON y.p = c.q WHERE c.q = partner),
    rotation AS (
      SELECT p AS a, p AS b, 1 / sqrt(1 + t * t) AS r FROM tangents
      UNION ALL SELECT p, q, t / sqrt(1 + t * t) FROM tangents)
    SELECT any_value(step) + 1, kind, coalesce(l.b, i), x.b, sum(v * x.r * coalesce(l.r, 1))
    FROM now JOIN rotation x ON x.a = j LEFT JOIN rotation l ON kind = 0 AND l.a = i
    GROUP BY kind, coalesce(l.b, i), x.b)),
ended AS MATERIALIZED (SELECT * FROM turned WHERE step = {last * sweeps}),
variances AS (
  SELECT j, row_number() OVER (ORDER BY v DESC)::INTEGER AS component, v / sum(v) OVER () AS share,
         sum(v) OVER (ORDER BY v DESC) / sum(v) OVER () AS cumulative
  FROM ended WHERE kind = 0 AND i = j),
axes AS (
  SELECT i AS d, j, v * sign(arg_min(v, i) FILTER (WHERE abs(v) > 1e-12) OVER (PARTITION BY j)) AS u
  FROM ended WHERE kind = 1)"""


PAIR_STATS = """
stats AS (
  SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c,
         covar_samp(l_quantity, l_extendedprice) AS b,
         corr(l_quantity, l_extendedprice) AS r,
         stddev_samp(l_quantity) AS sx, stddev_samp(l_extendedprice) AS sy
  FROM lineitem),
roots AS (
  SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1,
            (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS l2
  FROM stats),
scree AS (
  SELECT 'raw' AS variant, 1 AS component, l1 / (a + c) AS ev FROM roots
  UNION ALL SELECT 'raw', 2, l2 / (a + c) FROM roots
  UNION ALL SELECT 'std', 1, (1 + abs(r)) / 2 FROM roots
  UNION ALL SELECT 'std', 2, (1 - abs(r)) / 2 FROM roots),
curve AS (
  SELECT variant, component, ev,
         sum(ev) OVER (PARTITION BY variant ORDER BY component) AS cumulative
  FROM scree)"""


def _explained(variant: str) -> str:
    return f"""
WITH {PAIR_STATS}
SELECT component, round(ev, 6) + 0.0 AS explained_variance
FROM scree WHERE variant = '{variant}'"""


def _projection(components: int) -> str:
    return f"""
WITH {PAIR_STATS}
SELECT l_orderkey, l_linenumber, component,
       round((l_quantity / sx + CASE WHEN component = 1 THEN 1 ELSE -1 END * sign(r)
              * l_extendedprice / sy) / sqrt(2), 4) + 0.0 AS value
FROM lineitem, stats, (SELECT unnest(range(1, {components + 1}))::INTEGER AS component)"""


def _pool(function: str) -> str:
    return f"""
WITH {ELEMENTS}
SELECT vec_id, (d % 4)::INTEGER AS channel, round({function}(v), 4) + 0.0 AS value
FROM elements GROUP BY vec_id, d % 4"""


def _cut(column: str, width: int) -> str:
    text = f"coalesce({column}::VARCHAR, 'NULL')"
    return (
        f"CASE WHEN length({text}) > {width} THEN substr({text}, 1, {width - 3}) || '...' "
        f"ELSE {text} END"
    )


def _squarings(name: str, times: int) -> str:
    """CTEs that square the matrix `{name}_0` over and over, keeping its trace at one.

    What is left is the projector on the eigenvector of the largest eigenvalue.
    """
    steps = [
        f"""
{name}_{n + 1} AS MATERIALIZED (
  SELECT i, j, m / sum(m) FILTER (WHERE i = j) OVER () AS m
  FROM (SELECT x.i, y.j, sum(x.m * y.m) AS m
        FROM {name}_{n} x JOIN {name}_{n} y ON x.j = y.i GROUP BY x.i, y.j))"""
        for n in range(times)
    ]
    return ",".join(steps)


DOCUMENT_TYPES = (
    ("doc_id", "bigint"),
    ("text", "string"),
    ("lang", "string"),
    ("source", "string"),
    ("n_chars", "bigint"),
)

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"

ORACLES: dict[str, str] = {
    "binary_scan": f"""
WITH {PIXELS}
SELECT class, (54 + 192 + 1)::BIGINT AS length,
       md5({FILE_BYTES}) AS content_md5
FROM images
UNION ALL
SELECT 'label=page', (strlen(html) + 1)::BIGINT, md5(html || chr(10)) FROM pages""",
    "image_scan": f"""
WITH {PIXELS}
SELECT class, 8 AS height, 8 AS width, 3 AS n_channels, shown_hex AS pixels FROM images""",
    "dataset_inventory": """
SELECT class, count(*) AS n_files, sum(size)::BIGINT AS total_bytes FROM (
  SELECT 'label=' || label AS class, 54 + 192 + 1 AS size FROM embeddings
  UNION ALL SELECT 'label=page', strlen(html) + 1 FROM pages)
GROUP BY class""",
    "page_inventory": """
SELECT string_split(url, '/')[-2] AS class, count(*) AS n_files,
       sum(strlen(html))::BIGINT AS total_bytes
FROM pages GROUP BY 1""",
    "pack_files": f"""
WITH {PIXELS}
SELECT class, (54 + 192 + 1)::BIGINT AS length,
       md5({FILE_BYTES}) AS content_md5
FROM images
UNION ALL
SELECT 'label=page', (strlen(html) + 1)::BIGINT, md5(html || chr(10)) FROM pages""",
    "pack_changed": f"""
WITH {PIXELS},
rows AS (
  SELECT split_part(class, '=', 2) AS label, class FROM images
  UNION ALL SELECT 'page', 'label=page' FROM pages),
totals AS (SELECT class, count(*) AS n_rows FROM rows GROUP BY class)
SELECT class, 2::BIGINT AS n_files, n_rows FROM totals
UNION ALL SELECT 'call ' || call, CASE call WHEN 3 THEN 0 ELSE (SELECT count(*) FROM totals) END, NULL
FROM (SELECT unnest([1, 2, 3]) AS call)""",
    "store_settings": """
WITH first AS (SELECT * FROM customer ORDER BY c_custkey LIMIT 1)
SELECT 'fs.s3a.bucket.pictures.access.key' AS setting, 'KEY' || c_custkey AS value FROM first
UNION ALL SELECT 'fs.s3a.bucket.pictures.secret.key', c_mktsegment FROM first
UNION ALL SELECT 'uri', 's3a://pictures/training'""",
    "csv_scan": "SELECT c_name AS user_name, c_custkey, c_mktsegment FROM customer",
    "csv_rejects": """
WITH lines AS (
  SELECT *, c_custkey % 7 AS kind, concat_ws(';', CASE c_custkey % 7 WHEN 1 THEN 'x' ELSE '' END || c_custkey,
    '"' || c_name || '; of"', CASE WHEN c_custkey % 7 <> 2 THEN c_mktsegment END,
    CASE WHEN c_custkey % 7 = 3 THEN 'more' END) AS line
  FROM customer)
SELECT c_custkey, c_name || '; of' AS c_name, c_mktsegment, NULL AS line, NULL AS reject_reason
FROM lines WHERE kind NOT IN (1, 2, 3)
UNION ALL SELECT NULL, NULL, NULL, line,
       CASE kind WHEN 1 THEN 'not of its type: c_custkey' WHEN 2 THEN 'too few fields' ELSE 'too many fields' END
FROM lines WHERE kind IN (1, 2, 3)""",
    "mount_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, true AS mounted FROM orders",
    "sink_versions": """
SELECT o_orderkey, o_orderstatus, 'before' AS which FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, 'now' FROM orders WHERE o_orderstatus = 'F'""",
    "sink_overwrite": ORDERS,
    "sink_partitioned": ORDERS,
    "project": "SELECT doc_id, lang, source FROM documents",
    "filter_eq": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
    "scalar_lookup": "SELECT c_name, c_mktsegment FROM customer WHERE c_custkey = 7",
    "schema_report": " UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{name}' AS name, '{kind}' AS type, "
        f"count(*) AS n_rows, count(*) - count({name}) AS n_null FROM documents"
        for i, (name, kind) in enumerate(DOCUMENT_TYPES)
    ),
    "preview_default": "SELECT "
    + ", ".join(f"{_cut(name, 20)} AS {name}" for name, _ in DOCUMENT_TYPES)
    + " FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 20)",
    "preview_truncate": f"""
SELECT {_cut('doc_id', 60)} AS doc_id, {_cut('text', 60)} AS text
FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 30)""",
    "path_split": """
SELECT page_id, generate_subscripts(parts, 1)::INTEGER - 1 AS pos, unnest(parts) AS segment
FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)""",
    "class_from_path": "SELECT page_id, string_split(url, '/')[-2] AS class FROM pages",
    "url_encode_rfc3986": "SELECT page_id, url_encode(url) AS encoded FROM pages",
    "format_uri": """
SELECT c_custkey, concat('s3a://', lower(c_mktsegment), '/', url_encode(c_name)) AS uri
FROM customer""",
    "preprocess_bgr_mean": f"""
WITH {ELEMENTS}
SELECT vec_id, (d * 3 + channel)::INTEGER AS "at",
       round(CASE channel WHEN 0 THEN v * 3 - 103.939::DOUBLE WHEN 1 THEN v * 2 - 116.779::DOUBLE
                          ELSE v - 123.68::DOUBLE END, 4) + 0.0 AS value
FROM elements, range(3) channels(channel)""",
    "flatten_tensor": f"""
WITH {ELEMENTS}
SELECT vec_id, d::INTEGER AS "at", round(v, 4) + 0.0 AS value FROM elements""",
    "global_max_pool": _pool("max"),
    "global_avg_pool": _pool("avg"),
    "featurize_max_pool": _pool("max"),
    "featurize_avg_pool": _pool("avg"),
    "pooling_report": f"""
WITH {ELEMENTS},
pooled AS (
  SELECT vec_id, d % 4 AS channel, max(v) AS max_value, avg(v) AS avg_value
  FROM elements GROUP BY vec_id, d % 4),
long AS (
  SELECT 'max' AS pooling, channel, max_value AS v FROM pooled
  UNION ALL SELECT 'avg', channel, avg_value FROM pooled),
spread AS (
  SELECT pooling, avg(s) AS s
  FROM (SELECT pooling, channel, stddev_samp(v) AS s FROM long GROUP BY pooling, channel)
  GROUP BY pooling)
SELECT pooling, round(avg(v), 4) + 0.0 AS mean, round(stddev_samp(v), 4) + 0.0 AS stddev,
       round(min(v), 4) + 0.0 AS min, round(max(v), 4) + 0.0 AS max,
       round(any_value(s), 4) + 0.0 AS mean_dim_stddev
FROM long JOIN spread USING (pooling) GROUP BY pooling""",
    "featurize_linear": f"""
WITH {ELEMENTS}
SELECT vec_id, j::INTEGER AS dim,
       round(greatest(sum(v * ((7 * d + 3 * j) % 5 - 2)), 0), 4) + 0.0 AS value
FROM elements, range(8) outputs(j) GROUP BY vec_id, j""",
    "featurize_spread": f"""
WITH {ELEMENTS}
SELECT vec_id, j::INTEGER AS dim,
       round(greatest(sum(v * ((7 * d + 3 * j) % 5 - 2)), 0), 4) + 0.0 AS value
FROM elements, range(8) outputs(j) GROUP BY vec_id, j""",
    "pooling_quartiles": f"""
WITH {ELEMENTS},
pooled AS (
  SELECT vec_id, d % 4 AS channel, max(v) AS max_value, avg(v) AS avg_value
  FROM elements GROUP BY vec_id, d % 4),
long AS (
  SELECT 'max' AS pooling, channel, max_value AS v FROM pooled
  UNION ALL SELECT 'avg', channel, avg_value FROM pooled),
placed AS (
  SELECT pooling, channel, v, row_number() OVER (PARTITION BY pooling, channel ORDER BY v) AS place,
         count(*) OVER (PARTITION BY pooling, channel) AS n FROM long)
SELECT pooling, channel::INTEGER AS dim, q AS quantile, round(v, 6) + 0.0 AS value
FROM placed, (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS q) WHERE place = ceil(q * n)""",
    "featurize_bytes": """
SELECT doc_id, strlen(text)::BIGINT AS size, (strlen(text) - strlen(replace(text, ' ', '')))::BIGINT AS spaces
FROM documents""",
    "featurize_files": _image_features(FILE_BYTES),
    "featurize_images": _image_features("unhex(shown_hex)"),
    "shape_validate": """
SELECT 'label=' || label AS class, 'accepted' AS outcome, count(*) AS n
FROM embeddings GROUP BY label
UNION ALL SELECT 'label=page', 'not an image', count(*) FROM pages""",
    "featurize_rejects": """
SELECT 'label=page' AS class, 'not an image' AS reject_reason, count(*) AS n FROM pages""",
    "to_vector": f"""
WITH {ELEMENTS}
SELECT vec_id, d::INTEGER AS dim, round(v, 4) + 0.0 AS value FROM elements""",
    "scaler_stats": f"""
WITH {ELEMENTS}
SELECT d::INTEGER AS dim, round(stddev_samp(v), 6) + 0.0 AS std FROM elements GROUP BY d""",
    "scaler_transform": f"""
WITH {ELEMENTS}, stds AS (SELECT d, stddev_samp(v) AS s FROM elements GROUP BY d)
SELECT vec_id, d::INTEGER AS dim, round(v / s, 4) + 0.0 AS value
FROM elements JOIN stds USING (d)""",
    "covariance_matrix": f"""
WITH {ELEMENTS}
SELECT x.d::INTEGER AS i, y.d::INTEGER AS j, round(covar_samp(x.v, y.v), 6) + 0.0 AS covariance
FROM elements x JOIN elements y USING (vec_id) GROUP BY x.d, y.d""",
    "pca_explained_2d": _explained("raw"),
    "pca_std_explained_2d": _explained("std"),
    "scree_cumulative_2d": f"""
WITH {PAIR_STATS}
SELECT variant, component, round(cumulative, 6) + 0.0 AS cumulative FROM curve""",
    "select_k_2d": f"""
WITH {PAIR_STATS}
SELECT variant, min(component) AS k, round(arg_min(cumulative, component), 6) + 0.0 AS reached
FROM curve WHERE cumulative >= 0.99 GROUP BY variant""",
    "scree_compare_2d": f"""
WITH {PAIR_STATS}
SELECT component, round(x.cumulative, 6) + 0.0 AS raw_cumulative,
       round(y.cumulative, 6) + 0.0 AS std_cumulative,
       round(y.cumulative - x.cumulative, 6) + 0.0 AS delta
FROM curve x JOIN curve y USING (component) WHERE x.variant = 'raw' AND y.variant = 'std'""",
    "scree_zoom": f"""
WITH {PAIR_STATS}
SELECT component, round(cumulative, 6) + 0.0 AS cumulative, cumulative >= 0.99 AS above_threshold
FROM curve WHERE variant = 'std' AND component <= 31""",
    "pca_transform_2d": _projection(2),
    "pca_truncate_2d": _projection(1),
    "pca_raw_variance_2d": f"""
WITH {PAIR_STATS}
SELECT 1 AS component, round(log10(l1), 5) + 0.0 AS log_variance FROM roots
UNION ALL SELECT 2, round(log10(l2), 5) + 0.0 FROM roots""",
    "pca_invariants": f"""
WITH {ELEMENTS},
moments AS (
  SELECT x.d AS i, y.d AS j, covar_samp(x.v, y.v) AS c, corr(x.v, y.v) AS r
  FROM elements x JOIN elements y USING (vec_id) GROUP BY x.d, y.d),
matrices AS (
  SELECT 'raw' AS variant, i, j, c / avg(c) FILTER (WHERE i = j) OVER () AS m FROM moments
  UNION ALL SELECT 'std', i, j, r FROM moments),
squares AS (
  SELECT x.variant, x.i, y.j, sum(x.m * y.m) AS m
  FROM matrices x JOIN matrices y ON x.variant = y.variant AND x.j = y.i
  GROUP BY x.variant, x.i, y.j),
traces AS (
  SELECT variant, sum(s.m) FILTER (WHERE i = j) AS p2, sum(s.m * a.m) AS p3, sum(s.m * s.m) AS p4
  FROM squares s JOIN matrices a USING (variant, i, j) GROUP BY variant)
SELECT variant, power, round(CASE power WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END / 64, 6) + 0.0
       AS mean_power
FROM traces, (SELECT unnest([2, 3, 4])::INTEGER AS power)""",
    "pca_norms": f"""
WITH {ELEMENTS}, stds AS (SELECT d, stddev_samp(v) AS s FROM elements GROUP BY d)
SELECT vec_id, round(sum((v / s) ** 2), 4) + 0.0 AS squared_length
FROM elements JOIN stds USING (d) GROUP BY vec_id""",
    "reduce_rejects": """
SELECT CASE vec_id % 7 WHEN 1 THEN 'missing' WHEN 2 THEN 'wrong width' WHEN 3 THEN 'not finite'
         WHEN 4 THEN 'not finite' ELSE 'reduced' END AS outcome, count(*) AS n
FROM embeddings GROUP BY outcome""",
    "scree_embeddings": f"""
WITH RECURSIVE {ELEMENTS},
{_principal_axes("SELECT x.d AS i, y.d AS j, covar_samp(x.v, y.v) AS m FROM elements x JOIN elements y USING (vec_id) GROUP BY x.d, y.d")}
SELECT component, round(share, 6) + 0.0 AS explained_variance, round(cumulative, 6) + 0.0 AS cumulative
FROM variances""",
    "pca_low_rank": f"""
WITH RECURSIVE {ELEMENTS},
falling AS MATERIALIZED (SELECT vec_id, d, v * (4.0::DOUBLE / (d + 1)) AS x FROM elements),
{_principal_axes("SELECT x.d AS i, y.d AS j, covar_samp(x.x, y.x) AS m FROM falling x JOIN falling y USING (vec_id) GROUP BY x.d, y.d")},
whole AS (SELECT sum(m) AS total FROM matrix WHERE i = j)
SELECT component, round(share * total, 6) + 0.0 AS variance, round(share, 6) + 0.0 AS explained_variance,
       round(cumulative, 6) + 0.0 AS cumulative
FROM variances, whole WHERE component <= 6""",
    "pca_low_rank_projection": f"""
WITH RECURSIVE {ELEMENTS},
mixed AS (
  SELECT vec_id, d, sum(v * (4.0::DOUBLE / (d + 1))) OVER (PARTITION BY vec_id ORDER BY d) AS x FROM elements),
scaled AS MATERIALIZED (
  SELECT vec_id, d, x / s AS x
  FROM mixed JOIN (SELECT d, stddev_samp(x) AS s FROM mixed GROUP BY d) USING (d)),
{_principal_axes("SELECT x.d AS i, y.d AS j, corr(x.x, y.x) AS m FROM scaled x JOIN scaled y USING (vec_id) GROUP BY x.d, y.d")}
SELECT vec_id, component, round(sum(x * u), 4) + 0.0 AS value
FROM scaled JOIN axes USING (d) JOIN variances USING (j)
WHERE component <= 4 GROUP BY vec_id, component""",
    "feature_table": f"""
WITH RECURSIVE {ELEMENTS},
scaled AS MATERIALIZED (
  SELECT vec_id, label, d, v / s AS x
  FROM elements JOIN (SELECT d, stddev_samp(v) AS s FROM elements GROUP BY d) USING (d)),
{_principal_axes("SELECT x.d AS i, y.d AS j, corr(x.x, y.x) AS m FROM scaled x JOIN scaled y USING (vec_id) GROUP BY x.d, y.d")},
chosen AS (SELECT min(component) AS k FROM variances WHERE cumulative >= 0.99)
SELECT vec_id, any_value(label) AS class, any_value(k) AS k, component,
       round(sum(x * u), 4) + 0.0 AS value
FROM scaled JOIN axes USING (d) JOIN variances USING (j), chosen
WHERE component <= k GROUP BY vec_id, component""",
    "feature_table_ends": f"""
WITH {ELEMENTS},
scaled AS MATERIALIZED (
  SELECT vec_id, label, d, v / s AS x
  FROM elements JOIN (SELECT d, stddev_samp(v) AS s FROM elements GROUP BY d) USING (d)),
correlations AS MATERIALIZED (
  SELECT x.d AS i, y.d AS j, corr(x.x, y.x) AS m
  FROM scaled x JOIN scaled y USING (vec_id) GROUP BY x.d, y.d),
top_0 AS MATERIALIZED (SELECT i, j, m FROM correlations),
bottom_0 AS MATERIALIZED (
  SELECT i, j, CASE WHEN i = j THEN (SELECT sqrt(sum(m * m)) FROM correlations) ELSE 0 END - m AS m
  FROM correlations),
{_squarings("top", 22)},
{_squarings("bottom", 22)},
vectors AS (
  SELECT 'first' AS which, j AS d, m / sqrt(any_value(m) FILTER (WHERE j = 0) OVER ()) AS u
  FROM top_22 WHERE i = 0
  UNION ALL
  SELECT 'last', j, m / sqrt(any_value(m) FILTER (WHERE j = 0) OVER ())
  FROM bottom_22 WHERE i = 0),
smallest AS (
  SELECT sum(c.m * b.m) AS variance FROM correlations c JOIN bottom_22 b USING (i, j)),
chosen AS (
  SELECT CASE WHEN variance > 0.64 THEN 64 WHEN 2 * variance > 0.64 THEN 63 END::INTEGER AS k
  FROM smallest),
products AS (
  SELECT vec_id, any_value(label) AS label,
         sum(x * u) FILTER (WHERE which = 'first') AS first_component,
         sum(x * u) FILTER (WHERE which = 'last') AS last_component,
         sum(x * x) FILTER (WHERE which = 'first') AS total
  FROM scaled JOIN vectors USING (d) GROUP BY vec_id)
SELECT vec_id, label AS class, k, round(first_component, 4) + 0.0 AS first_component,
       round(total - CASE WHEN k = 63 THEN last_component ** 2 ELSE 0 END, 4) + 0.0
       AS squared_length
FROM products, chosen""",
    "feature_table_files": f"""
WITH {CHANNELS},
features AS (
  SELECT vec_id, sum(x * ((7 * i) % 5 - 2)) AS f0, sum(x * ((7 * i + 3) % 5 - 2)) AS f1
  FROM channels GROUP BY vec_id),
stats AS (
  SELECT stddev_samp(f0) AS s0, stddev_samp(f1) AS s1, corr(f0, f1) AS r FROM features)
SELECT class, md5({FILE_BYTES}) AS image_key, component,
       round((f0 / s0 + CASE WHEN component = 1 THEN 1 ELSE -1 END * sign(r) * f1 / s1)
             / sqrt(2), 4) + 0.0 AS value
FROM features JOIN images USING (vec_id), stats, (SELECT unnest([1, 2])::INTEGER AS component)
WHERE component = 1 OR (1 + abs(r)) / 2 < 0.99""",
    "feature_table_resumed": """
SELECT run, count(*) AS n_rows, CASE run WHEN 'second' THEN 0 ELSE count(*) END AS n_inferred
FROM embeddings, (SELECT unnest(['first', 'second', 'other scale']) AS run) WHERE label = 1 GROUP BY run""",
    "stream_scores": f"""
SELECT p.* FROM ({_projection(2)}) p, (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem)
WHERE component = 1 OR (1 + abs(r)) / 2 < 0.99""",
}
