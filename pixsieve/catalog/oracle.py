"""The same answers in SQL for DuckDB, over the whole tables."""

_SAMPLES = r"""
WITH RECURSIVE e AS (SELECT vec_id AS v, embedding::DOUBLE[] AS x FROM embeddings),
turns AS (
  SELECT least((SELECT count(*) FROM embeddings), (SELECT count(*) FROM documents) // 2) AS n
),
ids AS (SELECT doc_id AS id, doc_id % n AS v, doc_id // n AS turn, n FROM documents, turns),
vec AS (
  SELECT i.id, i.v, e2.x AS x2,
    CASE WHEN i.turn = 0 OR i.v % 3 = 2 THEN e.x
      WHEN i.v % 3 = 0 THEN list_transform(range(len(e.x)),
        lambda p: e.x[p + 1] + (((i.v * 31 + p * 17 + i.turn * 7) % 11) - 5) / 100.0::DOUBLE)
      ELSE list_transform(range(len(e.x)), lambda p: e.x[p + 1] + i.turn * e2.x[p + 1]) END AS img
  FROM ids i JOIN e ON e.v = i.v JOIN e e2 ON e2.v = (i.v * 7 + 3) % i.n
),
vt AS (
  SELECT id, v, img,
    list_transform(range(len(img)), lambda p: img[p + 1] + (id % 10) / 2.0::DOUBLE * x2[p + 1]) AS txt,
    list_transform(img, lambda a: greatest(0, least(255,
      floor(128 + a * 127 * ((id % 8) / 8.0::DOUBLE))))::INTEGER) AS pix
  FROM vec
),
scored AS (
  SELECT *,
    list_dot_product(img, txt) / (sqrt(list_dot_product(img, img)) * sqrt(list_dot_product(txt, txt))) AS cs,
    list_aggregate(list_transform(range(64), lambda p:
      pix[abs(p // 8 - 1) * 8 + p % 8 + 1] + pix[(7 - abs(7 - (p // 8 + 1))) * 8 + p % 8 + 1]
      + pix[(p // 8) * 8 + abs(p % 8 - 1) + 1] + pix[(p // 8) * 8 + (7 - abs(7 - (p % 8 + 1))) + 1]
      - 4 * pix[p + 1]), 'var_pop') AS blur
  FROM vt
),
s AS (
  SELECT row_number() OVER (ORDER BY r.id) AS row_idx, r.id, r.img, r.txt, r.pix, r.cs, r.blur,
    CASE WHEN r.id % 97 = 7 THEN '' ELSE format('vg_{:06d}', row_number() OVER (ORDER BY r.id)) END AS sample_id,
    CASE WHEN r.id % 97 = 5 THEN NULL WHEN r.id % 97 = 6 THEN '' ELSE d.text END AS image_prompt,
    CASE WHEN r.id % 97 = 8 THEN NULL WHEN r.id % 97 = 9 THEN '' ELSE 'img/' || r.id || '.png' END AS image_path,
    CASE WHEN r.id % 97 <> 10 THEN (320 + (r.id * 37) % 1200)::INTEGER END AS width,
    (240 + (r.id * 53) % 1000)::INTEGER AS height,
    (320 + (r.id * 37) % 1200)::INTEGER AS fw, (240 + (r.id * 53) % 1000)::INTEGER AS fh,
    r.id % 97 NOT IN (8, 9, 12) AS has_file, r.id % 97 NOT IN (8, 9, 12, 13) AS decoded,
    CASE WHEN r.id % 97 = 11 THEN 'rejected' ELSE 'pending' END AS status0,
    CASE WHEN r.id % 97 = 11 THEN 'upstream' END AS reason0
  FROM scored r JOIN documents d ON d.doc_id = r.id
)"""

_VALIDATION = """CASE WHEN sample_id = '' THEN 'missing_sample_id'
    WHEN coalesce(image_path, '') = '' THEN 'missing_image_path'
    WHEN coalesce(image_prompt, '') = '' THEN 'missing_image_prompt' END"""
_LOADING = "CASE WHEN NOT has_file THEN 'missing_image' WHEN NOT decoded THEN 'invalid_image' END"

# The default chain, with the place where each row was rejected.
_CHAIN = _SAMPLES + f""",
steps AS (
  SELECT *, status0 = 'rejected' AS pre, {_VALIDATION} AS r1, {_LOADING} AS r2,
    CASE WHEN fw < 512 OR fh < 512 THEN 'low_resolution' END AS r3,
    CASE WHEN blur < 100 THEN 'blurry_image' END AS r4,
    CASE WHEN cs < 0.2::DOUBLE THEN 'low_clip_alignment' END AS r5
  FROM s
),
placed AS (
  SELECT *, CASE WHEN pre THEN -1 WHEN r1 IS NOT NULL THEN 1 WHEN r2 IS NOT NULL THEN 2
    WHEN r3 IS NOT NULL THEN 3 WHEN r4 IS NOT NULL THEN 4 WHEN r5 IS NOT NULL THEN 5 END AS rank_no
  FROM steps
),
c AS (
  SELECT row_idx, id, sample_id, image_prompt, image_path, img, pix, rank_no,
    CASE WHEN rank_no IS NULL OR rank_no > 2 THEN fw ELSE width END AS width,
    CASE WHEN rank_no IS NULL OR rank_no > 2 THEN fh ELSE height END AS height,
    CASE WHEN rank_no IS NULL OR rank_no >= 4 THEN blur END AS blur_score,
    CASE WHEN rank_no IS NULL OR rank_no >= 5 THEN cs END AS clip_score,
    CASE WHEN rank_no IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
    CASE rank_no WHEN -1 THEN 'upstream' WHEN 1 THEN r1 WHEN 2 THEN r2 WHEN 3 THEN r3 WHEN 4 THEN r4
      WHEN 5 THEN r5 END AS reject_reason,
    CASE rank_no WHEN 1 THEN 'SampleValidator' WHEN 2 THEN 'ImageLoader' WHEN 3 THEN 'ResolutionFilter'
      WHEN 4 THEN 'BlurFilter' WHEN 5 THEN 'CLIPAlignmentOperator' END AS rejected_by
  FROM placed
)"""

_QUALITY = """0.2::DOUBLE * least(coalesce(width, 0)::DOUBLE * coalesce(height, 0) / 2073600.0::DOUBLE, 1.0::DOUBLE)
    + 0.3::DOUBLE * least(coalesce(blur_score, 0) / 500.0::DOUBLE, 1.0::DOUBLE)
    + 0.5::DOUBLE * least(greatest(coalesce(clip_score, 0), 0), 1.0::DOUBLE)"""


def _replay(similarity: str) -> str:
    """The sequential rule over ``d(i, row_idx, q, u)``, with 0-based ``i`` in input order."""
    return f""",
near AS MATERIALIZED (
  SELECT a.i, b.i AS j, {similarity} AS sim FROM d a JOIN d b ON b.i < a.i
),
nbl AS MATERIALIZED (
  SELECT d.i, any_value(d.q) AS q, coalesce(list(n.j) FILTER (n.j IS NOT NULL), []) AS nb
  FROM d LEFT JOIN near n ON n.i = d.i AND n.hit GROUP BY d.i
),
g(i, kept, dup, keep) AS (
  SELECT -1::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT t.i,
    CASE WHEN t.m IS NULL THEN list_append(t.kept, t.i)
      WHEN t.q > o.q THEN list_append(list_filter(t.kept, lambda k: k <> t.m), t.i) ELSE t.kept END,
    CASE WHEN t.m IS NULL THEN NULL WHEN t.q > o.q THEN t.m ELSE t.i END,
    CASE WHEN t.m IS NULL THEN NULL WHEN t.q > o.q THEN t.i ELSE t.m END
  FROM (
    SELECT g.kept, n.i, n.q, list_filter(g.kept, lambda k: list_contains(n.nb, k))[1] AS m
    FROM g JOIN nbl n ON n.i = g.i + 1
  ) t LEFT JOIN nbl o ON o.i = t.m
),
found AS (
  SELECT x.row_idx AS duplicate_idx, y.row_idx AS kept_idx, round(n.sim, 6) AS similarity,
    round(x.q, 6) AS duplicate_quality, round(y.q, 6) AS kept_quality
  FROM g JOIN d x ON x.i = g.dup JOIN d y ON y.i = g.keep
  JOIN near n ON n.i = greatest(g.dup, g.keep) AND n.j = least(g.dup, g.keep)
)""".replace("AS sim FROM", "AS sim, sim >= THRESHOLD AS hit FROM")


_COSINE64 = "array_cosine_similarity(a.u::DOUBLE[64], b.u::DOUBLE[64])"

_DEDUP = _CHAIN + f""",
p AS (SELECT *, {_QUALITY} AS q FROM c WHERE status = 'accepted'),
d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY row_idx) - 1 AS i, row_idx, sample_id, q, img AS u FROM p
)""" + _replay(_COSINE64).replace("THRESHOLD", "0.95::DOUBLE")

_FINAL = _DEDUP + """,
f AS (
  SELECT c.* REPLACE (
    CASE WHEN found.duplicate_idx IS NOT NULL THEN 'rejected' ELSE c.status END AS status,
    CASE WHEN found.duplicate_idx IS NOT NULL THEN 'semantic_duplicate' ELSE c.reject_reason END AS reject_reason,
    CASE WHEN found.duplicate_idx IS NOT NULL THEN 'SemanticDedup' ELSE c.rejected_by END AS rejected_by)
  FROM c LEFT JOIN found ON found.duplicate_idx = c.row_idx
)"""

_OPERATORS = """(VALUES ('SampleValidator', 0), ('ImageLoader', 1), ('ResolutionFilter', 2),
  ('BlurFilter', 3), ('CLIPAlignmentOperator', 4)) o(operator, op_pos)"""
_METRICS = """m AS (
  SELECT o.operator, o.op_pos,
    (count_if(c.rank_no IS NULL OR c.rank_no > o.op_pos))::BIGINT AS processed,
    coalesce(count_if(c.rank_no = o.op_pos + 1), 0)::BIGINT AS rejected
  FROM c CROSS JOIN """ + _OPERATORS + " GROUP BY ALL)"

_CAPTION_BATCHES = """
cap AS (
  SELECT *, (row_number() OVER (ORDER BY row_idx) - 1) // 4 AS batch_id, list_sum(pix)::BIGINT AS total,
    row_idx % 19 <> 0 AS opened
  FROM todo
),
bad AS (SELECT batch_id, bool_or(opened AND total % 50 = 7) AS broken FROM cap GROUP BY batch_id),
ann AS (
  SELECT row_idx, sample_id, image_path,
    CASE WHEN opened AND NOT broken THEN '64 bytes, sum ' || total ELSE '' END AS caption,
    'Salesforce/blip-image-captioning-base' AS model_name,
    CASE WHEN opened AND NOT broken THEN 'success' ELSE 'failed' END AS status,
    CASE WHEN NOT opened THEN 'cannot identify image file' WHEN broken THEN 'captioner failed' END AS error
  FROM cap JOIN bad USING (batch_id)
)"""
_ANNOTATIONS = _FINAL + ", todo AS (SELECT * FROM f WHERE status = 'accepted')," + _CAPTION_BATCHES

_RECORDS = """
r AS (
  SELECT doc_id, text, 'img/' || doc_id || '.png' AS image_path, n_chars::INTEGER AS width,
    length(source)::INTEGER AS height
  FROM documents
)"""
_SAMPLE_ROW = """format('vg_{:06d}', doc_id + 1) AS sample_id, 'visual_genome' AS "character", scene,
  '' AS dialogue, scene AS image_prompt, '' AS emotion, '' AS action, 'real_image' AS visual_style,
  image_path, width, height, NULL::DOUBLE AS blur_score, NULL::DOUBLE AS clip_score,
  'pending' AS status, NULL::VARCHAR AS reject_reason"""

_REGIONS = r"""
WITH regions AS (
  SELECT doc_id AS pos, doc_id AS id, string_split(text, '. ') AS parts FROM documents
  UNION ALL
  SELECT doc_id + 1000000000, doc_id, string_split(' ' || text, chr(10)) FROM documents
  WHERE contains(text, chr(10))
  UNION ALL
  SELECT doc_id + 2000000000, doc_id, []::VARCHAR[] FROM labels WHERE toxic = 1
),
phrases AS (
  SELECT id, pos, len(parts)::INTEGER AS regions,
    regexp_replace(coalesce(parts[1], ''), '^\s+|\s+$', '', 'g') AS phrase FROM regions
),
manifest AS (
  SELECT d.doc_id AS pos, 'visual_genome' AS source, d.doc_id AS image_id,
    'data/visual_genome/images/' || format('vg_{:06d}', d.doc_id) || '.jpg' AS image_path,
    'http://example.com/' || d.doc_id AS image_url, (200 + d.n_chars % 900)::INTEGER AS width,
    CASE WHEN d.doc_id % 13 <> 6 THEN d.n_chars::INTEGER END AS height, t.text
  FROM documents d JOIN (SELECT id, arg_max(phrase, pos) AS text FROM phrases GROUP BY id) t ON t.id = d.doc_id
  WHERE t.text <> ''
)"""

_RUNS = """
WITH runs AS (
  SELECT [100, 500, 1000][user_id % 3 + 1]::BIGINT AS samples, event_type AS executor, event_id AS run,
    abs(value) + 0.5::DOUBLE AS seconds,
    (event_id * 7) % [100, 500, 1000][user_id % 3 + 1] AS accepted FROM events
),
rollup AS (
  SELECT samples, executor, count(*) AS runs, median(seconds) AS median_time,
    median(samples / seconds) AS median_throughput, arg_max(accepted, run) AS accepted,
    samples - arg_max(accepted, run) AS rejected
  FROM runs GROUP BY samples, executor
)"""

_LETTERS = "abcdefgh"


def _letter(c: str) -> str:
    return f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE"


_VERDICT = "row_idx, status, reject_reason"

ORACLE_SQL: dict[str, str] = {
    "validator": _SAMPLES + f""", j AS (SELECT *, {_VALIDATION} AS why FROM s)
SELECT row_idx, CASE WHEN why IS NULL THEN 'validated' ELSE 'rejected' END AS status,
  why AS reject_reason FROM j""",
    "resolve_image_path": _SAMPLES + """
SELECT row_idx, CASE WHEN coalesce(image_path, '') <> '' THEN image_path
  ELSE 'outputs/images/' || sample_id || '.jpg' END AS resolved_path FROM s""",
    "image_loader": _SAMPLES + f""", j AS (SELECT *, {_LOADING} AS why FROM s)
SELECT row_idx, CASE WHEN why IS NULL THEN status0 ELSE 'rejected' END AS status,
  coalesce(why, reason0) AS reject_reason, image_path,
  CASE WHEN decoded THEN fw ELSE width END AS width, CASE WHEN decoded THEN fh ELSE height END AS height
FROM j""",
    "listed_images": _SAMPLES + f""", j AS (
  SELECT *, CASE WHEN status0 = 'rejected' THEN -1 WHEN {_VALIDATION} IS NOT NULL THEN 1
    WHEN {_LOADING} IS NOT NULL THEN 2 WHEN blur < 100 THEN 3 END AS rank_no, {_VALIDATION} AS r1, {_LOADING} AS r2 FROM s)
SELECT row_idx, CASE WHEN rank_no IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
  CASE rank_no WHEN -1 THEN reason0 WHEN 1 THEN r1 WHEN 2 THEN r2 WHEN 3 THEN 'blurry_image' END AS reject_reason, image_path,
  CASE WHEN rank_no IS NULL OR rank_no = 3 THEN 8 ELSE width END::INTEGER AS width,
  CASE WHEN rank_no IS NULL OR rank_no = 3 THEN 8 ELSE height END::INTEGER AS height,
  CASE WHEN rank_no IS NULL OR rank_no = 3 THEN round(blur, 6) END AS blur_score,
  CASE rank_no WHEN 1 THEN 'SampleValidator' WHEN 2 THEN 'ImageLoader' WHEN 3 THEN 'BlurFilter' END AS rejected_by FROM j""",
    "resolution_filter": _SAMPLES + """, j AS (
  SELECT *, CASE WHEN status0 = 'rejected' THEN NULL WHEN width IS NULL OR height IS NULL THEN 'missing_resolution'
    WHEN width < 512 OR height < 512 THEN 'low_resolution' END AS why FROM s)
SELECT row_idx, CASE WHEN why IS NULL THEN status0 ELSE 'rejected' END AS status,
  coalesce(why, reason0) AS reject_reason FROM j""",
    "blur_score": _SAMPLES + """
SELECT 'img/' || id || '.png' AS path, CASE WHEN id % 97 = 13 THEN -1 ELSE 8 END::INTEGER AS decoded_width,
  CASE WHEN id % 97 = 13 THEN -1 ELSE 8 END::INTEGER AS decoded_height,
  CASE WHEN id % 97 <> 13 THEN round(blur, 6) END AS blur_score FROM s WHERE id % 97 <> 12""",
    "blur_filter": _SAMPLES + """, j AS (
  SELECT *, CASE WHEN coalesce(image_path, '') = '' THEN 'missing_image_path' WHEN NOT decoded THEN 'invalid_image'
    WHEN blur < 100 THEN 'blurry_image' END AS why, status0 = 'rejected' AS pre FROM s)
SELECT row_idx, CASE WHEN pre OR why IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS status,
  CASE WHEN pre THEN reason0 ELSE why END AS reject_reason,
  CASE WHEN NOT pre AND decoded THEN round(blur, 6) END AS blur_score FROM j""",
    "cosine_alignment": _SAMPLES + " SELECT id, round(cs, 6) AS clip_score FROM s",
    "alignment_filter": _SAMPLES + """, j AS (
  SELECT *, CASE WHEN coalesce(image_prompt, '') = '' THEN 'missing_image_prompt'
    WHEN cs < 0.2::DOUBLE THEN 'low_clip_alignment' END AS why, status0 = 'rejected' AS pre FROM s)
SELECT row_idx, CASE WHEN pre OR why IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS status,
  CASE WHEN pre THEN reason0 ELSE why END AS reject_reason,
  CASE WHEN NOT pre AND coalesce(image_prompt, '') <> '' THEN round(cs, 6) END AS clip_score FROM j""",
    "l2_normalize": """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
n AS (SELECT vec_id, x, greatest(sqrt(list_dot_product(x, x)), 1e-12) AS norm, unnest(range(len(x))) AS pos FROM e)
SELECT vec_id, pos::INTEGER AS pos, round(x[pos + 1] / norm, 6) AS value FROM n""",
    "quality_score": _SAMPLES + f""", j AS (
  SELECT row_idx, width, height, cs AS clip_score,
    CASE WHEN status0 <> 'rejected' AND decoded THEN blur END AS blur_score FROM s)
SELECT row_idx,
  round(least(coalesce(width, 0)::DOUBLE * coalesce(height, 0) / 2073600.0::DOUBLE, 1.0::DOUBLE), 9) AS resolution,
  round(least(coalesce(blur_score, 0) / 500.0::DOUBLE, 1.0::DOUBLE) * (500 * 4096))::BIGINT AS sharpness_units,
  round(least(greatest(coalesce(clip_score, 0), 0), 1.0::DOUBLE), 9) AS alignment,
  round({_QUALITY}, 9) AS quality FROM j""",
    "quality_pipeline": _CHAIN + f"""
SELECT {_VERDICT}, sample_id, image_path, width, height, round(blur_score, 6) AS blur_score,
  round(clip_score, 6) AS clip_score, rejected_by FROM c""",
    "configured_pipeline": _SAMPLES + f""", j AS (
  SELECT *, CASE WHEN status0 = 'rejected' THEN -1 WHEN {_VALIDATION} IS NOT NULL THEN 1
    WHEN width IS NULL THEN 2 WHEN width < 400 OR height < 300 THEN 3 WHEN cs < 0.35::DOUBLE THEN 4
    WHEN NOT decoded THEN 5 WHEN blur < 400 THEN 6 END AS rank_no, {_VALIDATION} AS r1 FROM s)
SELECT row_idx, CASE WHEN rank_no IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
  CASE rank_no WHEN -1 THEN 'upstream' WHEN 1 THEN r1 WHEN 2 THEN 'missing_resolution' WHEN 3 THEN 'low_resolution'
    WHEN 4 THEN 'low_clip_alignment' WHEN 5 THEN 'invalid_image' WHEN 6 THEN 'blurry_image' END AS reject_reason,
  CASE WHEN rank_no IS NULL OR rank_no >= 4 THEN round(cs, 6) END AS clip_score,
  CASE WHEN rank_no = 1 THEN 'SampleValidator' WHEN rank_no IN (2, 3) THEN 'ResolutionFilter'
    WHEN rank_no = 4 THEN 'CLIPAlignmentOperator' WHEN rank_no IN (5, 6) THEN 'BlurFilter' END AS rejected_by FROM j""",
    "custom_operator": _SAMPLES + f""", j AS (
  SELECT *, CASE WHEN status0 = 'rejected' THEN -1 WHEN {_VALIDATION} IS NOT NULL THEN 1
    WHEN NOT contains(image_prompt, '.') THEN 2 END AS rank_no, {_VALIDATION} AS r1 FROM s)
SELECT row_idx, CASE WHEN rank_no IS NULL THEN 'validated' ELSE 'rejected' END AS status,
  CASE rank_no WHEN -1 THEN 'upstream' WHEN 1 THEN r1 WHEN 2 THEN 'no_sentence' END AS reject_reason,
  CASE rank_no WHEN 1 THEN 'SampleValidator' WHEN 2 THEN 'FullStop' END AS rejected_by FROM j""",
    "accepted_samples": _CHAIN + " SELECT row_idx, sample_id FROM c WHERE status = 'accepted'",
    "canonical_projection": f"""WITH {_RECORDS}, t AS (SELECT *, text AS scene FROM r)
SELECT {_SAMPLE_ROW} FROM t""",
    "manifest_source": f"""WITH {_RECORDS}, t AS (
  SELECT *, CASE WHEN doc_id % 89 = 2 THEN '' WHEN doc_id % 89 <> 3 THEN text END AS scene
  FROM r WHERE doc_id % 89 <> 1)
SELECT doc_id + 1 AS row_idx, {_SAMPLE_ROW} FROM t""",
    "row_index": "SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS row_idx FROM documents",
    "format_ids": "SELECT o_orderkey, format('vg_{:06d}', o_orderkey * 97) AS sample_id FROM orders",
    "strip_text": r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(chr(9) || ' ' || chr(10) || text || ' ' || chr(13) || chr(10),
  '^\s+|\s+$', '', 'g') AS stripped FROM conversations) SELECT * FROM t WHERE stripped <> ''""",
    "prefix_sample": _SAMPLES + " SELECT row_idx, sample_id FROM s ORDER BY row_idx LIMIT 5",
    "ordered_samples": _SAMPLES + " SELECT row_idx, id, row_number() OVER (ORDER BY id) AS position FROM s",
    "manifest_builder": _REGIONS + """
SELECT * FROM manifest WHERE image_id IN (SELECT doc_id FROM labels) ORDER BY pos LIMIT 1000""",
    "manifest_sink": _REGIONS + """, k AS (SELECT *, row_number() OVER (ORDER BY pos) AS row_idx FROM manifest)
SELECT row_idx, format('vg_{:06d}', row_idx) AS sample_id, text AS scene, image_path, width, height FROM k""",
    "region_source": _REGIONS + " SELECT row_number() OVER (ORDER BY pos) AS pos, id, regions, phrase FROM phrases",
    "similarity_join": _SAMPLES + """, j AS MATERIALIZED (SELECT row_idx, img::DOUBLE[64] AS u FROM s)
SELECT a.row_idx AS left_row, b.row_idx AS right_row, round(array_cosine_similarity(a.u, b.u), 6) AS similarity
FROM j a JOIN j b ON a.row_idx < b.row_idx WHERE array_cosine_similarity(a.u, b.u) >= 0.95::DOUBLE""",
    "approximate_join": _SAMPLES + """, j AS MATERIALIZED (SELECT row_idx, img::DOUBLE[64] AS u FROM s),
planes AS MATERIALIZED (
  SELECT n, list((h % 2001 - 1000)::DOUBLE ORDER BY p)::DOUBLE[64] AS w FROM (
    SELECT n, p, (g * g + n + 1) % 2147483647 AS h FROM (
      SELECT n, p, (f * f + n + 1) % 2147483647 AS g FROM (
        SELECT n, p, (n * 7919 + p * 104729 + 12345) % 2147483647 AS f FROM range(640) a(n), range(64) b(p))))
  GROUP BY n
),
codes AS MATERIALIZED (
  SELECT row_idx, n // 16 AS band, sum(CASE WHEN array_dot_product(u, w) > 0 THEN 1::BIGINT << (n % 16)::INTEGER ELSE 0 END) AS code
  FROM j CROSS JOIN planes GROUP BY row_idx, n // 16
),
met AS (
  SELECT DISTINCT a.row_idx AS x, b.row_idx AS y FROM codes a JOIN codes b
  ON a.band = b.band AND a.code = b.code AND a.row_idx < b.row_idx
)
SELECT x AS left_row, y AS right_row, round(array_cosine_similarity(a.u, b.u), 6) AS similarity
FROM met JOIN j a ON a.row_idx = x JOIN j b ON b.row_idx = y WHERE array_cosine_similarity(a.u, b.u) >= 0.95::DOUBLE""",
    "semantic_dedup": _DEDUP + " SELECT * FROM found",
    "dedup_rounds": """
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id AS row_idx, embedding AS u,
    (vec_id * 37) % 101 / 101.0::DOUBLE AS q FROM embeddings)""" + _replay(
        "array_cosine_similarity(a.u::FLOAT[64]::DOUBLE[64], b.u::FLOAT[64]::DOUBLE[64])"
    ).replace("THRESHOLD", "0.4::DOUBLE") + " SELECT * FROM found",
    "dedup_copies": f"""
WITH RECURSIVE counts AS (
  SELECT doc_id, [{', '.join(_letter(c) for c in _LETTERS)}] AS u FROM documents),
d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, doc_id AS row_idx, u::DOUBLE[8] AS u,
    (doc_id * 37) % 11 / 11.0::DOUBLE AS q FROM counts WHERE list_sum(u) > 0)""" + _replay(
        "array_cosine_similarity(a.u, b.u)"
    ).replace("THRESHOLD", "0.9999::DOUBLE") + " SELECT * FROM found",
    "dedup_rising": f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, doc_id AS row_idx,
    [1.0::DOUBLE, {', '.join(f'(doc_id * {k} % 89 + n_chars % 7) / 1000.0::DOUBLE' for k in (3, 5, 11))}]::DOUBLE[4] AS u,
    doc_id / (SELECT count(*) FROM documents)::DOUBLE AS q FROM documents)""" + _replay(
        "array_cosine_similarity(a.u, b.u)"
    ).replace("THRESHOLD", "0.95::DOUBLE") + " SELECT * FROM found",
    "duplicate_pairs": _DEDUP + """
SELECT x.sample_id AS duplicate_sample_id, y.sample_id AS kept_sample_id, similarity, duplicate_quality, kept_quality
FROM found JOIN d x ON x.row_idx = duplicate_idx JOIN d y ON y.row_idx = kept_idx""",
    "dedup_metrics": _DEDUP + """
SELECT (SELECT count(*) FROM d) AS input_samples, (SELECT count(*) FROM found) AS duplicates_removed,
  (SELECT count(*) FROM d) - (SELECT count(*) FROM found) AS output_samples""",
    "dedup_writeback": _FINAL + f" SELECT {_VERDICT}, rejected_by FROM f WHERE row_idx IN (SELECT row_idx FROM d)",
    "dedup_survivors": _FINAL + " SELECT row_idx, sample_id FROM f WHERE status = 'accepted'",
    "curate_dataset": _FINAL + f"""
SELECT {_VERDICT}, sample_id, image_path, width, height, round(blur_score, 6) AS blur_score,
  round(clip_score, 6) AS clip_score FROM f""",
    "status_counts": _FINAL + """
SELECT count_if(status = 'accepted')::BIGINT AS accepted, count_if(status = 'rejected')::BIGINT AS rejected FROM f""",
    "operator_metrics": _CHAIN + f", {_METRICS} SELECT operator, op_pos, processed, rejected FROM m",
    "merge_metrics": _CHAIN + f", {_METRICS} SELECT operator, processed, rejected FROM m",
    "curation_funnel": _FINAL + f""", {_METRICS}, stages AS (
  SELECT 'Input' AS stage, 0 AS stage_pos, 0::BIGINT AS removed
  UNION ALL SELECT operator, op_pos + 1, rejected FROM m
  UNION ALL SELECT 'SemanticDedup', 6, (SELECT count(*) FROM found))
SELECT stage, stage_pos::INTEGER AS stage_pos, ((SELECT max(processed) FROM m)
  - sum(removed) OVER (ORDER BY stage_pos))::BIGINT AS remaining, removed FROM stages""",
    "all_metrics": _FINAL + f""", {_METRICS}
SELECT operator, processed, rejected, NULL::BIGINT AS input_samples, NULL::BIGINT AS duplicates_removed,
  NULL::BIGINT AS output_samples FROM m
UNION ALL
SELECT 'SemanticDedup', NULL, NULL, (SELECT count(*) FROM d), (SELECT count(*) FROM found),
  (SELECT count(*) FROM d) - (SELECT count(*) FROM found)""",
    "dataset_sink": _FINAL + """
SELECT sample_id, image_prompt AS scene, image_prompt, image_path, width, height, round(blur_score, 6) AS blur_score,
  round(clip_score, 6) AS clip_score, status, reject_reason FROM f""",
    "run_rollup": _RUNS + """
SELECT samples, executor, runs, round(median_time, 6) AS median_time,
  round(median_throughput, 6) AS median_throughput, accepted, rejected FROM rollup""",
    "sketched_rollup": _RUNS + " SELECT samples, executor, runs, accepted, rejected, 1 AS close FROM rollup",
    "run_speedup": _RUNS + """
SELECT a.samples, a.executor, round(a.median_throughput / b.median_throughput, 6) AS speedup
FROM rollup a LEFT JOIN rollup b ON b.samples = a.samples AND b.executor = 'view'""",
    "text_encoder": "SELECT doc_id, " + ", ".join(f"{_letter(c)} AS n_{c}" for c in _LETTERS) + " FROM documents",
    "image_encoder": _SAMPLES + """
SELECT 'img/' || id || '.png' AS path,
  CASE WHEN id % 97 <> 13 THEN round(list_sum(pix) / 64.0::DOUBLE, 6) END AS mean_gray
FROM s WHERE id % 97 <> 12""",
    "annotation_candidates": _FINAL + """
SELECT row_idx, sample_id FROM f WHERE status = 'accepted' ORDER BY row_idx LIMIT 10""",
    "micro_batches": _FINAL + """, k AS (
  SELECT row_idx, (row_number() OVER (ORDER BY row_idx) - 1) // 4 AS batch_id FROM f WHERE status = 'accepted')
SELECT batch_id, count(*) AS rows, min(row_idx) AS first_row, max(row_idx) AS last_row FROM k GROUP BY batch_id""",
    "annotate_batch": _ANNOTATIONS + " SELECT * FROM ann",
    "annotation_counts": _ANNOTATIONS + """
SELECT count_if(status = 'success')::BIGINT AS success, count_if(status = 'failed')::BIGINT AS failed FROM ann""",
    "annotations_sink": _ANNOTATIONS + " SELECT * EXCLUDE (row_idx) FROM ann",
    "caption_first": _SAMPLES + ", todo AS (SELECT * FROM s ORDER BY row_idx LIMIT 5)," + _CAPTION_BATCHES
    + " SELECT * FROM ann",
    "stream_annotate": """
WITH k AS (SELECT conv_id * 1000 + turn AS key, text FROM conversations),
t AS (
  SELECT CASE WHEN key % 5 <> 2 THEN 'r' || key ELSE 'online_sample' END AS sample_id,
    CASE WHEN key % 7 NOT IN (3, 4) AND text <> '' THEN text END AS image_path, hex(encode(text)) AS h
  FROM k),
u AS (
  SELECT sample_id, image_path, length(h) // 2 AS size,
    list_sum(list_transform(range(length(h) // 2), lambda i:
      16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)) AS total
  FROM t)
SELECT sample_id, image_path,
  CASE WHEN image_path IS NULL THEN NULL WHEN total % 50 = 7 THEN '' ELSE size || ' bytes, sum ' || total END AS caption,
  CASE WHEN image_path IS NOT NULL THEN 'Salesforce/blip-image-captioning-base' END AS model_name,
  CASE WHEN image_path IS NULL OR total % 50 = 7 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN image_path IS NULL THEN 'image_path is required' WHEN total % 50 = 7 THEN 'captioner failed' END AS error
FROM u""",
    "stream_quality": _CHAIN + f" SELECT {_VERDICT}, rejected_by FROM c",
}
ORACLE_SQL["image_source"] = ORACLE_SQL["blur_score"]
ORACLE_SQL["zipped_regions"] = ORACLE_SQL["region_source"]
ORACLE_SQL["observed_metrics"] = ORACLE_SQL["operator_metrics"]
ORACLE_SQL["stored_metrics"] = ORACLE_SQL["all_metrics"]
ORACLE_SQL["stream_images"] = ORACLE_SQL["listed_images"]
