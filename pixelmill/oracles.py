"""DuckDB SQL for the queries of pixelmill.queries."""

from __future__ import annotations

from pixelmill.functions.labels import FIELDS, HEADLESS, VOCABULARY
from pixelmill.views import ANSWERS, SUFFIXES


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v) + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v) + "'" for v in values) + ")"


NAME = f"'doc_' || doc_id || {_list(SUFFIXES)}[doc_id % 9 + 1]"
SAMPLES = f"""samples AS (
  SELECT doc_id, n_chars, CASE WHEN doc_id % 5 = 0 THEN {NAME} ELSE source || '/' || lang || '/' || {NAME} END AS sample_id,
    octet_length(encode(text)) AS length,
    CASE WHEN doc_id % 97 = 0 THEN 0 ELSE 64 + (n_chars * 7) % 449 END AS width, 64 + (doc_id * 31) % 449 AS height
  FROM documents),
images AS (SELECT *, lower(regexp_extract(sample_id, '\\.[^.]+$')) AS suffix FROM samples
  WHERE lower(regexp_extract(sample_id, '\\.[^.]+$')) IN ('.jpg', '.jpeg', '.png', '.webp', '.bmp', '.tif', '.tiff'))"""

RATIO = "greatest(width::DOUBLE / height, height::DOUBLE / width)"
ASPECT = f"""aspect AS (SELECT *, CASE WHEN width <= 0 OR height <= 0 THEN 'ERROR' WHEN {RATIO} > 2.0 THEN 'REJECT' ELSE 'PASS' END AS d1 FROM images)"""
SHARE = "length::DOUBLE / greatest(width * height * 3, 1)"
TWO = f"""{SAMPLES}, {ASPECT},
two AS (SELECT *, CASE WHEN d1 = 'PASS' THEN CASE WHEN {SHARE} < 0.01 THEN 'REJECT' ELSE 'PASS' END END AS d2 FROM aspect),
state AS (SELECT *,
  CASE WHEN d1 <> 'PASS' THEN d1 WHEN d2 = 'REJECT' THEN 'REJECT' ELSE 'PENDING' END AS status,
  CASE WHEN d1 <> 'PASS' THEN 'aspect_ratio' WHEN d2 = 'REJECT' THEN 'compression_quality' END AS rejected_by,
  CASE WHEN d1 = 'ERROR' THEN 'invalid_image_size' WHEN d1 = 'REJECT' THEN 'aspect_ratio_exceeds_threshold' WHEN d2 = 'REJECT' THEN 'compression_ratio_below_threshold' END AS reject_reason,
  CASE WHEN d2 IS NULL THEN 1 ELSE 2 END AS n_trace FROM two)"""

FOLDED = """bytes AS (SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n FROM documents WHERE octet_length(encode(text)) > 0),
places AS (SELECT doc_id, h, n, unnest(range(0, (768 * ceil(n / 768.0))::BIGINT)) AS p FROM bytes),
folded AS (SELECT doc_id, p % 768 AS k, sum(16 * (strpos('0123456789ABCDEF', substr(h, 2 * (p % n) + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(h, 2 * (p % n) + 2, 1)) - 1) % 256 AS v
  FROM places GROUP BY doc_id, p % 768),
plain AS (SELECT doc_id, k // 48 AS y, (k // 3) % 16 AS x, max(v) FILTER (k % 3 = 0) AS r, max(v) FILTER (k % 3 = 1) AS g, max(v) FILTER (k % 3 = 2) AS b FROM folded GROUP BY ALL)"""
PLANT = """CASE doc_id % 7 WHEN 1 THEN 120
  WHEN 2 THEN CASE WHEN y < 3 OR y >= 13 OR x < 3 THEN 20 ELSE {c} END WHEN 3 THEN CASE WHEN y < 6 THEN 20 ELSE {c} END
  WHEN 4 THEN CASE WHEN y < 3 OR y >= 13 THEN 20 ELSE {c} END WHEN 5 THEN CASE WHEN x < 8 THEN 10 ELSE 240 END
  WHEN 6 THEN CASE WHEN y < 8 THEN 10 ELSE 240 END ELSE {c} END"""


def _channel(c: str) -> str:
    return PLANT.format(c=f"(CASE WHEN doc_id % 5 = 0 THEN r ELSE {c} END)")


RASTER = f"""{SAMPLES}, {FOLDED},
raster AS (SELECT sample_id, doc_id, y, x, {_channel('r')} AS r, {_channel('g')} AS g, {_channel('b')} AS b FROM plain JOIN images USING (doc_id)),
gray AS (SELECT sample_id, doc_id, y, x, ((r * 9798 + g * 19235 + b * 3735 + 16384)::BIGINT >> 15) AS v FROM raster)"""
GRAY_STYLE = """spread AS (SELECT sample_id, max(greatest(abs(r - g), abs(g - b), abs(r - b)))::DOUBLE AS d FROM raster GROUP BY 1)"""


def _side(name: str, line: str, along: str) -> str:
    """Thickness of one side: line is the distance from that side."""
    return f"""{name}_bg AS (SELECT sample_id, median(v) AS bg FROM gray WHERE {line} = 0 GROUP BY 1),
{name} AS (SELECT sample_id, coalesce(min(line) FILTER (share < 0.95), 16) AS t FROM (
  SELECT gray.sample_id, {line} AS line, avg(CASE WHEN abs(v - bg) < 15 THEN 1.0 ELSE 0.0 END) AS share FROM gray JOIN {name}_bg USING (sample_id) GROUP BY 1, 2) GROUP BY 1)"""


FRAME = f"""{_side('top_', 'y', 'x')}, {_side('bottom_', '15 - y', 'x')}, {_side('left_', 'x', 'y')}, {_side('right_', '15 - x', 'y')},
stds AS (SELECT sample_id, stddev_pop(v) AS std FROM gray GROUP BY 1),
thick AS (SELECT s.sample_id, std, a.t AS top, b.t AS bottom, c.t AS "left", d.t AS "right" FROM stds s JOIN top_ a USING (sample_id) JOIN bottom_ b USING (sample_id) JOIN left_ c USING (sample_id) JOIN right_ d USING (sample_id)),
framed AS (SELECT *, CASE WHEN std < 15 THEN 'PASS' WHEN greatest(top, bottom, "left", "right") > 16 * 0.3 THEN 'PASS'
  WHEN (top > 2)::INT + (bottom > 2)::INT + ("left" > 2)::INT + ("right" > 2)::INT >= 3 THEN 'REJECT' ELSE 'PASS' END AS decision FROM thick)"""

AT = "l[(CASE {y} WHEN -1 THEN 1 WHEN 16 THEN 14 ELSE {y} END) * 16 + (CASE {x} WHEN -1 THEN 1 WHEN 16 THEN 14 ELSE {x} END) + 1]"


def _at(dy: int, dx: int) -> str:
    return AT.format(y=f"(y + {dy})", x=f"(x + {dx})")


GX = f"abs({_at(-1, 1)} - {_at(-1, -1)} + 2 * ({_at(0, 1)} - {_at(0, -1)}) + {_at(1, 1)} - {_at(1, -1)})"
GY = f"abs({_at(1, -1)} - {_at(-1, -1)} + 2 * ({_at(1, 0)} - {_at(-1, 0)}) + {_at(1, 1)} - {_at(-1, 1)})"
PEAKS = f"""lists AS (SELECT sample_id, list(v ORDER BY y, x) AS l FROM gray GROUP BY 1),
gradients AS (SELECT sample_id, y, x, {GX} AS gx, {GY} AS gy FROM gray JOIN lists USING (sample_id)),
lines AS (SELECT sample_id, 'vertical' AS axis, x AS spot, sum(gx)::DOUBLE AS p FROM gradients GROUP BY ALL UNION ALL SELECT sample_id, 'horizontal', y, sum(gy)::DOUBLE FROM gradients GROUP BY ALL),
means AS (SELECT sample_id, axis, avg(p) AS mean FROM lines GROUP BY ALL),
peaks AS (SELECT sample_id, axis, CASE WHEN mean > 0 THEN spot END AS position, CASE WHEN mean > 0 THEN p / mean END AS prominence FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id, axis ORDER BY p DESC, spot) AS n FROM lines JOIN means USING (sample_id, axis) WHERE spot >= 3 AND spot < 12) WHERE n = 1)"""

LAPLACE = f"({_at(-1, 0)} + {_at(1, 0)} + {_at(0, -1)} + {_at(0, 1)} - 4 * {_at(0, 0)})"

BLOCKS = f"""{SAMPLES}, {FOLDED},
blocks AS (SELECT sample_id, doc_id, (y // 2) * 8 + x // 2 AS k, sum(r + g + b) AS s FROM plain JOIN images USING (doc_id) GROUP BY ALL),
middles AS (SELECT sample_id, median(s) AS m FROM blocks GROUP BY 1),
bits AS (SELECT sample_id, k, s > m AS bit FROM blocks JOIN middles USING (sample_id)),
hashes AS (SELECT sample_id, sum(CASE WHEN bit THEN (1::HUGEINT << (63 - k)::INT) ELSE 0 END)::UBIGINT AS h, string_agg(CASE WHEN bit THEN '1' ELSE '0' END, '' ORDER BY k) AS bits FROM bits GROUP BY 1)"""


def _fold(active: str) -> str:
    """The greedy fold over the active samples, as events of a recursive query."""
    return f"""items AS (SELECT row_number() OVER (ORDER BY string_split(sample_id, '/')) AS rn, sample_id AS id, ('/data/in/' || sample_id) AS path,
  (length + (doc_id * 13) % 5)::BIGINT AS size, h FROM images JOIN hashes USING (sample_id) WHERE {active}),
fold AS (
  SELECT 0::BIGINT AS rn, []::STRUCT(id VARCHAR, path VARCHAR, size BIGINT, h UBIGINT)[] AS kept, NULL::VARCHAR AS dup, NULL::VARCHAR AS keeper, NULL::BIGINT AS distance
  UNION ALL
  SELECT rn, CASE WHEN m IS NULL THEN list_append(kept, cur) WHEN swap THEN list_append(list_filter(kept, lambda x: x.id <> m.id), cur) ELSE kept END,
    CASE WHEN m IS NULL THEN NULL WHEN swap THEN m.id ELSE cur.id END, CASE WHEN m IS NULL THEN NULL WHEN swap THEN cur.id ELSE m.id END,
    CASE WHEN m IS NULL THEN NULL ELSE bit_count(xor(m.h, cur.h))::BIGINT END
  FROM (SELECT *, m IS NOT NULL AND (cur.size > m.size OR (cur.size = m.size AND cur.path < m.path)) AS swap FROM (
    SELECT i.rn, f.kept, {{'id': i.id, 'path': i.path, 'size': i.size, 'h': i.h}} AS cur, list_filter(f.kept, lambda x: bit_count(xor(x.h, i.h)) <= 9)[1] AS m
    FROM fold f JOIN items i ON i.rn = f.rn + 1))),
decisions AS (SELECT id AS sample_id, CASE WHEN dup IS NULL THEN 'PASS' ELSE 'REJECT' END AS decision, keeper, distance FROM items LEFT JOIN (SELECT dup, keeper, distance FROM fold WHERE dup IS NOT NULL) ON dup = id)"""


def _answer() -> str:
    fields = [f"'\"{f}\": \"' || {_list(v)}[((doc_id + quality) // {step}) % {len(v)} + 1] || '\"'" for f, (step, v) in ANSWERS.items()]
    every = "[" + ", ".join(fields) + "]"
    return f"""CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN NULL ELSE '{{' || array_to_string(CASE WHEN (doc_id + quality) % 6 = 0 THEN ({every})[1:9] ELSE {every} END, ', ') || '}}' END"""


def _label(f: str) -> str:
    value = f"json_extract_string(j, '$.{f}')"
    if f in VOCABULARY:
        return f"CASE WHEN trim({value}) IN {_in(VOCABULARY[f])} THEN trim({value}) ELSE 'N/A' END"
    return f"CASE WHEN {value} IS NULL OR trim({value}) IN ('', 'N/A') THEN 'N/A' ELSE regexp_extract({value}, '\\S+') END"


def _final(f: str) -> str:
    if f == "person_count":
        return f"c_{f}"
    value = f"c_{f}"
    if f in HEADLESS:
        value = f"CASE WHEN c_head_visible = 'no' THEN 'N/A' ELSE {value} END"
    if f == "hair_visible":
        value = f"CASE WHEN c_head_visible = 'no' THEN 'no' ELSE {value} END"
    if f == "hair_color":
        value = f"CASE WHEN c_head_visible = 'no' OR c_hair_visible = 'no' THEN 'N/A' ELSE {value} END"
    return f"CASE WHEN c_person_count = '1' THEN {value} ELSE 'N/A' END"


ANNOTATED = f"""answers AS (SELECT doc_id, quality, ({_answer()}) AS j FROM labels),
chosen AS (SELECT doc_id, j, {', '.join(f'{_label(f)} AS c_{f}' for f in FIELDS)} FROM answers),
annotated AS (SELECT doc_id, 'doc_' || doc_id || '.png' AS file_name, {', '.join(f'{_final(f)} AS {f}' for f in FIELDS)} FROM chosen WHERE j IS NOT NULL)"""

CLOSED = f"""{TWO},
placed AS (SELECT *, CASE WHEN status = 'PENDING' THEN '/data/out/doc_' || (doc_id % 100) END AS path FROM state),
numbered AS (SELECT *, row_number() OVER (PARTITION BY path, CASE WHEN status <> 'PENDING' THEN sample_id END ORDER BY string_split(sample_id, '/')) AS n FROM placed),
closed AS (SELECT sample_id, '/data/in/' || sample_id AS source_path, sample_id AS relative_path, d1, d2,
  CASE WHEN status = 'PENDING' AND n = 1 THEN path END AS archive_path,
  CASE WHEN status = 'PENDING' THEN CASE WHEN n = 1 THEN 'PASS' ELSE 'ERROR' END ELSE status END AS status,
  CASE WHEN status = 'PENDING' AND n > 1 THEN 'archive' ELSE rejected_by END AS rejected_by,
  CASE WHEN status = 'PENDING' AND n > 1 THEN 'archive_copy_failed: FileExistsError(''Archive path already exists: ' || path || ''')' ELSE reject_reason END AS reject_reason FROM numbered)"""

ORACLES = {
    "scan_extension_filter": f"WITH {SAMPLES} SELECT sample_id, suffix, length FROM images",
    "scan_nonrecursive": f"WITH {SAMPLES} SELECT sample_id FROM images WHERE NOT contains(sample_id, '/')",
    "path_component_order": f"WITH {SAMPLES} SELECT sample_id, row_number() OVER (ORDER BY string_split(sample_id, '/')) AS position FROM samples",
    "aspect_ratio": f"""WITH {SAMPLES}, {ASPECT} SELECT sample_id, d1 AS decision, CASE d1 WHEN 'ERROR' THEN 'invalid_image_size' WHEN 'REJECT' THEN 'aspect_ratio_exceeds_threshold' END AS reason,
  width, height, CASE WHEN d1 <> 'ERROR' THEN round({RATIO}, 6) END AS ratio FROM aspect""",
    "compression_quality": f"""WITH {SAMPLES} SELECT sample_id, CASE WHEN {SHARE} < 0.01 THEN 'REJECT' ELSE 'PASS' END AS decision,
  CASE WHEN {SHARE} < 0.01 THEN 'compression_ratio_below_threshold' END AS reason, greatest(width * height * 3, 1) AS theoretical_size, round({SHARE}, 9) AS compression_ratio FROM images""",
    "operator_error_path": f"WITH {TWO} SELECT sample_id, rejected_by, reject_reason, n_trace FROM state WHERE status = 'ERROR'",
    "gray_style": f"WITH {RASTER}, {GRAY_STYLE} SELECT sample_id, CASE WHEN d < 1 THEN 'REJECT' ELSE 'PASS' END AS decision, CASE WHEN d < 1 THEN 'grayscale_image' END AS reason, d AS max_channel_diff FROM spread",
    "image_std": f"WITH {RASTER} SELECT sample_id, round(stddev_pop(v), 6) AS std FROM gray GROUP BY 1",
    "framebox_thickness": f"WITH {RASTER}, {FRAME} SELECT sample_id, top, bottom, \"left\", \"right\" FROM framed WHERE std >= 15",
    "framebox": f"WITH {RASTER}, {FRAME} SELECT sample_id, decision, CASE WHEN decision = 'REJECT' THEN 'bordered_content' END AS reason FROM framed",
    "stitch_projection": f"WITH {RASTER}, {PEAKS} SELECT sample_id, axis, position, round(prominence, 6) AS prominence FROM peaks",
    "stitch": f"""WITH {RASTER}, {PEAKS}, sides AS (SELECT sample_id, max(prominence) FILTER (axis = 'vertical') AS v, max(prominence) FILTER (axis = 'horizontal') AS h FROM peaks GROUP BY 1)
SELECT sample_id, CASE WHEN coalesce(v, 0) >= 3 OR coalesce(h, 0) >= 3 THEN 'REJECT' ELSE 'PASS' END AS decision,
  CASE WHEN coalesce(v, 0) >= 3 THEN 'stitch_line_vertical' WHEN coalesce(h, 0) >= 3 THEN 'stitch_line_horizontal' END AS reason FROM sides""",
    "laplacian_score": f"WITH {RASTER}, lists AS (SELECT sample_id, list(v ORDER BY y, x) AS l FROM gray GROUP BY 1) SELECT sample_id, round(var_pop({LAPLACE}), 4) AS score FROM gray JOIN lists USING (sample_id) GROUP BY 1",
    "person_blur": f"""WITH {RASTER},
boxes(kind, box, x1, y1, x2, y2) AS (VALUES (2, 1, 0, 0, 47, 47), (3, 1, 0, 0, 43, 43), (3, 2, 4, 4, 48, 48)),
wide AS (SELECT sample_id, doc_id, unnest(range(48)) AS wy, v, x, y FROM gray),
big AS (SELECT sample_id, doc_id, list(v ORDER BY wy, wx) AS l FROM (SELECT sample_id, doc_id, v, y * 3 + a AS wy, x * 3 + b AS wx FROM gray, range(3) s(a), range(3) t(b)) GROUP BY ALL),
cells AS (SELECT sample_id, box, l, x1, y1, x2, y2, unnest(range(y1, y2)) AS y FROM big JOIN boxes ON kind = doc_id % 4),
grid AS (SELECT *, unnest(range(x1, x2)) AS x FROM cells),
laplace AS (SELECT sample_id, box, l[(CASE WHEN y = y1 THEN y + 1 ELSE y - 1 END) * 48 + x + 1] + l[(CASE WHEN y = y2 - 1 THEN y - 1 ELSE y + 1 END) * 48 + x + 1]
  + l[y * 48 + (CASE WHEN x = x1 THEN x + 1 ELSE x - 1 END) + 1] + l[y * 48 + (CASE WHEN x = x2 - 1 THEN x - 1 ELSE x + 1 END) + 1] - 4 * l[y * 48 + x + 1] AS v FROM grid),
scores AS (SELECT sample_id, min(s) AS score FROM (SELECT sample_id, box, var_pop(v) AS s FROM laplace GROUP BY ALL) GROUP BY 1)
SELECT i.sample_id, CASE WHEN score < 8000 THEN 'REJECT' ELSE 'PASS' END AS decision, CASE WHEN score < 8000 THEN 'blur_score_below_threshold' END AS reason,
  CASE WHEN doc_id % 4 = 0 THEN 'none' ELSE 'face' END AS used, round(score, 4) AS score FROM (SELECT DISTINCT sample_id, doc_id FROM gray) i LEFT JOIN scores USING (sample_id)""",
    "block_hash": f"WITH {BLOCKS} SELECT sample_id, bits FROM hashes",
    "hamming_pairs": """WITH signs AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE > list_median(list_transform(embedding, lambda y: y::DOUBLE))) AS l FROM embeddings WHERE embedding IS NOT NULL),
classes AS (SELECT l, min(vec_id) AS id FROM signs GROUP BY l),
pairs AS (SELECT a.id AS vec_a, b.id AS vec_b, list_sum(list_transform(range(1, len(a.l) + 1), lambda i: (a.l[i] <> b.l[i])::INT))::BIGINT AS distance FROM classes a JOIN classes b ON a.id < b.id)
SELECT vec_a, vec_b, distance FROM pairs WHERE distance <= 16""",
    "duplicate_decisions": f"WITH RECURSIVE {BLOCKS}, {_fold('true')} SELECT sample_id, decision, keeper, distance FROM decisions",
    "duplicate_summary": f"WITH RECURSIVE {BLOCKS}, {_fold('true')} SELECT decision, count(*) AS n FROM decisions GROUP BY 1",
    "chain_two_ops": f"WITH {TWO} SELECT sample_id, status, rejected_by, reject_reason, n_trace FROM state",
    "short_circuit_counts": f"""WITH {RASTER}, {ASPECT}, {GRAY_STYLE}, {FRAME},
one AS (SELECT sample_id, d1, CASE WHEN d1 = 'PASS' THEN CASE WHEN d < 1 THEN 'REJECT' ELSE 'PASS' END END AS d2, decision FROM aspect JOIN spread USING (sample_id) JOIN framed USING (sample_id)),
every AS (SELECT 'aspect_ratio' AS operator, d1 AS d FROM one UNION ALL SELECT 'gray_style', d2 FROM one WHERE d2 IS NOT NULL UNION ALL SELECT 'framebox', decision FROM one WHERE d2 = 'PASS')
SELECT operator, count(*) AS seen, count(*) FILTER (d = 'REJECT') AS rejected, count(*) FILTER (d = 'ERROR') AS errors FROM every GROUP BY 1""",
    "batch_default_pass": f"""WITH {SAMPLES}, {ASPECT} SELECT sample_id, CASE WHEN d1 <> 'PASS' THEN d1 WHEN doc_id % 3 = 0 THEN 'REJECT' ELSE 'PENDING' END AS status,
  CASE WHEN d1 <> 'PASS' THEN d1 WHEN doc_id % 3 = 0 THEN 'REJECT' ELSE 'PASS' END AS decision, CASE WHEN d1 <> 'PASS' THEN 1 ELSE 2 END AS n_trace FROM aspect""",
    "archive_path_run_subdir": f"WITH {SAMPLES} SELECT sample_id, '/data/out/run1/' || sample_id AS archive_path FROM images",
    "archive_path_flat": f"WITH {SAMPLES} SELECT sample_id, '/data/out/' || string_split(sample_id, '/')[-1] AS archive_path FROM images",
    "archive_path_preserve": f"WITH {SAMPLES} SELECT sample_id, '/data/out/' || sample_id AS archive_path FROM images",
    "archive_conflicts": f"WITH {CLOSED} SELECT sample_id, status, rejected_by, archive_path FROM closed",
    "archive_overwrite": f"""WITH {CLOSED} SELECT sample_id, path AS archive_path, row_number() OVER (PARTITION BY path ORDER BY string_split(sample_id, '/') DESC) = 1 AS copies FROM placed WHERE status = 'PENDING'""",
    "manifest_rows": f"""WITH {CLOSED} SELECT sample_id, source_path, relative_path, archive_path, status, rejected_by, reject_reason,
  'aspect_ratio:' || d1 || CASE WHEN d2 IS NOT NULL THEN ',compression_quality:' || d2 ELSE '' END AS operator_trace FROM closed""",
    "run_summary": f"WITH {CLOSED} SELECT count(*) AS input_total, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'REJECT') AS rejected, count(*) FILTER (status = 'ERROR') AS errors FROM closed",
    "reject_by_operator": f"WITH {CLOSED} SELECT rejected_by AS operator, count(*) AS n FROM closed WHERE status = 'REJECT' GROUP BY 1",
    "label_parse_json": f"WITH {ANNOTATED} SELECT doc_id, j IS NOT NULL AS parsed, json_extract_string(j, '$.person_count') AS person_count FROM answers",
    "label_choice": f"WITH {ANNOTATED} SELECT doc_id, {', '.join(f'c_{f} AS {f}' for f in ('person_count', 'head_visible', 'gender', 'holding_object'))} FROM chosen WHERE j IS NOT NULL",
    "label_one_word": f"WITH {ANNOTATED} SELECT doc_id, c_expression AS expression, c_hair_color AS hair_color FROM chosen WHERE j IS NOT NULL",
    "label_normalize": f"WITH {ANNOTATED} SELECT * FROM annotated",
    "label_head_not_visible": f"WITH {ANNOTATED} SELECT doc_id, {', '.join(HEADLESS)}, hair_visible, gender FROM annotated WHERE person_count = '1' AND head_visible = 'no'",
    "label_multi_person": f"WITH {ANNOTATED} SELECT doc_id, person_count, 'N/A' AS rest FROM annotated WHERE person_count <> '1'",
    "label_summary": f"WITH {ANNOTATED} SELECT count(*) AS input_total, count(j) AS labeled, count(*) - count(j) AS failed FROM answers",
    "vocabulary_audit": f"WITH {ANNOTATED}, pairs AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value FROM annotated" for f in FIELDS) + ") SELECT field, value, count(*) AS n FROM pairs GROUP BY ALL",
    "label_resize_dims": f"""WITH {SAMPLES}, s AS (SELECT *, sqrt(50000.0::DOUBLE / (width * height)) AS scale FROM images WHERE width > 0)
SELECT sample_id, CASE WHEN width * height > 50000 THEN greatest(1, floor(width * scale)) ELSE width END::BIGINT AS width, CASE WHEN width * height > 50000 THEN greatest(1, floor(height * scale)) ELSE height END::BIGINT AS height FROM s""",
    "downscale_dims": f"""WITH {SAMPLES}, s AS (SELECT *, least(1.0::DOUBLE, 256.0::DOUBLE / greatest(width, height)) AS scale FROM images WHERE width > 0)
SELECT sample_id, CASE WHEN scale < 1 THEN round_even(width * scale, 0) ELSE width END::BIGINT AS width, CASE WHEN scale < 1 THEN round_even(height * scale, 0) ELSE height END::BIGINT AS height FROM s""",
    "annotation_stem_collisions": f"WITH {SAMPLES} SELECT 'img' || (doc_id % 50) || '.x' AS stem, count(*) AS n, arg_max(sample_id, string_split(sample_id, '/')) AS last_sample FROM images GROUP BY 1",
    "data_url": """WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), n AS (SELECT *, octet_length(encode(t)) AS n FROM t)
SELECT doc_id, 'data:image/png;base64' AS head, md5(t || repeat(' ', CASE WHEN n = 0 THEN 3 ELSE ((3 - n % 3) % 3)::INT END)) AS pixels_md5 FROM n""",
    "config_operator_order": "SELECT * FROM (VALUES (0::BIGINT, 'aspect_ratio'), (1::BIGINT, 'framebox'), (2::BIGINT, 'duplicate')) t(position, operator)",
}
ORACLES["chain_full"] = f"""WITH RECURSIVE {RASTER}, {ASPECT}, {GRAY_STYLE}, {FRAME},
{BLOCKS.split(FOLDED + ",", 1)[1].replace("FROM plain JOIN images", "FROM raster JOIN images").replace("SELECT sample_id, doc_id, (y", "SELECT images.sample_id, images.doc_id, (y").replace("GROUP BY ALL),\nmiddles", "GROUP BY ALL),\nmiddles", 1)},
base AS (SELECT sample_id, d1, d, decision FROM aspect JOIN spread USING (sample_id) JOIN framed USING (sample_id)),
active AS (SELECT sample_id FROM base WHERE d1 = 'PASS' AND d >= 1 AND decision = 'PASS'),
{_fold('sample_id IN (SELECT sample_id FROM active)')}
SELECT base.sample_id,
  CASE WHEN d1 <> 'PASS' THEN d1 WHEN d < 1 OR base.decision = 'REJECT' OR decisions.decision = 'REJECT' THEN 'REJECT' ELSE 'PENDING' END AS status,
  CASE WHEN d1 <> 'PASS' THEN 'aspect_ratio' WHEN d < 1 THEN 'gray_style' WHEN base.decision = 'REJECT' THEN 'framebox' WHEN decisions.decision = 'REJECT' THEN 'duplicate' END AS rejected_by,
  CASE WHEN d1 = 'ERROR' THEN 'invalid_image_size' WHEN d1 = 'REJECT' THEN 'aspect_ratio_exceeds_threshold' WHEN d < 1 THEN 'grayscale_image' WHEN base.decision = 'REJECT' THEN 'bordered_content' WHEN decisions.decision = 'REJECT' THEN 'duplicate_image' END AS reject_reason,
  'aspect_ratio:' || d1 || CASE WHEN d1 = 'PASS' THEN ',gray_style:' || CASE WHEN d < 1 THEN 'REJECT' ELSE 'PASS' END || CASE WHEN d >= 1 THEN ',framebox:' || base.decision || CASE WHEN base.decision = 'PASS' THEN ',duplicate:' || decisions.decision ELSE '' END ELSE '' END ELSE '' END AS trace
FROM base LEFT JOIN decisions USING (sample_id)"""
