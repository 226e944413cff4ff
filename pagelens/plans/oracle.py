"""SQL equivalents of the registered queries, for DuckDB, put together from common table expressions."""

from __future__ import annotations

from pagelens import constants as C
from pagelens.functions import prompts as P
from pagelens.functions import text as T


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def isin(values: list[str]) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


LATEST = "latest AS (SELECT * FROM page_records QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) = 1)"
PAGES = f"""{LATEST},
named AS (SELECT *, coalesce(nullif(file_name, ''), nullif(image.path, ''), split_part(image.src, '/', -1), '') AS raw_name FROM latest),
pages AS (
  SELECT page_id, CASE WHEN raw_name = '' OR starts_with(raw_name, 'images/') THEN raw_name ELSE 'images/' || split_part(raw_name, '/', -1) END AS file_name,
    split_part(raw_name, '/', -1) AS image_name,
    coalesce(nullif(image_width, 0), nullif(image.width, 0), 0)::INTEGER AS image_width, coalesce(nullif(image_height, 0), nullif(image.height, 0), 0)::INTEGER AS image_height,
    coalesce(source, '') AS source, split, annotation_source, raw_name <> '' AS has_image,
    CASE annotation_source WHEN 'annotator' THEN 1.0 WHEN 'volunteer' THEN 0.75 WHEN 'auto' THEN 0.35 ELSE 0.5 END::DOUBLE AS quality_weight,
    list_filter(coalesce(regions, []), lambda r: r IS NOT NULL) AS rs
  FROM named)"""
REGS = f"""{PAGES},
places AS (SELECT *, unnest(range(len(rs))) AS pos FROM pages),
regs AS (
  SELECT * EXCLUDE (rs), list_transform(coalesce(rs[pos + 1].bbox, []), lambda v: trunc(v)::INTEGER) AS b,
    coalesce(rs[pos + 1].type, '') AS type, coalesce(rs[pos + 1].text, '') AS text, coalesce(rs[pos + 1].language, 'uk') AS language,
    coalesce(rs[pos + 1].legibility, 'legible') AS legibility, rs[pos + 1].confidence AS confidence
  FROM places)"""
CLAMPED = f"""{REGS},
cut AS (
  SELECT *, CASE WHEN len(b) = 4 AND len(list_filter(b, lambda v: v IS NULL)) = 0 THEN greatest(0, least(image_width, b[1])) END AS x1, greatest(0, least(image_height, b[2])) AS y1,
    greatest(0, least(image_width, b[3])) AS x2, greatest(0, least(image_height, b[4])) AS y2
  FROM regs),
clean AS (
  SELECT * EXCLUDE (type, language, legibility), CASE WHEN type IN {isin(C.REGION_TYPES)} THEN type ELSE 'handwritten' END AS type,
    coalesce(nullif(language, ''), 'uk') AS language, coalesce(nullif(legibility, ''), 'legible') AS legibility,
    (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INTEGER AS idx,
    regexp_replace(image_name, '(.)[.][^.]+$', '\\1') AS stem, floor(floor((y1 + y2) / 2.0) / {C.READING_ORDER_ROW_BAND})::BIGINT AS band
  FROM cut WHERE x1 IS NOT NULL AND x2 > x1 AND y2 > y1)"""


def case(values: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.items()) + " END"


def region_prompt(source: str, kind: str) -> str:
    return f"concat_ws(' ', {q(P.REGION)}, {case(P.REGION_SOURCE_HINTS, source)}, {case(P.REGION_TYPE_HINTS, kind)})"


def strip(t: str) -> str:
    return rf"regexp_replace({t}, '^[\s\x0b\x1c-\x1f\x85\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g')".replace(r"\x85", r"\x{85}")


SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def normalized(t: str) -> str:
    """A scalar subquery chain would be long; this nests the steps as one expression."""
    e = f"coalesce({t}, '')"
    sub = lambda e, p, r: f"regexp_replace({e}, {q(p)}, {q(r)}, 'g')"
    e = sub(e, r"~~[^\n]*?~~\{([^\n]*?)\}", r"\1")
    e = sub(e, r"~~([^\n]*?)~~", r"\1")
    e = sub(e, r"\\xrightarrow(?:\[[^\]]*\])?\{[^{}]*\}", "→")
    e = sub(e, r"\\xleftarrow(?:\[[^\]]*\])?\{[^{}]*\}", "←")
    for c in T.WRAPPERS:
        for _ in range(3):  # the data nest a wrapper at most this deep
            e = sub(e, rf"\\{c}\s*\{{([^{{}}]*)\}}", r"\1")
    e = sub(e, r"\\(?:over|under)set\{[^{}]*\}\{([^{}]*)\}", r"\1")
    e = sub(e, rf"\\(?:{T.SIZES})\b", "")
    e = sub(e, r"\\(?:hline|cline\{[^{}]*\}|phantom\{[^{}]*\})", "")
    for a, b in T.SYMBOLS:
        e = f"replace({e}, {q(a)}, {q(b)})"
    e = sub(e, rf"\\({T.FUNCTIONS})\b", r"\1 ")
    e = sub(e, rf"([{T.LETTERS}0-9])_\{{([^{{}}]+)\}}", r"\1_\2")
    e = sub(e, rf"([{T.LETTERS}0-9])\^\{{([^{{}}]+)\}}", r"\1^\2")
    for digits, mark in ((T.SUPERSCRIPTS, "^"), (T.SUBSCRIPTS, "_")):
        e = f"regexp_replace({e}, {q(f'([{T.LETTERS}])([{digits}]+)')}, '\\1{mark}' || chr(1) || '\\2' || chr(2), 'g')"
        e = f"array_to_string(list_transform(string_split({e}, chr(1)), lambda s: CASE WHEN contains(s, chr(2)) THEN translate(split_part(s, chr(2), 1), {q(digits)}, '0123456789') || split_part(s, chr(2), 2) ELSE s END), '')"
    e = f"replace({e}, '''''', '''')"
    e = f"translate({e}, {q(T.FOLDED)}, {q(T.FOLD)})"
    return f"trim(regexp_replace({e}, {q(SPACES)}, ' ', 'g'))"


def distance(x: str, y: str) -> str:
    """Edit distance by code points: those of both texts become one byte each, others a byte that the other text lacks."""
    code = lambda t, other: f"array_to_string(list_transform(string_split({t}, ''), lambda z: chr(coalesce(list_position(k, z), {other}) + 2)), '')"
    both = f"list_intersect(list_distinct(string_split({x}, '')), list_distinct(string_split({y}, '')))"
    return f"list_transform([{both}], lambda k: CASE WHEN len(k) > 120 THEN error('too many letters') WHEN {x} = '' OR {y} = '' THEN greatest(length({x}), length({y})) ELSE levenshtein({code(x, -1)}, {code(y, 0)}) END)[1]"


# Truth and predictions of the score queries; idx is the place among regions with four coordinates.
SCORED = f"""{REGS},
truth AS (
  SELECT page_id, source, annotation_source, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INTEGER AS idx, b[1]::BIGINT AS x1, b[2]::BIGINT AS y1, b[3]::BIGINT AS x2, b[4]::BIGINT AS y2, type, text, language, legibility
  FROM regs WHERE len(b) = 4 AND len(list_filter(b, lambda v: v IS NULL)) = 0),
hashed AS (SELECT *, (page_id * 31 + idx * 17) % 10 AS h FROM truth WHERE page_id % 23 <> 0),
guesses AS (
  SELECT page_id, 2 * idx AS place, x1 + h % 4 AS x1, y1 + h % 3 AS y1, x2 + h % 4 AS x2, y2 + h % 3 AS y2, CASE WHEN h = 7 THEN 'printed' ELSE type END AS type, translate(text, 'ае', 'еа') AS text FROM hashed WHERE h <> 0
  UNION ALL
  SELECT page_id, 2 * idx + 1, x1 + 1, y1 + 1, x2 + 1, y2 + 1, type, text FROM hashed WHERE (page_id + idx) % 8 = 0),
pred AS (SELECT *, (row_number() OVER (PARTITION BY page_id ORDER BY place) - 1)::INTEGER AS idx FROM guesses)"""
PAIRS = f"""{SCORED},
boxes AS (
  SELECT p.page_id, p.idx AS pred_idx, t.idx AS truth_idx,
    greatest(0, least(p.x2, t.x2) - greatest(p.x1, t.x1)) * greatest(0, least(p.y2, t.y2) - greatest(p.y1, t.y1)) AS inter,
    greatest(0, p.x2 - p.x1) * greatest(0, p.y2 - p.y1) + greatest(0, t.x2 - t.x1) * greatest(0, t.y2 - t.y1) AS areas
  FROM pred p JOIN truth t USING (page_id)),
pairs AS (SELECT page_id, pred_idx, truth_idx, inter::DOUBLE / (areas - inter)::DOUBLE AS iou FROM boxes WHERE inter > 0 AND inter::DOUBLE / (areas - inter)::DOUBLE >= {C.DEFAULT_IOU})"""
MATCHED = f"""{PAIRS},
ranked AS (
  SELECT page_id, list([pred_idx, truth_idx] ORDER BY iou DESC, pred_idx DESC, truth_idx DESC) AS c FROM pairs GROUP BY page_id),
folded AS (
  SELECT page_id, list_reduce(list_transform(c, lambda x: [x]), lambda acc, x: CASE WHEN len(list_filter(acc, lambda m: m[1] = x[1][1] OR m[2] = x[1][2])) > 0 THEN acc ELSE list_concat(acc, x) END) AS m FROM ranked),
matched AS (SELECT page_id, unnest(m) AS m FROM folded),
matches AS (SELECT page_id, m[1] AS pred_idx, m[2] AS truth_idx FROM matched)"""


def counters(norm) -> str:  # noqa: ANN001
    """Counters of each page; ``norm`` gives the SQL of a text's compared form."""
    scorable = f"t.language = 'uk' AND t.legibility = 'legible' AND t.type NOT IN {isin(C.EMPTY_TEXT_TYPES)}"
    return f"""{MATCHED},
tn AS (SELECT *, {norm('text')} AS n FROM truth), pn AS (SELECT *, {norm('text')} AS n FROM pred),
per_match AS (
  SELECT m.page_id, (p.type = t.type)::INT AS class_ok, CASE WHEN {scorable} THEN {distance('p.n', 't.n')}::DOUBLE / greatest(1, length(t.n)) END AS cer
  FROM matches m JOIN pn p ON p.page_id = m.page_id AND p.idx = m.pred_idx JOIN tn t ON t.page_id = m.page_id AND t.idx = m.truth_idx),
mc AS (SELECT page_id, count(*) AS tp, sum(class_ok) AS class_ok, sum(cer) AS cer_sum, count(cer) AS cer_n FROM per_match GROUP BY page_id),
tc AS (SELECT page_id, count(*) AS n, string_agg(CASE WHEN {scorable} AND t.n <> '' THEN t.n END, ' ' ORDER BY floor(floor((y1 + y2) / 2.0) / {C.READING_ORDER_ROW_BAND}), x1, idx) AS page_text FROM tn t GROUP BY page_id),
pc AS (SELECT page_id, count(*) AS n, string_agg(CASE WHEN type NOT IN {isin(C.EMPTY_TEXT_TYPES)} AND n <> '' THEN n END, ' ' ORDER BY floor(floor((y1 + y2) / 2.0) / {C.READING_ORDER_ROW_BAND}), x1, idx) AS page_text FROM pn GROUP BY page_id),
per_text AS (
  SELECT g.*, mc.* EXCLUDE (page_id), pc.n AS pn_, tc.n AS tn_, coalesce(pc.page_text, '') AS pt, coalesce(tc.page_text, '') AS tt
  FROM pages g LEFT JOIN mc USING (page_id) LEFT JOIN tc USING (page_id) LEFT JOIN pc USING (page_id)),
per_page AS (SELECT *, {distance('pt', 'tt')}::DOUBLE / greatest(1, length(tt)) AS page_cer FROM per_text),
counters AS (
  SELECT g.page_id, g.source, g.annotation_source, coalesce(tp, 0) AS tp, coalesce(pn_, 0) - coalesce(tp, 0) AS fp, coalesce(tn_, 0) - coalesce(tp, 0) AS fn,
    coalesce(class_ok, 0) AS class_ok, coalesce(cer_sum, 0) AS cer_sum, coalesce(cer_n, 0) AS cer_n,
    page_cer
  FROM per_page g)"""


SCORES = f"""count(*) AS pages, sum(tp)::DOUBLE AS tp_, sum(tp)::DOUBLE / greatest(1, sum(tp) + sum(fp)) AS precision_, sum(tp)::DOUBLE / greatest(1, sum(tp) + sum(fn)) AS recall_,
  sum(class_ok)::DOUBLE / greatest(1, sum(tp)) AS class_acc_, sum(cer_sum)::DOUBLE / greatest(1, sum(cer_n)) AS cer_, sum(page_cer) / greatest(1, count(*)) AS page_cer_"""
FINAL = """pages, tp_::BIGINT AS matched_regions, round(precision_, 6) AS precision, round(recall_, 6) AS recall, round(2 * precision_ * recall_ / greatest(1e-12, precision_ + recall_), 6) AS f1,
  round(class_acc_, 6) AS class_acc, round(cer_, 6) AS cer, round(page_cer_, 6) AS page_cer,
  round(0.15 * 2 * precision_ * recall_ / greatest(1e-12, precision_ + recall_) + 0.05 * class_acc_ + 0.30 * (1 - least(cer_, 1)) + 0.50 * (1 - least(page_cer_, 1)), 6) AS score,
  round(2 * precision_ * recall_ / greatest(1e-12, precision_ + recall_) * (1 - least(cer_, 1)), 6) AS proxy_score"""


def grouped(where: str = "true") -> str:
    key = lambda c: f"coalesce(nullif({c}, ''), 'unknown')"
    return f"""WITH {counters(normalized)},
keyed AS (SELECT * EXCLUDE (source, annotation_source), {key('source')} AS source, {key('annotation_source')} AS annotation_source FROM counters),
sums AS (
  SELECT 'overall' AS grouping, 'overall' AS key, {SCORES} FROM keyed
  UNION ALL SELECT 'source', source, {SCORES} FROM keyed GROUP BY source
  UNION ALL SELECT 'annotation_source', annotation_source, {SCORES} FROM keyed GROUP BY annotation_source)
SELECT grouping, key, {FINAL} FROM sums WHERE pages > 0 AND {where}"""


def split_sql(source_rows: str, key: str, fraction: float, seed: int, held: str, rest: str) -> str:
    return f"""{source_rows},
strata AS (SELECT DISTINCT {key}, coalesce(nullif(source, ''), 'unknown') AS source FROM rows_),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('{seed}:' || {key}::VARCHAR), {key}::VARCHAR) AS rn, count(*) OVER (PARTITION BY source) AS n FROM strata),
splits AS (SELECT {key}, source, CASE WHEN n > 1 AND rn <= greatest(1, round_even(n * {fraction}::DOUBLE, 0)) THEN '{held}' ELSE '{rest}' END AS split FROM numbered)"""


PLAIN_FILES = """files AS (
  SELECT DISTINCT export_id, trim(regexp_replace(regexp_replace(replace(coalesce(dir, ''), chr(92), '/'), '(^|/)([.](/|$))+', '/', 'g'), '/+', '/', 'g'), '/') AS dir, file_name
  FROM pack_files WHERE export_id IS NOT NULL AND file_name IS NOT NULL AND NOT regexp_matches(file_name, '^shard-.*[.]tar$'))"""
NEWEST = "newest AS (SELECT * FROM pack_manifest QUALIFY row_number() OVER (PARTITION BY export_id ORDER BY written_at DESC, version DESC) = 1)"
LINES = f"""{CLAMPED},
own AS (SELECT page_id, pos, band, x1, {strip('text')} AS line FROM clean WHERE type IN {isin(C.TRANSCRIBED_TYPES)} AND language = 'uk' AND legibility = 'legible')"""


# Regions of page_raw: lists are followed level by level; a list may be JSON text.
NESTED = """WITH RECURSIVE valid AS (
  SELECT page_id, payload::JSON AS p FROM page_raw WHERE page_id IS NOT NULL AND json_valid(payload)
  QUALIFY json_type(payload) = 'OBJECT' AND row_number() OVER (PARTITION BY page_id, json_type(payload) = 'OBJECT' ORDER BY received_at DESC, raw_id DESC) = 1),
tops AS (SELECT page_id, CASE WHEN json_type(p, '$.page') = 'OBJECT' THEN json_extract(p, '$.page.regions') ELSE json_extract(p, '$.regions') END AS r FROM valid),
read_ AS (SELECT page_id, CASE WHEN json_type(r) = 'VARCHAR' AND json_valid(r->>'$') THEN (r->>'$')::JSON ELSE r END AS r FROM tops),
found AS (
  SELECT page_id, i::VARCHAR AS region_path, o FROM (SELECT page_id, unnest(range(json_array_length(r)::BIGINT)) AS i, unnest(json_extract(r, '$[*]')) AS o FROM read_ WHERE json_type(r) = 'ARRAY') WHERE json_type(o) = 'OBJECT'
  UNION ALL
  SELECT page_id, region_path || '/' || i, o FROM (
    SELECT page_id, region_path, unnest(range(json_array_length(r)::BIGINT)) AS i, unnest(json_extract(r, '$[*]')) AS o FROM (SELECT page_id, region_path, json_extract(o, '$.regions') AS r FROM found) WHERE json_type(r) = 'ARRAY') WHERE json_type(o) = 'OBJECT')\n"""
# Pages with the object that holds their fields; a page's object lies under a key or is the whole payload.
NESTED_PAGES = NESTED.replace("tops AS", "owners AS (SELECT page_id, CASE WHEN json_type(p, '$.page') = 'OBJECT' THEN json_extract(p, '$.page') ELSE p END AS o FROM valid),\ntops AS").replace("SELECT page_id, payload::JSON AS p", "SELECT page_id, raw_id, payload::JSON AS p")


def fitted(side: str, other: str, most: int) -> str:
    near = lambda x: f"greatest(32, round_even({x} / 32.0::DOUBLE, 0) * 32)"
    area = f"{near(side)} * {near(other)}"
    return f"""(CASE WHEN {area} > {most} THEN greatest(32, floor({side} / sqrt({side}::DOUBLE * {other} / {most}.0::DOUBLE) / 32.0::DOUBLE) * 32)
      WHEN {area} < {most // 4} THEN ceil({side} * sqrt({most // 4}.0::DOUBLE / ({side}::DOUBLE * {other})) / 32.0::DOUBLE) * 32 ELSE {near(side)} END)::INTEGER"""


def field(o: str, name: str, kind: str = "") -> str:
    v = f"({o}->>'$.{name}')"
    return (f"TRY_CAST({v} AS {kind})" if kind else v) + f' AS "{name}"'


# Results of stand-in models that see a page's own regions.
INFERENCE = f"""WITH {CLAMPED}, bbox_ AS (SELECT *, '[' || x1 || ',' || y1 || ',' || x2 || ',' || y2 || ']' AS bbox FROM clean),
raw_ AS (SELECT b.page_id, b.pos, b.bbox, b.band, b.x1, c.type AS raw_type, b.type AS known_type, c.text AS text FROM bbox_ b JOIN cut c USING (page_id, pos)),
said AS (SELECT page_id, {strip('text')} AS line, pos FROM regs),
lines AS (SELECT page_id, line, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k, count(*) OVER (PARTITION BY page_id) AS n FROM said WHERE line <> ''),
bands AS (
  SELECT page_id, least(image_height - 1, (k - 1) * h) AS y1, greatest(CASE WHEN k = n THEN image_height ELSE least(image_height, least(image_height - 1, (k - 1) * h) + h) END, least(image_height - 1, (k - 1) * h) + 1) AS y2, image_width AS x2, image_height, line, k
  FROM (SELECT l.*, image_width, image_height, greatest(1, image_height // n) AS h FROM lines l JOIN pages USING (page_id))),
fit AS (SELECT page_id, greatest(0, y1) AS y1, greatest(0, least(image_height, y2)) AS y2, x2, line, k FROM bands),
found AS (
  SELECT 'detector-vlm' AS mode, page_id, bbox, band, x1, pos, raw_type AS type, text FROM raw_
  UNION ALL SELECT 'page-vlm', page_id, bbox, band, x1, pos, known_type, text FROM raw_
  UNION ALL SELECT 'page-text-vlm', page_id, '[0,' || y1 || ',' || x2 || ',' || y2 || ']', floor(floor((y1 + y2) / 2.0) / {C.READING_ORDER_ROW_BAND})::BIGINT, 0, k, 'handwritten', line FROM fit WHERE x2 > 0 AND y2 > y1),
results AS (SELECT mode, page_id, (row_number() OVER (PARTITION BY mode, page_id ORDER BY band, x1, pos) - 1)::INTEGER AS place, bbox, type, CASE WHEN type IN {isin(C.EMPTY_TEXT_TYPES)} THEN '' ELSE text END AS text FROM found)
"""


def oracle_sql() -> dict[str, str]:
    transcribed = f"type IN {isin(C.TRANSCRIBED_TYPES)}"
    region_id = "printf('%s:%s:%04d', split, stem, idx)"
    crop = f"CASE WHEN has_image AND {transcribed} THEN printf('crops/%s/%s_%04d.jpg', split, stem, idx) END"
    box = "'[' || x1 || ',' || y1 || ',' || x2 || ',' || y2 || ']'"
    page_where = "split IN ('train', 'silver') AND has_image"
    eight = lambda e: f"printf('%.8f', round_even(({e})::DECIMAL(38,20), 8))"
    number = "CASE type " + " ".join(f"WHEN {q(t)} THEN '{i}'" for i, t in enumerate(C.REGION_TYPES)) + " END"
    sft = f"""{CLAMPED}, sft AS (
      SELECT page_id, {region_id} AS id, {crop} AS image, type AS region_type, source, quality_weight, text AS answer FROM clean
      WHERE ({crop}) IS NOT NULL AND text <> '' AND legibility = 'legible')"""
    zipped = f"""{LINES.replace('own AS', 'lines0 AS')}, lines1 AS (
      SELECT page_id, line, row_number() OVER (PARTITION BY page_id ORDER BY band, x1, pos) AS k FROM lines0 WHERE line <> ''
      UNION ALL SELECT page_id, 'extra ' || e, 1000 + e FROM pages, range(1, 3) r(e) WHERE page_id % 3 >= e),
    lines AS (SELECT page_id, line, row_number() OVER (PARTITION BY page_id ORDER BY k) AS k, count(*) OVER (PARTITION BY page_id) AS n FROM lines1 WHERE page_id % 5 <> 0 OR k > 1)"""
    submission = f"""WITH {CLAMPED}, last_ AS (SELECT image_name, max(page_id) AS page_id FROM pages WHERE page_id % 7 <> 0 GROUP BY 1),
            js AS (SELECT page_id, '[' || string_agg('{{"bbox":' || {box} || ',"type":' || to_json(type)::VARCHAR || ',"text":' || to_json(text)::VARCHAR || '}}', ',' ORDER BY idx) || ']' AS regions FROM clean GROUP BY 1)
          SELECT p.page_id, p.image_name AS image, coalesce(js.regions, '[]') AS regions FROM pages p LEFT JOIN last_ l USING (image_name) LEFT JOIN js ON js.page_id = l.page_id WHERE p.split = 'test'"""
    yolo = f"""WITH {CLAMPED} SELECT page_id, string_agg({number} || ' ' || {eight("(x1 + x2) / 2.0::DOUBLE / image_width")} || ' ' || {eight("(y1 + y2) / 2.0::DOUBLE / image_height")} || ' ' || {eight("(x2 - x1)::DOUBLE / image_width")} || ' ' || {eight("(y2 - y1)::DOUBLE / image_height")}, chr(10) ORDER BY idx) AS label
          FROM clean WHERE split <> 'test' GROUP BY page_id"""
    detector = "WITH " + split_sql(f"{CLAMPED}, rows_ AS (SELECT DISTINCT file_name, source FROM clean WHERE split IN ('train', 'silver'))", "file_name", 0.15, 42, "val", "train")
    return {
        "scan_available": f"WITH {PAGES} SELECT file_name, image_name, image_width, image_height, source, split, len(rs) AS n_regions FROM pages WHERE split IN ('train', 'silver', 'test')",
        "scan_predictions": f"WITH {SCORED} SELECT t.page_id, count(p.page_id)::INTEGER AS n_regions, coalesce(sum(length(p.text)), 0)::INTEGER AS chars FROM (SELECT page_id FROM pages WHERE page_id % 23 <> 0) t LEFT JOIN pred p USING (page_id) GROUP BY 1",
        # The answers of the registered list, in order, read by hand.
        "model_outputs": """SELECT * FROM (VALUES
            (0, 1, true, NULL, 'а', '[0,0,10,10] printed а uk legible'),
            (1, 2, true, NULL, 'б]', '[0,0,10,10] handwritten б] uk legible|[5,5,100,20] handwritten  uk legible'),
            (2, 1, true, NULL, 'в', ''),
            (3, 1, true, 'salvaged_partial_array', 'г', '[1,2,3,4] handwritten г uk legible'),
            (4, 2, true, 'salvaged_partial_array', 'ґ|д', ''),
            (5, 5, true, NULL, 'рядок|7|None', ''),
            (6, 0, true, NULL, '[]', ''),
            (7, 0, false, 'json_array_not_found', 'перший|другий', ''),
            (8, 0, false, 'json_array_not_found', '', ''),
            (9, 0, false, 'json_array_not_found', 'лише текст', ''),
            (10, 2, true, NULL, '1|2', ''),
            (11, 0, false, 'json_array_truncated', '[1,', ''),
            (12, 0, false, 'json_decode_error', '[x]', '')) t(case_id, items, ok, error, lines, regions)""",
        "fitted_sizes": f"""WITH {PAGES} SELECT DISTINCT image_width, image_height, {fitted('image_width', 'image_height', 262144)} AS few_w, {fitted('image_height', 'image_width', 262144)} AS few_h,
            {fitted('image_width', 'image_height', 16777216)} AS many_w, {fitted('image_height', 'image_width', 16777216)} AS many_h FROM pages WHERE image_width > 0 AND image_height > 0""",
        "scan_submission": submission,
        "scan_listing": f"SELECT page_id % 5 || '/' || page_id % 3 || '/' || page_id || '.txt' AS path, strlen(label)::BIGINT AS size_bytes FROM ({yolo})",
        "val_assignments": f"""{detector}, last_ AS (SELECT file_name, arg_max(split, source) AS split FROM splits GROUP BY 1)
          SELECT DISTINCT p.file_name, p.image_name AS image, l.split FROM pages p JOIN last_ l USING (file_name) WHERE p.split IN ('train', 'silver') AND p.page_id IN (SELECT page_id FROM clean)""",
        "p1_found": f"{NESTED} SELECT page_id, region_path FROM found",
        "p1_regions": f"""{NESTED} SELECT page_id, region_path, nullif(regexp_replace(region_path, '/?[0-9]+$', ''), '') AS parent_path, regexp_extract(region_path, '[0-9]+$')::INTEGER AS place, len(string_split(region_path, '/'))::INTEGER AS depth,
            {field('o', 'type')}, {field('o', 'text')}, {field('o', 'language')}, {field('o', 'legibility')}, {field('o', 'confidence', 'DOUBLE')} FROM found""",
        "p1_boxes": f"""{NESTED}, b AS (SELECT page_id, region_path, CASE json_type(o, '$.bbox') WHEN 'ARRAY' THEN list_transform(json_extract(o, '$.bbox[*]'), lambda x: TRY_CAST(x->>'$' AS DOUBLE))
            WHEN 'OBJECT' THEN [TRY_CAST(o->>'$.bbox.x1' AS DOUBLE), TRY_CAST(o->>'$.bbox.y1' AS DOUBLE), TRY_CAST(o->>'$.bbox.x2' AS DOUBLE), TRY_CAST(o->>'$.bbox.y2' AS DOUBLE)] END AS b FROM found)
          SELECT page_id, region_path, b[1] AS x1, b[2] AS y1, b[3] AS x2, b[4] AS y2 FROM b WHERE len(b) = 4 AND len(list_filter(b, lambda v: v IS NULL)) = 0""",
        "p1_pages": f"""{NESTED_PAGES} SELECT page_id, raw_id, {', '.join(field('o', c) for c in ('file_name', 'source', 'annotation_source', 'fund', 'content_type', 'subject', 'group'))},
            {', '.join(field('o', c, 'INTEGER') for c in ('image_width', 'image_height', 'year', 'grade'))} FROM owners JOIN valid USING (page_id)""",
        "p1_images": f"""{NESTED_PAGES}, i AS (SELECT page_id, json_extract(o, '$.image') AS i FROM owners WHERE json_type(o, '$.image') = 'OBJECT')
          SELECT page_id, {field('i', 'path')}, {field('i', 'src')}, {field('i', 'width', 'INTEGER')}, {field('i', 'height', 'INTEGER')} FROM i""",
        "ensemble_merge": f"""WITH {PAIRS},
            cand AS (SELECT x.page_id, x.pred_idx, list(x.truth_idx ORDER BY x.iou DESC, x.truth_idx DESC) AS c FROM pairs x JOIN pred p ON p.page_id = x.page_id AND p.idx = x.pred_idx JOIN truth t ON t.page_id = x.page_id AND t.idx = x.truth_idx WHERE p.type = t.type GROUP BY ALL),
            steps AS (SELECT p.page_id, list(coalesce(c, []) ORDER BY idx) AS c, count(*) AS n FROM pred p LEFT JOIN cand ON cand.page_id = p.page_id AND pred_idx = idx GROUP BY 1),
            used AS (SELECT page_id, n, list_reduce(list_prepend([]::INTEGER[], c), lambda acc, x: list_append(acc, coalesce(list_filter(x, lambda y: NOT list_contains(acc, y))[1], -1))) AS u FROM steps),
            took AS (SELECT page_id, unnest(u) AS truth_idx, unnest(range(len(u)))::INTEGER AS pred_idx FROM used)
          SELECT p.page_id, p.idx AS place, p.x1::INTEGER AS x1, p.y1::INTEGER AS y1, p.x2::INTEGER AS x2, p.y2::INTEGER AS y2, p.type, CASE WHEN p.text = '' AND t.idx IS NOT NULL THEN t.text ELSE p.text END AS text
          FROM pred p JOIN took k ON k.page_id = p.page_id AND k.pred_idx = p.idx LEFT JOIN truth t ON t.page_id = p.page_id AND t.idx = k.truth_idx
          UNION ALL
          SELECT t.page_id, (coalesce(n, 0) + row_number() OVER (PARTITION BY t.page_id ORDER BY idx) - 1)::INTEGER, x1::INTEGER, y1::INTEGER, x2::INTEGER, y2::INTEGER, type, text FROM truth t LEFT JOIN used USING (page_id)
          WHERE t.page_id % 23 <> 0 AND NOT coalesce(list_contains(u, idx), false)""",
        "inference_regions": INFERENCE + "SELECT mode, page_id, place, bbox, type, text FROM results",
        "inference_modes": INFERENCE + """SELECT mode, count(*) - count(DISTINCT r.page_id) AS empty_pages FROM (SELECT unnest(['empty', 'detector-vlm', 'page-vlm', 'page-text-vlm']) AS mode) m CROSS JOIN pages p LEFT JOIN (SELECT DISTINCT mode, page_id FROM results) r USING (mode, page_id) GROUP BY mode""",
        "score_normalized": grouped(),
        "normalize_pages": f"WITH {PAGES} SELECT page_id, file_name, image_name, image_width, image_height, source, split, len(rs) AS n_regions FROM pages",
        "predictions_last_wins": """WITH named AS (SELECT *, coalesce(nullif(file_name, ''), nullif(image.path, ''), image.src) AS name FROM page_records)
          SELECT split_part(name, '/', -1) AS image, max(row_id) AS row_id, arg_max(page_id, row_id) AS page_id FROM named WHERE name IS NOT NULL GROUP BY ALL""",
        "quality_weight": f"WITH {PAGES} SELECT annotation_source, quality_weight, count(*) AS pages FROM pages GROUP BY ALL",
        "normalize_region_type": f"WITH {REGS} SELECT type AS raw_type, CASE WHEN type IN {isin(C.REGION_TYPES)} THEN type ELSE 'handwritten' END AS type, count(*) AS regions FROM regs GROUP BY ALL",
        "clamp_regions": f"WITH {CLAMPED} SELECT page_id, idx, x1, y1, x2, y2, type, language, legibility FROM clean",
        "rejected_boxes": f"WITH {CLAMPED} SELECT p.page_id, len(p.rs) - coalesce(c.n, 0) AS rejected FROM pages p LEFT JOIN (SELECT page_id, count(*) AS n FROM clean GROUP BY page_id) c USING (page_id) WHERE len(p.rs) > coalesce(c.n, 0)",
        "region_rows": f"WITH {CLAMPED} SELECT page_id, {region_id} AS region_id, image_name AS image, file_name AS page_file_name, split, source, annotation_source, quality_weight, {box} AS bbox, type, language, legibility, text, {crop} AS crop FROM clean",
        "crop_sft_rows": f"WITH {sft} SELECT page_id, id, image, 'transcribe_region' AS task, region_type, source, quality_weight, {region_prompt('source', 'region_type')} AS prompt, answer FROM sft",
        "page_sft_rows": f"""WITH {CLAMPED} SELECT page_id, split || ':' || stem || ':page' AS id, 'images/' || split || '/' || image_name AS image, 'page_to_regions_json' AS task, source, annotation_source, quality_weight,
            concat_ws(' ', {q(P.PAGE_REGIONS)}, {case(P.PAGE_SOURCE_HINTS, 'source')}) AS prompt, string_agg({box} || '|' || type || '|' || text, chr(10) ORDER BY band, x1, idx) AS answer
          FROM clean WHERE {page_where} GROUP BY page_id, split, stem, image_name, source, annotation_source, quality_weight""",
        "page_text_sft_rows": f"""WITH {LINES} SELECT c.page_id, split || ':' || stem || ':page_text' AS id, 'images/' || split || '/' || image_name AS image, 'page_to_text_lines_json' AS task, source, annotation_source, quality_weight,
            concat_ws(' ', {q(P.PAGE_LINES)}, {case(P.LINE_SOURCE_HINTS, 'source')}) AS prompt, string_agg(o.line, chr(10) ORDER BY c.band, c.x1, c.idx) AS answer
          FROM clean c JOIN own o ON o.page_id = c.page_id AND o.pos = c.pos WHERE {page_where} AND o.line <> '' GROUP BY c.page_id, split, stem, image_name, source, annotation_source, quality_weight""",
        "page_text_lines": f"WITH {LINES} SELECT page_id, string_agg(line, chr(10) ORDER BY band, x1, pos) AS lines, count(*) AS n FROM own WHERE line <> '' GROUP BY page_id",
        "reading_order": f"WITH {CLAMPED} SELECT page_id, idx, (row_number() OVER (PARTITION BY page_id ORDER BY band, x1, idx) - 1)::INTEGER AS place FROM clean",
        "source_counts": f"WITH {PAGES} SELECT coalesce(nullif(source, ''), 'unknown') AS source, count(*) AS pages FROM pages GROUP BY 1",
        "region_type_counts": f"WITH {CLAMPED} SELECT type, count(*) AS regions FROM clean GROUP BY 1",
        "curation_stats": f"""WITH {LINES}, per AS (SELECT page_id, count(*) AS regions, count(CASE WHEN has_image AND {transcribed} AND text <> '' AND legibility = 'legible' THEN 1 END) AS crops, any_value({page_where}) AS page FROM clean GROUP BY page_id)
          SELECT (SELECT count(*) FROM pages) AS pages, sum(regions)::BIGINT AS regions, sum(crops)::BIGINT AS vlm_examples, count(CASE WHEN page THEN 1 END) AS page_sft_examples,
            count(CASE WHEN page AND page_id IN (SELECT page_id FROM own WHERE line <> '') THEN 1 END) AS page_text_sft_examples FROM per""",
        "yolo_labels": yolo,
        "prompts": f"""WITH {CLAMPED}, kinds AS (SELECT DISTINCT source, type FROM clean) SELECT source, type, {region_prompt('source', 'type')} AS region_prompt,
            concat_ws(' ', {q(P.PAGE_REGIONS)}, {case(P.PAGE_SOURCE_HINTS, 'source')}) AS page_prompt, concat_ws(' ', {q(P.PAGE_LINES)}, {case(P.LINE_SOURCE_HINTS, 'source')}) AS lines_prompt FROM kinds""",
        "stratified_split": "WITH " + split_sql(f"{CLAMPED}, rows_ AS (SELECT DISTINCT file_name, source FROM clean WHERE split IN ('train', 'silver'))", "file_name", 0.15, 42, "val", "train") + " SELECT file_name, source, split FROM splits",
        "train_eval_split": "WITH " + split_sql(f"{sft}, rows_ AS (SELECT id, source FROM sft)", "id", 0.1, 42, "eval", "train") + " SELECT source, split, count(*) AS n, min(id) AS first_id FROM splits GROUP BY ALL",
        "val_semi_join": "WITH " + split_sql(f"{CLAMPED}, rows_ AS (SELECT DISTINCT file_name, source FROM clean WHERE split IN ('train', 'silver'))", "file_name", 0.15, 42, "val", "train") + """
          , named_ AS (SELECT DISTINCT p.image_name FROM pages p JOIN (SELECT file_name, arg_max(split, source) AS split FROM splits GROUP BY 1) s USING (file_name) WHERE s.split = 'val' AND p.split IN ('train', 'silver') AND p.page_id IN (SELECT page_id FROM clean))
          SELECT page_id, image_name FROM pages SEMI JOIN named_ USING (image_name)""",
        "sft_filter": f"WITH {sft} SELECT region_type, source, count(*) AS n, sum(length(answer))::BIGINT AS chars FROM sft WHERE image <> '' AND quality_weight >= 0.75 GROUP BY ALL",
        "sample_weights": "SELECT region_key, greatest(coalesce(quality_weight, 1.0), 0.01)::DOUBLE AS weight FROM region_rows QUALIFY row_number() OVER (PARTITION BY region_key ORDER BY exported_at DESC) = 1",
        "weighted_sample": """WITH w AS (SELECT region_key, round(greatest(coalesce(max(quality_weight), 1.0), 0.01) * 1000000)::BIGINT AS w FROM region_rows GROUP BY 1),
            line AS (SELECT region_key, sum(w) OVER (ORDER BY region_key ROWS UNBOUNDED PRECEDING)::BIGINT - w AS lo FROM w), total AS (SELECT sum(w)::BIGINT AS total, count(*) AS n FROM w),
            drawn AS (SELECT floor(('0x' || substr(md5('7:' || r.i::VARCHAR), 1, 12))::BIGINT / 281474976710656.0::DOUBLE * total)::BIGINT AS at FROM total, range((SELECT n FROM total)) r(i))
          SELECT line.region_key, count(*) AS draws FROM drawn ASOF JOIN line ON drawn.at >= line.lo GROUP BY 1""",
        "iou_pairs": f"WITH {PAIRS} SELECT page_id, pred_idx, truth_idx, round(iou, 6) AS iou FROM pairs",
        "greedy_match": f"WITH {MATCHED} SELECT page_id, pred_idx, truth_idx FROM matches",
        "page_counters": f"WITH {counters(normalized)} SELECT page_id, source, annotation_source, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, class_ok::BIGINT AS class_ok, round(cer_sum, 6) AS cer_sum, cer_n::BIGINT AS cer_n, round(page_cer, 6) AS page_cer FROM counters",
        "page_cer": f"WITH {counters(normalized)} SELECT page_id, round(page_cer, 6) AS page_cer FROM counters",
        "score_overall": f"WITH {counters(normalized)}, sums AS (SELECT {SCORES} FROM counters) SELECT {FINAL} FROM sums",
        "score_by_source": grouped("grouping = 'source'"),
        "score_by_annotation_source": grouped("grouping = 'annotation_source'"),
        "score_grouping_sets": grouped(),
        "normalize_text": f"""WITH t AS (SELECT DISTINCT text FROM region_rows), i AS (SELECT text, length(coalesce(text, '')) % 7 AS k FROM t),
            made AS (SELECT CASE k WHEN 0 THEN text || ' \\mathrm{{\\mathbf{{x}}}}²' WHEN 1 THEN text || '~~a~~{{b}} «c» x²³ 2² \\top' WHEN 2 THEN text || '  \\overset{{a}}{{b}}\\big( y_{{12}} z^{{3}} \\sin x' WHEN 3 THEN text || ' \\xrightarrow[a]{{b}}' || chr(160) || chr(28) || 'H₂O ''''' ELSE text END AS text FROM i)
          SELECT text, {normalized('text')} AS normalized FROM made""",
        "finalize_regions": f"""WITH {CLAMPED}, kept AS (SELECT page_id, pos, x1, y1, x2, y2, band, cut.type AS type, cut.text AS text FROM clean JOIN (SELECT page_id, pos, type, text FROM cut) cut USING (page_id, pos))
          SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY band, x1, pos) - 1)::INTEGER AS place, {box} AS bbox, type, CASE WHEN type IN {isin(C.EMPTY_TEXT_TYPES)} THEN '' ELSE text END AS text FROM kept""",
        "synthetic_bands": f"""WITH {zipped} SELECT page_id, (k - 1)::INTEGER AS place, 0 AS x1, least(image_height - 1, (k - 1) * h)::INTEGER AS y1, image_width AS x2,
            greatest(CASE WHEN k = n THEN image_height ELSE least(image_height, least(image_height - 1, (k - 1) * h) + h) END, least(image_height - 1, (k - 1) * h) + 1)::INTEGER AS y2, line AS text
          FROM (SELECT l.*, image_width, image_height, greatest(1, image_height // n) AS h FROM lines l JOIN pages USING (page_id))""",
        "assign_text_lines": f"""WITH {zipped}, ord AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY band, x1, idx) AS k FROM clean WHERE {transcribed}), nord AS (SELECT page_id, count(*) AS m FROM ord GROUP BY 1),
            both_ AS (
              SELECT o.page_id, o.x1, o.y1, o.x2, o.y2, o.type, coalesce(l.line, o.text) AS text, o.k AS i FROM ord o LEFT JOIN lines l ON l.page_id = o.page_id AND l.k = o.k
              UNION ALL
              SELECT page_id, 0, y, image_width, greatest(CASE WHEN j = left_ - 1 THEN image_height ELSE least(image_height, y + h) END, y + 1), 'handwritten', line, 100000 + j FROM (
                SELECT *, least(image_height - 1, j * h) AS y FROM (
                  SELECT l.page_id, l.line, l.k - coalesce(m, 0) - 1 AS j, l.n - coalesce(m, 0) AS left_, p.image_width, p.image_height, greatest(1, p.image_height // greatest(1, l.n - coalesce(m, 0))) AS h
                  FROM lines l JOIN pages p USING (page_id) LEFT JOIN nord USING (page_id) WHERE l.k > coalesce(m, 0)))
              UNION ALL
              SELECT page_id, x1, y1, x2, y2, type, '', 200000 + idx FROM clean WHERE type IN {isin(C.EMPTY_TEXT_TYPES)})
          SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY floor(floor((y1 + y2) / 2.0) / {C.READING_ORDER_ROW_BAND}), x1, i) - 1)::INTEGER AS place, x1::INTEGER AS x1, y1::INTEGER AS y1, x2::INTEGER AS x2, y2::INTEGER AS y2, type, text FROM both_""",
        "submission_join": submission,
        "shard_plan": f"WITH {PLAIN_FILES}, d AS (SELECT DISTINCT export_id || '/' || dir AS dir, file_name FROM files) SELECT dir, file_name, printf('shard-%05d.tar', (row_number() OVER (PARTITION BY dir ORDER BY file_name) - 1) // 100) AS shard FROM d",
        "shard_files": f"WITH {PLAIN_FILES}, {NEWEST}, n AS (SELECT export_id, dir, count(*) AS files FROM files GROUP BY ALL) SELECT n.export_id, n.dir, n.files, ceil(n.files / coalesce(max_files_per_shard, 2000)::DOUBLE)::BIGINT AS shards FROM n LEFT JOIN newest USING (export_id)",
        "dir_counts_guard": f"WITH {PLAIN_FILES}, n AS (SELECT export_id || '/' || dir AS dir, count(*) AS files FROM files GROUP BY 1) SELECT dir, files FROM n WHERE files > 100",
        "manifest_totals": f"WITH {NEWEST}, d AS (SELECT export_id, unnest(packed_dirs) AS d FROM newest) SELECT export_id, count(*) AS dirs, sum(len(d.shards))::BIGINT AS shards, sum(d.file_count)::BIGINT AS files FROM d GROUP BY 1",
        "folder_stats": "SELECT count(*) AS files, sum(size_bytes)::BIGINT AS size_bytes FROM pack_files",
        "format_bytes": """SELECT n, CASE WHEN n >= 1000000000 THEN printf('%d.%02d GB', (n + 5000000) // 10000000 // 100, (n + 5000000) // 10000000 % 100)
            WHEN n >= 1000000 THEN printf('%d.%d MB', (n + 50000) // 100000 // 10, (n + 50000) // 100000 % 10) ELSE printf('%d.%d KB', (n + 50) // 100 // 10, (n + 50) // 100 % 10) END AS text
          FROM (SELECT DISTINCT size_bytes * 100000 AS n FROM pack_files WHERE size_bytes IS NOT NULL)""",
        "top_level_paths": f"WITH {PLAIN_FILES} SELECT DISTINCT split_part(p, '/', 1) AS name, contains(p, '/') AS is_folder FROM (SELECT CASE WHEN dir = '' THEN file_name ELSE dir || '/' || file_name END AS p FROM files)",
        "label_mask": f"WITH {PAGES} SELECT page_id, array_to_string(list_transform(range(1, page_id % 9 + 2), lambda x: CASE WHEN x - 1 < page_id % 4 OR (page_id * x) % 5 = 0 THEN -100 ELSE (page_id * x) % 5 END), ',') AS labels FROM pages",
        "right_truncate": f"WITH {PAGES} SELECT page_id, array_to_string(list_transform(range(1, least(6, page_id % 9 + 1) + 1), lambda x: (page_id * x) % 5), ',') AS ids FROM pages",
    }
