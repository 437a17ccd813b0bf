"""DuckDB SQL of the queries that it can express whole."""

from energy_mart.llm.chat_windows import BLOCK, BUDGET, HISTORY, HISTORY_TURNS, TOKEN
from energy_mart.llm.collocations import LEAST, MOST_WORDS, TOP
from energy_mart.llm.url_graph import DAMPING, LEAST_DISTRUST, LINK, MARGIN, ROUNDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = {
    "op1_line_dedup": f"""
WITH cut AS (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM cut),
keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM placed
),
frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10
),
marked AS (SELECT k.*, f.key IS NULL AS stays FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
""",
    "op10_ngram_jaccard_join": f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
placed AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM cut WHERE len(w) > 0),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM placed),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
),
sides AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM sides UNION SELECT r.a, l.b FROM reach r JOIN sides l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
""",
    "op7_url_graph": f"""
WITH cut AS (
  SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
placed AS MATERIALIZED (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
),
ruled AS MATERIALIZED (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM placed
),
linked AS (
  SELECT host AS src, translate(unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)), '{_UPPER}', '{_LOWER}') AS dst FROM placed
),
labels AS (SELECT string_split(host, '.') AS l FROM (SELECT host FROM placed UNION SELECT dst FROM linked)),
chains AS (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM labels),
climbs AS (SELECT DISTINCT array_to_string(l[i:], '.') AS host, array_to_string(l[i + 1:], '.') AS parent FROM chains),
kin AS (SELECT * FROM climbs WHERE regexp_matches(host, '^[^.]+\\.[^.]+\\..+$')),
edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (SELECT * FROM linked UNION ALL SELECT host, parent FROM kin UNION ALL SELECT parent, host FROM kin)
  WHERE src <> '' AND dst <> '' AND src <> dst
),
directed AS (SELECT 'trust' AS kind, src, dst FROM edges UNION ALL SELECT 'distrust', dst, src FROM edges),
moves AS MATERIALIZED (SELECT *, 1e0 / count(*) OVER (PARTITION BY kind, src) AS share FROM directed),
given AS MATERIALIZED (
  SELECT host, avg(CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 1e0 ELSE 0e0 END) AS t,
    avg(CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 1e0 ELSE 0e0 END) AS b
  FROM ruled WHERE host <> '' GROUP BY host
),
start AS MATERIALIZED (
  SELECT * FROM (SELECT host, 'trust' AS kind, t / (SELECT sum(t) FROM given) AS seed FROM given
    UNION ALL SELECT host, 'distrust', b / (SELECT sum(b) FROM given) FROM given) WHERE seed > 0
),
r0 AS (SELECT host, kind, seed AS rank FROM start),
{"".join(f"""r{k + 1} AS MATERIALIZED (
  SELECT host, kind, sum(rank) AS rank FROM (
    SELECT m.dst AS host, m.kind, {DAMPING}e0 * r.rank * m.share AS rank FROM r{k} r JOIN moves m ON m.kind = r.kind AND m.src = r.host
    UNION ALL SELECT host, kind, (1 - {DAMPING}e0) * seed FROM start
  ) GROUP BY host, kind
),
""" for k in range(ROUNDS))}spread AS (
  SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust,
    coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust FROM r{ROUNDS} GROUP BY host
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL OR (distrust > {LEAST_DISTRUST} AND distrust > {MARGIN}e0 * trust) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN spread USING (host)
""",
    "op11_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
cut AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
placed AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM cut, range(1, {MOST_WORDS} + 1) AS s(size)),
known AS MATERIALIZED (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM placed GROUP BY ALL HAVING count(*) >= {LEAST}
),
parts AS MATERIALIZED (SELECT lang, phrase, size, f, string_split(phrase, ' ') AS w FROM known),
inner_parts AS (
  SELECT lang, w, f, size, m, unnest(range(1, size - m + 2)) AS i FROM parts, range(2, {MOST_WORDS}) AS t(m) WHERE m < size
),
within AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f FROM inner_parts GROUP BY ALL),
alone AS (
  SELECT p.* FROM parts p LEFT JOIN within x ON x.lang = p.lang AND x.phrase = p.phrase
  WHERE p.size > 1 AND (x.f IS NULL OR 100 * x.f < 100 * p.f)
),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
  FROM alone, range(1, {MOST_WORDS}) AS c(k) WHERE k < size
),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, t.n, ((1000::HUGEINT * a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = head JOIN known y ON y.lang = c.lang AND y.phrase = tail
    JOIN totals t ON t.lang = c.lang
),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut_rank FROM scored)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst WHERE cut_rank = 1 QUALIFY rank <= {TOP}
""",
    "op12_chat_windows": f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
),
escaped AS (
  SELECT *, replace(replace(replace(role, '\\', '\\0'), '<', '\\1'), '>', '\\2') AS er,
    replace(replace(replace(text, '\\', '\\0'), '<', '\\1'), '>', '\\2') AS et,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS place FROM given
),
written AS (
  SELECT *, '<turn ' || er || '>' || et || '</turn>' || chr(10) AS line, place = 0 AND role = 'system' AS leads FROM escaped
),
sized AS MATERIALIZED (
  SELECT *, length(line) AS chars, len(regexp_extract_all(line, '{TOKEN}')) AS tokens, place // {BLOCK} AS block FROM written
),
lead AS MATERIALIZED (SELECT conv_id, chars, tokens FROM sized WHERE leads),
body AS MATERIALIZED (
  SELECT s.conv_id, s.place, s.chars, s.tokens, s.block,
    sum(s.tokens) OVER (PARTITION BY s.conv_id ORDER BY s.place)::BIGINT AS upto,
    row_number() OVER (PARTITION BY s.conv_id, s.block ORDER BY s.place) AS i,
    {BUDGET} - {HISTORY} - coalesce(l.tokens, 0) AS room
  FROM sized s LEFT JOIN lead l ON l.conv_id IS NOT DISTINCT FROM s.conv_id WHERE NOT leads
),
walk AS (
  SELECT conv_id, block, i, place, upto - tokens AS base, true AS opens FROM body WHERE i = 1
  UNION ALL
  SELECT b.conv_id, b.block, b.i, b.place, CASE WHEN b.upto - w.base > b.room THEN b.upto - b.tokens ELSE w.base END, b.upto - w.base > b.room
  FROM walk w JOIN body b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.block = w.block AND b.i = w.i + 1
),
starts AS (SELECT conv_id, place, base FROM walk WHERE opens),
history AS (
  SELECT b.conv_id, sum(b.chars) AS chars FROM starts s JOIN body b ON b.conv_id IS NOT DISTINCT FROM s.conv_id
    AND b.place BETWEEN s.place - {HISTORY_TURNS} AND s.place - 1 AND s.base - (b.upto - b.tokens) <= {HISTORY} GROUP BY b.conv_id
),
opening AS (
  SELECT l.conv_id, l.chars * greatest(1, count(s.place)) AS chars FROM lead l LEFT JOIN starts s ON s.conv_id IS NOT DISTINCT FROM l.conv_id
  GROUP BY l.conv_id, l.chars
),
said AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learnt, sum(chars) FILTER (NOT leads) AS chars
  FROM sized GROUP BY conv_id
)
SELECT a.conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
  (coalesce(a.chars, 0) + coalesce(h.chars, 0) + coalesce(l.chars, 0))::BIGINT AS formatted_chars
FROM said a LEFT JOIN history h ON h.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN opening l ON l.conv_id IS NOT DISTINCT FROM a.conv_id
""",
}
