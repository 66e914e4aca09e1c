"""DuckDB SQL with the same results as the queries, over the same tables."""

from __future__ import annotations

from ..functions.replies import OPENING_WORDS
from ..operators.chunks import EARLY_PROMPT, PROMPT, token_budget

WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
# Patterns and opening words that must equal the operators'.
HEADING = r"(?m)^\s*(\d+(?:\.\d+)+)\s+([^\n]+)"
BUDGET = token_budget(4096)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def words(x: str) -> str:
    return (
        f"CAST(CASE WHEN {strip(x)} = '' THEN 0 "
        rf"ELSE len(regexp_split_to_array({strip(x)}, '\s+')) END AS INTEGER)"
    )


def text_literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def query(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


# Word windows


def windows(target: str, overlap: str, source: str = "sections") -> str:
    return rf"""
ws AS (
  SELECT rel_path, regexp_split_to_array(text, '\s+') AS w, {target} AS t, {target} - {overlap} AS step
  FROM {source}),
sized AS (
  SELECT *, CAST(1 + ceil(greatest(len(w) - t, 0) / step) AS INTEGER) AS n FROM ws),
numbered AS (SELECT *, unnest(range(1, n + 1)) AS i FROM sized),
chunks AS (
  SELECT rel_path, CAST(i AS INTEGER) AS chunk_index, n AS n_chunks,
         array_to_string(list_slice(w, (i - 1) * step + 1, (i - 1) * step + t), ' ') AS chunk
  FROM numbered)"""


SECTIONS = "sections AS (SELECT 'd' || doc_id || '.txt' AS rel_path, doc_id, text FROM documents)"
FIXED = windows("800", "150")
DYNAMIC = windows(str(BUDGET.target), str(BUDGET.overlap))
CHUNK_COLUMNS = "rel_path, chunk_index, n_chunks, chunk"
CHUNK_PROGRESS = """
progress AS (
  SELECT 'd' || doc_id || '.txt' AS rel_path, CAST(doc_id % 3 AS INTEGER) AS done
  FROM documents WHERE doc_id % 3 <> 0)"""


def request(prompt: str, max_tokens: int, last: str, where: str = "") -> str:
    return f"""
SELECT rel_path, chunk_index, 'local-model' AS model,
       'system' AS system_role, {text_literal(prompt)} AS system_content,
       'user' AS user_role, {strip("chunk")} AS user_content,
       CAST(0.3 AS DOUBLE) AS temperature, CAST({max_tokens} AS INTEGER) AS max_tokens, {last}
FROM chunks {where}"""


SENDABLE = f"WHERE length({strip('chunk')}) >= 50"
REQUESTS = query(
    SECTIONS, DYNAMIC, select=request(PROMPT, BUDGET.safe_tokens, "false AS stream", SENDABLE)
)

# Pages and sections

PAGES = """
split_lines AS (
  SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents),
lines AS (
  SELECT doc_id, lang, source, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i
  FROM split_lines),
marked AS (
  SELECT doc_id, i,
    CASE WHEN doc_id % 4 <> 0 AND i % 6 = 0 THEN
      (doc_id % 9 + 1) || '.' ||
      CASE WHEN doc_id % 5 = 0 THEN ((i // 6) % 3 + 1) || ' Overview .... ' || (i + 3)
           WHEN doc_id % 7 = 0 THEN '' || (i // 6 + 1)
           ELSE (i // 6 + 1) || ' ' || lang || '/' || source || ': topic ' || (i // 6 + 1)
                || ' .... ' || (i + 3)
      END || chr(10) || line
    ELSE line END AS line
  FROM lines),
paged AS (
  SELECT doc_id, CAST(i // 10 + 1 AS INTEGER) AS page_number,
         string_agg(line, chr(10) ORDER BY i) AS text
  FROM marked GROUP BY doc_id, i // 10),
raw_pages AS (
  SELECT 'd' || doc_id AS doc, page_number,
    CASE WHEN page_number % 14 = 0 THEN NULL
         WHEN page_number % 7 = 0 THEN ''
         WHEN page_number % 3 = 0 THEN chr(7) || chr(12) || text
         WHEN page_number % 5 = 2 THEN text || chr(10) || 'to be continued ............ overleaf'
           || chr(10) || '  ' || page_number || ' ' || chr(10) || 'end'
         ELSE text END AS text
  FROM paged
  UNION ALL SELECT 'blank' || doc_id, 1, '' FROM documents WHERE doc_id % 13 = 5
  UNION ALL SELECT 'blank' || doc_id, 2, ' ' || chr(10) FROM documents WHERE doc_id % 13 = 5),
good_pages AS (
  SELECT doc, page_number, regexp_replace(text, '[\\x00-\\x08\\x0B-\\x1F]', '', 'g') AS text
  FROM raw_pages WHERE text IS NOT NULL AND text <> ''),
texts AS (
  SELECT doc, string_agg(text, chr(10) || chr(10) ORDER BY page_number) AS text
  FROM good_pages GROUP BY doc)"""

HEADINGS = rf"""
cut AS (
  SELECT doc, string_split(
    regexp_replace(text, '{HEADING}', concat(chr(1), '\0'), 'g'), chr(1)) AS ps
  FROM texts),
pieces AS (
  SELECT doc, unnest(ps) AS piece, generate_subscripts(ps, 1) - 1 AS seq FROM cut),
headings AS (
  SELECT doc, CAST(seq AS INTEGER) AS seq,
         regexp_extract(piece, '{HEADING}', 1) AS number,
         regexp_extract(piece, '{HEADING}', 2) AS raw_title,
         {strip("piece")} AS content
  FROM pieces WHERE seq > 0)"""

SPACED_TITLE = r"regexp_replace(raw_title, '\.{2,}', ' ', 'g')"
CLEAN_TITLE = strip(rf"regexp_replace({SPACED_TITLE}, '\s*\d+\s*$', '')")


def file_name(x: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace(regexp_replace(
      {x}, '[\\/*?:"<>|]', '_', 'g'), '\s+', '_', 'g'), '\.{{2,}}', '_', 'g'), '_')"""


TITLE = file_name(f"number || '_' || {CLEAN_TITLE}")
EARLY_BARE = rf"regexp_replace({strip('raw_title')}, '\.{{2,}}', '', 'g')"
EARLY_NAME = strip(rf"(number || '_' || regexp_replace({EARLY_BARE}, '\s*\d+\s*$', ''))")
EARLY_TITLE = rf"""regexp_replace(regexp_replace(
      {EARLY_NAME}, '[\\/*?:"<>|]', '_', 'g'), '\s+', '_', 'g')"""
EARLY_BODY = rf"""regexp_replace(regexp_replace(
      content, '\.{{10,}}', '', 'g'), '\n\s*\d+\s*\n', chr(10), 'g')"""


def parts(source: str, size: int, min_words: int) -> str:
    """Fixed-size parts of ``source`` (doc, text) as CTE ``{source}_parts`` (doc, k, content)."""
    return f"""
{source}_bare AS (SELECT doc, {strip("text")} AS t FROM {source}),
{source}_cut AS (
  SELECT doc, t, unnest(range(0, CAST(ceil(length(t) / {size}.0) AS BIGINT))) AS k FROM {source}_bare),
{source}_all AS (
  SELECT doc, k, {strip(f"substr(t, k * {size} + 1, {size})")} AS content FROM {source}_cut),
{source}_parts AS (
  SELECT doc, k, content, {words("content")} AS words FROM {source}_all
  WHERE {words("content")} >= {min_words})"""


def part_name(prefix: str, number: str) -> str:
    return f"'{prefix}_' || format('{{:03d}}', {number})"


def part_rows(source: str) -> str:
    return f"""
  SELECT doc, CAST(k + 1 AS INTEGER) AS seq, 'part' AS kind,
         {part_name("part", "k + 1")} AS title, content, words
  FROM {source}_parts"""


ROUTED = f"""
plain AS (SELECT doc, text FROM texts WHERE doc NOT IN (SELECT doc FROM headings)),
{parts("plain", 1000, 30)},
routed AS (
  SELECT doc, seq, 'heading' AS kind, {TITLE} AS title, content, {words("content")} AS words
  FROM headings
  UNION ALL {part_rows("plain")})"""

MERGED = f"""
loose AS (
  SELECT doc, string_agg(content, chr(10) || chr(10) ORDER BY seq) AS text
  FROM routed WHERE words < 30 GROUP BY doc),
{parts("loose", 1000, 30)},
ranked AS (
  SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY k) AS INTEGER) AS seq,
         content, words
  FROM loose_parts),
merged AS (
  SELECT doc, seq, 'merged_part' AS kind,
         {part_name("merged_part", "seq")} AS title, content, words
  FROM ranked)"""

WRITTEN = """
written AS (
  SELECT * FROM routed WHERE words >= 30
  QUALIFY row_number() OVER (PARTITION BY doc, title ORDER BY seq DESC) = 1)"""
FINAL = "SELECT * FROM written UNION ALL SELECT * FROM merged"

LOG = """
SELECT doc, 'empty_page' AS event, page_number, CAST(NULL AS VARCHAR) AS title,
       CAST(NULL AS INTEGER) AS n
FROM raw_pages WHERE text IS NULL OR text = ''
UNION ALL
SELECT doc, 'no_text', NULL, NULL, NULL FROM blanks
UNION ALL
SELECT DISTINCT doc, 'no_headings', CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER)
FROM raw_pages
WHERE doc NOT IN (SELECT doc FROM blanks) AND doc NOT IN (SELECT doc FROM headings)
UNION ALL
SELECT doc, 'short_section', NULL, title, words FROM routed WHERE words < 30
UNION ALL
SELECT doc, 'merged_short', NULL, NULL, CAST(count(*) AS INTEGER)
FROM routed WHERE words < 30 GROUP BY doc"""
BLANKS = f"""
blanks AS (
  SELECT doc FROM raw_pages GROUP BY doc
  HAVING max(CASE WHEN {strip("coalesce(text, '')")} <> '' THEN 1 ELSE 0 END) = 0)"""

# Replies and records

RESPONSES = r"""
told AS (
  SELECT a.conv_id, a.turn, (a.conv_id * 7 + a.turn) % 12 AS k,
         CAST(to_json(regexp_replace(u.text, '[\r\n]+', ' ', 'g')) AS VARCHAR)[2:-2] AS q,
         CAST(to_json(regexp_replace(a.text, '[\r\n]+', ' ', 'g')) AS VARCHAR)[2:-2] AS o
  FROM conversations a JOIN conversations u
    ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
  WHERE a.role = 'assistant' AND u.role = 'user'),
filled AS (
  SELECT *,
    '{"instruction":"Explain ' || q || '","input":"","output":"' || o || '"}' AS r1,
    '{"instruction":"What is item ' || (conv_id % 3) || '?","input":["a",' || turn
      || ',null,true],"output":"same"}' AS r2,
    '{"instruction":"tell me","input":null,"output":"x"}' AS r3,
    '{"instruction":"Why?","output":"a' || chr(92) || 'nb"}' AS r4
  FROM told),
responses AS (
  SELECT 'f' || (conv_id // 8) || '.txt' AS rel_path,
         CAST(conv_id % 8 + 1 AS INTEGER) AS chunk_index,
         CAST((turn + 1) // 2 AS INTEGER) AS attempt,
         CASE k WHEN 0 THEN 'no json'
                WHEN 1 THEN '[]'
                WHEN 2 THEN 'Here: [' || r1 || ',' || r2 || ' , ] done'
                WHEN 3 THEN '<think>plan</ Think >[' || r1 || ',' || r3 || ',"str",5,null]'
                WHEN 4 THEN '[1] and [' || r1 || ']'
                WHEN 5 THEN 'Note [1]: [' || r1 || ']'
                WHEN 6 THEN NULL
                WHEN 7 THEN '[' || r2 || ',' || r3 || ']'
                WHEN 8 THEN '[' || r4 || ',' || r3 || ']'
                WHEN 10 THEN '[' || r1 || ',' || chr(8232) || r2 || chr(8233) || ']'
                ELSE '[' || r1 || ',' || r2 || ',' || r3 || ',' || r4 || ',' || r1 || ']'
         END AS raw,
         CASE WHEN k = 6 THEN 'HTTP 500' END AS http_error
  FROM filled
  UNION ALL
  SELECT 'f' || (conv_id // 8) || '.txt', CAST(conv_id % 8 + 1 AS INTEGER),
         CAST((turn + CASE role WHEN 'system' THEN 1 ELSE 2 END) // 2 AS INTEGER), text, NULL
  FROM conversations c
  WHERE role <> 'assistant'
    AND NOT EXISTS (SELECT 1 FROM told t WHERE t.conv_id = c.conv_id AND t.turn = c.turn + 1))"""

PARSED = r"""
spans AS (
  SELECT rel_path, chunk_index, attempt, http_error,
         regexp_extract(regexp_replace(
           regexp_replace(raw, '(?i)<\s*/?\s*think\s*>', '', 'g'), ',\s*\]', ']', 'g'),
           '(?s)\[.*\]', 0) AS span
  FROM responses),
parsed AS (
  SELECT rel_path, chunk_index, attempt, http_error,
         CASE WHEN json_valid(span) AND json_array_length(span) > 0
              THEN json_extract(span, '$[*]') END AS items
  FROM spans)"""


def scanned(required: tuple[str, ...], commas_first: bool) -> str:
    tagless = r"regexp_replace(raw, '(?i)<\s*/?\s*think\s*>', '', 'g')"
    tagless = f"translate({tagless}, chr(8232) || chr(8233), '')"
    fixed = r"regexp_replace({}, ',\s*\]', ']', 'g')"
    text = fixed.format(tagless) if commas_first else tagless
    ready = "cand" if commas_first else fixed.format("cand")
    named = " AND ".join(f"contains(cand, '\"{key}\"')" for key in required)
    return rf"""
upto AS (
  SELECT rel_path, chunk_index, attempt, regexp_extract({text}, '(?s)^.*\]', 0) AS t
  FROM responses),
starts AS (SELECT *, unnest(range(1, length(t) + 1)) AS i FROM upto),
cands AS (
  SELECT rel_path, chunk_index, attempt, i, substr(t, i) AS cand
  FROM starts WHERE substr(t, i, 1) = '['),
hits AS (
  SELECT rel_path, chunk_index, attempt, i, {ready} AS ready FROM cands WHERE {named}),
firsts AS (
  SELECT * FROM hits WHERE json_valid(ready) AND json_array_length(ready) > 0
  QUALIFY row_number() OVER (PARTITION BY rel_path, chunk_index, attempt ORDER BY i) = 1),
scanned AS (
  SELECT r.rel_path, r.chunk_index, r.attempt,
         CASE WHEN f.ready IS NOT NULL THEN json_extract(f.ready, '$[*]') END AS items
  FROM responses r LEFT JOIN firsts f USING (rel_path, chunk_index, attempt))"""


ITEMS = """
items AS (
  SELECT rel_path, chunk_index, attempt,
         unnest(items) AS item, CAST(generate_subscripts(items, 1) AS INTEGER) AS pos
  FROM parsed WHERE items IS NOT NULL)"""


def flat(name: str) -> str:
    value = f"json_extract(item, '$.{name}')"
    return f"""CASE
      WHEN {value} IS NULL OR json_type({value}) = 'NULL' THEN ''
      WHEN json_type({value}) = 'ARRAY' THEN array_to_string(list_transform(
        json_extract({value}, '$[*]'), lambda e: CASE json_type(e)
          WHEN 'NULL' THEN 'None'
          WHEN 'BOOLEAN' THEN CASE WHEN CAST(e AS VARCHAR) = 'true' THEN 'True' ELSE 'False' END
          ELSE json_extract_string(e, '$') END), ' ')
      ELSE json_extract_string({value}, '$') END"""


FIELDS = ("instruction", "input", "output")
RECORDS = f"""
records AS (
  SELECT rel_path, chunk_index, attempt, pos, {", ".join(f"{flat(f)} AS {f}" for f in FIELDS)}
  FROM items WHERE json_type(item) = 'OBJECT')"""
VERBS = "|".join(OPENING_WORDS)


def valid(source: str, name: str) -> str:
    return f"""
{name}_bare AS (
  SELECT rel_path, chunk_index, attempt, pos,
         {", ".join(f"{strip(f)} AS {f}" for f in FIELDS)} FROM {source}),
{name} AS (
  SELECT * FROM {name}_bare
  WHERE instruction <> '' AND output <> ''
    AND NOT regexp_matches(instruction || input || output, '[\\n\\r]')
    AND (ends_with(instruction, '?') OR regexp_matches(instruction, '(?i)^({VERBS})')))"""


VALID = valid("records", "valid")
STRICT = f"""
strict_items AS (
  SELECT rel_path, chunk_index, attempt, pos,
         {", ".join(f"coalesce(json_extract_string(item, '$.{f}'), '') AS {f}" for f in FIELDS)}
  FROM items WHERE json_type(item) = 'OBJECT'
    AND {" AND ".join(f"coalesce(json_type(json_extract(item, '$.{f}')), 'VARCHAR') = 'VARCHAR'" for f in FIELDS)}),
{valid("strict_items", "strict")}"""
REPLIES = (RESPONSES, PARSED, ITEMS, RECORDS, VALID)
EXISTING = """
existing AS (
  SELECT DISTINCT rel_path, instruction, output FROM valid WHERE chunk_index = 3)"""
REPLY_PROGRESS = """
progress AS (
  SELECT DISTINCT 'f' || (conv_id // 8) || '.txt' AS rel_path,
         CAST((conv_id // 8) % 2 AS INTEGER) AS done
  FROM conversations WHERE (conv_id // 8) % 3 <> 0)"""


def accepted(candidates: str, scope: str, order: str = "rel_path, chunk_index, attempt") -> str:
    """The sequential rule, one attempt at a time in ``order``, carrying the keys kept so far."""
    return f"""
candidates AS ({candidates}),
tries AS (
  SELECT {scope} AS scope, rel_path, chunk_index, attempt, rel_path || ' ' || chunk_index AS chunk,
         list(DISTINCT {{'i': instruction, 'o': output}}) AS ks,
         row_number() OVER (PARTITION BY {scope} ORDER BY {order}) AS n
  FROM candidates GROUP BY rel_path, chunk_index, attempt),
walk AS (
  SELECT scope, rel_path, chunk_index, attempt, n, ks AS seen, true AS taken, [chunk] AS done
  FROM tries WHERE n = 1
  UNION ALL
  SELECT scope, rel_path, chunk_index, attempt, n,
         CASE WHEN taken THEN list_concat(seen, ks) ELSE seen END, taken,
         CASE WHEN taken THEN list_append(done, chunk) ELSE done END
  FROM (
    SELECT t.scope, t.rel_path, t.chunk_index, t.attempt, t.chunk, t.n, t.ks, w.seen, w.done,
           NOT list_contains(w.done, t.chunk) AND NOT list_has_all(w.seen, t.ks) AS taken
    FROM walk w JOIN tries t ON t.scope = w.scope AND t.n = w.n + 1)),
accepted AS (
  SELECT c.* FROM candidates c
  JOIN (SELECT rel_path, chunk_index, attempt FROM walk WHERE taken) w
    USING (rel_path, chunk_index, attempt)
  QUALIFY row_number() OVER (
    PARTITION BY {"c.rel_path" if scope == "rel_path" else "1"}, instruction, output
    ORDER BY {order}, pos) = 1)"""


WAITING = """
  SELECT v.* FROM valid v LEFT JOIN progress p ON p.rel_path = v.rel_path
  WHERE v.chunk_index > coalesce(p.done, 0) AND v.attempt <= 3
    AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.rel_path = v.rel_path
                    AND e.instruction = v.instruction AND e.output = v.output)"""
ALL_VALID = "SELECT * FROM valid WHERE attempt <= 3"
PAST_MARKS = """
  SELECT v.* FROM valid v LEFT JOIN progress p ON p.rel_path = v.rel_path
  WHERE v.chunk_index > coalesce(p.done, 0) AND v.attempt <= 3"""
ACCEPTED = (*REPLIES, EXISTING, REPLY_PROGRESS, accepted(WAITING, "rel_path"))
RECORD_COLUMNS = "rel_path, chunk_index, attempt, pos, instruction, input, output"
FAILURES = """
failures AS (
  SELECT p.rel_path, p.chunk_index, p.attempt,
         CASE WHEN p.http_error IS NOT NULL THEN 'http_error'
              WHEN p.items IS NULL THEN 'no_json' ELSE 'no_valid_objects' END AS reason,
         p.http_error AS detail
  FROM parsed p
  LEFT JOIN progress g ON g.rel_path = p.rel_path
  LEFT JOIN (SELECT rel_path, chunk_index, min(attempt) AS a FROM accepted
             GROUP BY rel_path, chunk_index) x
    ON x.rel_path = p.rel_path AND x.chunk_index = p.chunk_index
  WHERE p.chunk_index > coalesce(g.done, 0) AND p.attempt <= 3
    AND (x.a IS NULL OR p.attempt < x.a))"""


def first_per(keys: str) -> str:
    return f"""
SELECT {RECORD_COLUMNS} FROM valid
QUALIFY row_number() OVER (
  PARTITION BY {keys} ORDER BY rel_path, chunk_index, attempt, pos) = 1"""


# Training rows

RENDERED = f"""
rendered AS (
  SELECT rel_path, chunk_index, attempt, pos,
    'Instruction:' || chr(10) || {strip("instruction")} || chr(10)
    || CASE WHEN {strip("input")} <> ''
            THEN 'Input:' || chr(10) || {strip("input")} || chr(10) ELSE '' END
    || 'Response:' || {strip("output")} AS text
  FROM valid)"""
VOCAB = rf"""
tokenized AS (
  SELECT rel_path, chunk_index, attempt, pos,
         regexp_split_to_array({strip("text")}, '\s+') AS ts FROM rendered),
counted AS (
  SELECT token, count(*) AS n FROM (SELECT unnest(ts) AS token FROM tokenized) GROUP BY token),
vocab AS (
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id
  FROM counted ORDER BY n DESC, token LIMIT 200)"""
ENCODED = """
cut_tokens AS (SELECT rel_path, chunk_index, attempt, pos, ts[1:64] AS ts FROM tokenized),
spread_tokens AS (
  SELECT rel_path, chunk_index, attempt, pos, unnest(ts) AS token, generate_subscripts(ts, 1) AS i
  FROM cut_tokens),
id_lists AS (
  SELECT rel_path, chunk_index, attempt, pos, list(coalesce(id, 1) ORDER BY i) AS ids
  FROM spread_tokens LEFT JOIN vocab USING (token)
  GROUP BY rel_path, chunk_index, attempt, pos)"""
ENCODED_ROWS = """
SELECT rel_path, chunk_index, attempt, pos,
       array_to_string(list_resize(ids, 64, 0), ' ') AS input_ids,
       array_to_string(list_transform(range(64), lambda x: CASE WHEN x < len(ids) THEN 1 ELSE 0 END), ' ')
         AS attention_mask,
       array_to_string(list_resize(ids, 64, 0), ' ') AS labels
FROM id_lists"""
ENCODED_QUERY = query(*REPLIES, RENDERED, VOCAB, ENCODED, select=ENCODED_ROWS)

# Written and read back

TEXTS = "SELECT doc_id, coalesce(text, '') AS text FROM documents"
STORED = "SELECT rel_path, instruction, input, output FROM accepted"


def whole_files(columns: str) -> str:
    return f"""SELECT {columns} FROM (
  SELECT doc_id // 50 AS shelf, string_agg(text || chr(10), '' ORDER BY doc_id) AS text
  FROM ({TEXTS}) GROUP BY shelf)"""


def accepting(order: str) -> str:
    return query(*REPLIES, accepted(ALL_VALID, "rel_path", order), select=STORED, recursive=True)


SCAN_COLUMNS = "SELECT rel_path, chunk_index, attempt, CAST(len(items) AS INTEGER) AS n_items FROM scanned"
SECTION_CTES = (PAGES, HEADINGS, ROUTED)

ORACLE_SQL: dict[str, str] = {
    "chunk_fixed": query(SECTIONS, FIXED, select=f"SELECT {CHUNK_COLUMNS} FROM chunks"),
    "chunk_dynamic": query(SECTIONS, DYNAMIC, select=f"SELECT {CHUNK_COLUMNS} FROM chunks"),
    "chunk_by_model": query(
        """
budgets AS (
  SELECT 'd' || doc_id || '.txt' AS rel_path, text,
         greatest(500, CAST(floor(floor(512 * (doc_id % 8 + 1) * 0.8) / 1.3) AS INTEGER)) AS target
  FROM documents),
sized_sections AS (SELECT *, CAST(floor(target * 0.1) AS INTEGER) AS overlap FROM budgets)""",
        windows("target", "overlap", "sized_sections"),
        select=f"SELECT {CHUNK_COLUMNS} FROM chunks",
    ),
    "token_budgets": """
SELECT doc_id, n_chars + 1 AS max_context,
       CAST(floor((n_chars + 1) * CAST(0.8 AS DOUBLE)) AS INTEGER) AS safe_tokens,
       CAST(greatest(500, floor(floor((n_chars + 1) * CAST(0.8 AS DOUBLE)) / 1.3)) AS INTEGER) AS target,
       CAST(floor(greatest(500, floor(floor((n_chars + 1) * CAST(0.8 AS DOUBLE)) / 1.3))
            * CAST(0.1 AS DOUBLE)) AS INTEGER) AS overlap
FROM documents""",
    "word_counts": rf"""
SELECT doc_id, CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS edge_words,
       {words("text")} AS words FROM documents""",
    "small_chunks": query(
        SECTIONS,
        FIXED,
        select=f"SELECT {CHUNK_COLUMNS} FROM chunks WHERE length({strip('chunk')}) < 50",
    ),
    "resume_chunks": query(
        SECTIONS,
        FIXED,
        CHUNK_PROGRESS,
        select=f"""SELECT {CHUNK_COLUMNS} FROM chunks LEFT JOIN progress USING (rel_path)
WHERE chunk_index > coalesce(done, 0)""",
    ),
    "resume_failed": query(
        SECTIONS,
        FIXED,
        CHUNK_PROGRESS,
        select=f"""SELECT {CHUNK_COLUMNS} FROM chunks c WHERE NOT EXISTS (
  SELECT 1 FROM progress p WHERE p.rel_path = c.rel_path AND p.done = c.chunk_index)""",
    ),
    "chunk_labels": query(
        SECTIONS,
        FIXED,
        select="""SELECT rel_path, chunk_index,
       rel_path || ' : chunk ' || chunk_index || '/' || n_chunks AS label FROM chunks""",
    ),
    "requests": REQUESTS,
    "requests_v0": query(
        SECTIONS, FIXED, select=request(EARLY_PROMPT, 8192, "'json_object' AS response_format")
    ),
    "fixed_parts": query(
        "whole AS (SELECT doc_id AS doc, text FROM documents)",
        parts("whole", 4000, 100),
        select=part_rows("whole"),
    ),
    "clean_pages": query(PAGES, select="SELECT doc, page_number, text FROM good_pages"),
    "empty_pages": query(
        PAGES, select="SELECT doc, page_number FROM raw_pages WHERE text IS NULL OR text = ''"
    ),
    "full_text": query(PAGES, select="SELECT doc, CAST(0 AS INTEGER) AS volume, text FROM texts"),
    "full_text_volumes": query(
        PAGES,
        select="""SELECT doc, CAST((page_number - 1) // 3 AS INTEGER) AS volume,
       string_agg(text, chr(10) || chr(10) ORDER BY page_number) AS text
FROM good_pages GROUP BY doc, (page_number - 1) // 3""",
    ),
    "blank_documents": query(PAGES, BLANKS, select="SELECT doc FROM blanks"),
    "extraction_stats": query(
        *SECTION_CTES,
        MERGED,
        WRITTEN,
        f"finals AS ({FINAL})",
        select="""SELECT t.doc, p.pages_kept, CAST(length(t.text) AS BIGINT) AS characters,
       coalesce(f.n_sections, 0) AS n_sections
FROM texts t
JOIN (SELECT doc, count(*) AS pages_kept FROM good_pages GROUP BY doc) p ON p.doc = t.doc
LEFT JOIN (SELECT doc, count(*) AS n_sections FROM finals GROUP BY doc) f ON f.doc = t.doc""",
    ),
    "heading_sections": query(PAGES, HEADINGS, select="SELECT * FROM headings"),
    "section_titles": query(
        PAGES, HEADINGS, select=f"SELECT doc, seq, {TITLE} AS title FROM headings"
    ),
    "early_sections": query(
        PAGES,
        HEADINGS,
        select=f"SELECT doc, seq, {EARLY_TITLE} AS title, {EARLY_BODY} AS content FROM headings",
    ),
    "no_heading_docs": query(
        PAGES,
        HEADINGS,
        select="SELECT doc FROM texts WHERE doc NOT IN (SELECT doc FROM headings)",
    ),
    "routed_sections": query(*SECTION_CTES, select="SELECT * FROM routed"),
    "short_sections": query(*SECTION_CTES, select="SELECT * FROM routed WHERE words < 30"),
    "short_merged": query(*SECTION_CTES, MERGED, select="SELECT * FROM merged"),
    "last_write_wins": query(*SECTION_CTES, WRITTEN, select="SELECT * FROM written"),
    "sections_final": query(*SECTION_CTES, MERGED, WRITTEN, select=FINAL),
    "sections_long_documents": query(*SECTION_CTES, MERGED, WRITTEN, select=FINAL),
    "extraction_log": query(*SECTION_CTES, BLANKS, select=LOG),
    "extraction_log_long_documents": query(*SECTION_CTES, BLANKS, select=LOG),
    "nonblank_documents": query(
        PAGES, select=f"SELECT doc, text FROM texts WHERE {strip('text')} <> ''"
    ),
    "reply_arrays": query(
        RESPONSES,
        PARSED,
        select="""SELECT rel_path, chunk_index, attempt, http_error,
       CAST(len(items) AS INTEGER) AS n_items FROM parsed""",
    ),
    "reply_arrays_scan": query(RESPONSES, scanned(("instruction",), False), select=SCAN_COLUMNS),
    "reply_arrays_scan_strict": query(
        RESPONSES, scanned(("instruction", "output"), True), select=SCAN_COLUMNS
    ),
    "reply_records": query(*REPLIES, select=f"SELECT {RECORD_COLUMNS} FROM records"),
    "valid_records": query(*REPLIES, select=f"SELECT {RECORD_COLUMNS} FROM valid"),
    "valid_records_strict": query(
        RESPONSES, PARSED, ITEMS, STRICT, select=f"SELECT {RECORD_COLUMNS} FROM strict"
    ),
    "dedup_file": query(*REPLIES, select=first_per("rel_path, instruction, output")),
    "dedup_global": query(*REPLIES, select=first_per("instruction, output")),
    "exclude_existing": query(
        *REPLIES,
        EXISTING,
        select=f"""SELECT {RECORD_COLUMNS} FROM valid v WHERE NOT EXISTS (
  SELECT 1 FROM existing e WHERE e.rel_path = v.rel_path
    AND e.instruction = v.instruction AND e.output = v.output)""",
    ),
    "first_parsed": query(
        RESPONSES,
        scanned(("instruction",), False),
        """
chosen AS (
  SELECT * FROM scanned WHERE items IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY rel_path, chunk_index ORDER BY attempt) = 1),
items AS (
  SELECT rel_path, chunk_index, attempt, unnest(items) AS item,
         CAST(generate_subscripts(items, 1) AS INTEGER) AS pos FROM chosen)""",
        select="""SELECT rel_path, chunk_index, attempt, pos,
       json_type(item) = 'OBJECT' AS is_object,
       json_extract_string(item, '$.instruction') AS instruction
FROM items""",
    ),
    "accepted_records": query(
        *ACCEPTED, select=f"SELECT {RECORD_COLUMNS} FROM accepted", recursive=True
    ),
    "accepted_records_run": query(
        *REPLIES,
        accepted(ALL_VALID, "1"),
        select=f"SELECT {RECORD_COLUMNS} FROM accepted",
        recursive=True,
    ),
    "progress_next": query(
        *ACCEPTED,
        select="""SELECT rel_path, max(done) AS done FROM (
  SELECT rel_path, done FROM progress
  UNION ALL SELECT rel_path, chunk_index FROM accepted) GROUP BY rel_path""",
        recursive=True,
    ),
    "completed_chunks": query(
        *ACCEPTED, select="SELECT DISTINCT rel_path, chunk_index FROM accepted", recursive=True
    ),
    "failures": query(*ACCEPTED, FAILURES, select="SELECT * FROM failures", recursive=True),
    "failure_counts": query(
        *ACCEPTED,
        FAILURES,
        select="SELECT reason, count(*) AS n FROM failures GROUP BY reason",
        recursive=True,
    ),
    "pair_counts": query(
        *REPLIES,
        f"kept AS ({first_per('rel_path, instruction, output')})",
        select="""SELECT rel_path, count(*) AS pairs FROM kept GROUP BY rel_path
UNION ALL SELECT NULL, count(*) FROM kept""",
    ),
    "training_text": query(*REPLIES, RENDERED, select="SELECT * FROM rendered"),
    "project_text": query(*REPLIES, RENDERED, select="SELECT text FROM rendered"),
    "vocab": query(*REPLIES, RENDERED, VOCAB, select="SELECT token, n, id FROM vocab"),
    "encoded": ENCODED_QUERY,
    "encoded_by_join": ENCODED_QUERY,
    "incremental_chunks": REQUESTS,
    "incremental_accept": query(
        *REPLIES,
        accepted(ALL_VALID, "rel_path"),
        select=f"SELECT {RECORD_COLUMNS} FROM accepted",
        recursive=True,
    ),
    "listed_documents": "SELECT DISTINCT doc_id // 50 AS shelf, true AS bare_name FROM documents",
    "text_dumps": whole_files("text"),
    "page_text_files": f"""
SELECT CAST(row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id) AS INTEGER) AS page_number, text
FROM ({TEXTS})""",
    "page_table": query(PAGES, select="SELECT doc, page_number, text FROM raw_pages"),
    "section_files": whole_files("'shelf=' || shelf AS folder, true AS same_stem, text"),
    "input_files": "SELECT count(DISTINCT doc_id // 50) AS n_files FROM documents",
    "section_table": query(
        *SECTION_CTES,
        MERGED,
        WRITTEN,
        select=f"""SELECT doc || '/' || title || '.txt' AS rel_path,
       doc || '/' || title || '.jsonl' AS out_path, content AS text FROM ({FINAL})""",
    ),
    "extract_log_files": query(*SECTION_CTES, BLANKS, select=LOG),
    "full_text_table": query(
        PAGES, select="SELECT doc, CAST(0 AS INTEGER) AS volume, text FROM texts"
    ),
    "appended_qa": query(*REPLIES, select="SELECT instruction, input, output FROM valid"),
    "rewritten_qa": query(
        *REPLIES,
        f"kept AS ({first_per('instruction, output')})",
        select="SELECT instruction, input, output FROM kept",
    ),
    "existing_keys": query(
        *REPLIES, select="SELECT DISTINCT rel_path, instruction, output FROM valid"
    ),
    "progress_versions": query(
        REPLY_PROGRESS,
        select="""SELECT rel_path, done, CAST(800 AS INTEGER) AS target, CAST(150 AS INTEGER) AS overlap
FROM progress""",
    ),
    "progress_objects": query(REPLY_PROGRESS, select="SELECT rel_path, done FROM progress"),
    "appended_failures": query(
        *ACCEPTED, FAILURES, select="SELECT * FROM failures", recursive=True
    ),
    "incremental_accept_interleaved": accepting("rel_path, chunk_index % 3, chunk_index, attempt"),
    "settled_interleaved": query(
        RESPONSES, select="SELECT DISTINCT rel_path, chunk_index FROM responses WHERE attempt <= 3"
    ),
    "accept_resumed_failed": accepting(
        "rel_path, CAST(attempt > 1 AS INTEGER), chunk_index, attempt"
    ),
    "accept_rerun": accepting("rel_path, chunk_index, attempt"),
    "accept_after_marks": query(
        *REPLIES,
        REPLY_PROGRESS,
        accepted(PAST_MARKS, "rel_path", "rel_path, CAST(attempt > 1 AS INTEGER), chunk_index, attempt"),
        select=STORED,
        recursive=True,
    ),
    "written_items": query(
        RESPONSES,
        scanned(("instruction",), False),
        """
chosen AS (
  SELECT * FROM scanned WHERE items IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY rel_path, chunk_index ORDER BY attempt) = 1),
items AS (
  SELECT rel_path, chunk_index, attempt, unnest(items) AS item,
         CAST(generate_subscripts(items, 1) AS INTEGER) AS pos FROM chosen)""",
        select="""SELECT json_type(item) = 'OBJECT' AS is_object,
       json_extract_string(item, '$.instruction') AS instruction
FROM items""",
    ),
    "retry_small": query(
        SECTIONS,
        DYNAMIC,
        select=f"SELECT rel_path, chunk_index FROM chunks WHERE length({strip('chunk')}) < 50",
    ),
}
