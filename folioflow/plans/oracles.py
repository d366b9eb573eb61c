"""SQL that states the queries' results on its own, for DuckDB over the same tables."""

from __future__ import annotations

from folioflow.sources.accounts import WITH

TOKENS = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'))"
LINES = r"""lines0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    lines1 AS (SELECT doc_id, unnest(range(len(l))) AS ord, l FROM lines0),
    lines AS (SELECT doc_id, ord, (ord // 40 + 1)::INTEGER AS page_number, ord % 40 AS line, l[ord + 1] AS text FROM lines1 WHERE length(trim(l[ord + 1], ' ')) > 0)"""
BOXES = r"""parts0 AS (SELECT doc_id, page_number, ord, line, string_split(text, ' ') AS w FROM lines),
    parts AS (SELECT doc_id, page_number, line, w, unnest(range(len(w))) AS i FROM parts0),
    boxes AS (SELECT doc_id, page_number, line * 12.0 AS top, ((length(array_to_string(w[1:i], ' ')) + CASE WHEN i > 0 THEN 1 ELSE 0 END) * 5 % 612)::DOUBLE AS x0, length(w[i + 1]) * 5 AS width
              FROM parts WHERE length(w[i + 1]) > 0),
    words AS (SELECT doc_id, page_number, x0, x0 + width AS x1, x0 + width / 2.0 AS c FROM boxes)"""
ITEMS = r"""items0 AS (
        SELECT doc_id, block_id, page_number, y0, x0, reading_order, block_type, text, NULL AS caption, 0 AS kind FROM blocks
        UNION ALL SELECT doc_id, table_id, page_number, y0, x0, 10000, NULL, NULL, caption, 1 FROM tables
        UNION ALL SELECT doc_id, figure_id, page_number, y0, x0, 10000, NULL, NULL, caption, 2 FROM figures
    ), items1 AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, y0, x0, reading_order, kind, block_id) AS ord,
               CASE WHEN kind = 1 THEN 'table' WHEN kind = 2 THEN 'figure' WHEN block_type = 'heading' THEN 'heading'
                    WHEN block_type = 'list_item' AND regexp_matches(text, '^\s*(?:\d+|[a-zA-Z])[\.\)]\s+') THEN 'numbered' ELSE 'text' END AS role
        FROM items0
    ), items2 AS (
        SELECT *, max(CASE WHEN role = 'heading' THEN ord END) OVER (PARTITION BY doc_id ORDER BY ord) AS head FROM items1
    ), items AS (
        SELECT i.*, CASE WHEN i.role <> 'heading' THEN trim(h.text) END AS section FROM items2 i LEFT JOIN items1 h ON h.doc_id = i.doc_id AND h.ord = i.head
    ), runs0 AS (
        SELECT *, CASE WHEN role IN ('text', 'numbered') AND lag(role) OVER (PARTITION BY doc_id ORDER BY ord) = role THEN 0 ELSE 1 END AS b FROM items
    ), runs AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY ord)::BIGINT AS run FROM runs0)"""


def box(*sides: str) -> str:
    return " || ',' || ".join(f"(({x})::DOUBLE)::VARCHAR" for x in sides)


def packs(text_limit: int, list_limit: int) -> str:
    return rf"""pack_members AS (
        SELECT *, {TOKENS.format("text")} AS tokens, row_number() OVER (PARTITION BY doc_id, run ORDER BY ord) AS k, CASE WHEN role = 'text' THEN {text_limit} ELSE {list_limit} END AS most
        FROM runs WHERE role IN ('text', 'numbered')
    ), packing AS (
        SELECT doc_id, run, k, tokens AS held, 1 AS part FROM pack_members WHERE k = 1
        UNION ALL
        SELECT m.doc_id, m.run, m.k, CASE WHEN p.held + m.tokens > m.most THEN m.tokens ELSE p.held + m.tokens END, CASE WHEN p.held + m.tokens > m.most THEN p.part + 1 ELSE p.part END
        FROM packing p JOIN pack_members m ON m.doc_id = p.doc_id AND m.run = p.run AND m.k = p.k + 1
    ), packed AS (
        SELECT m.doc_id, m.run, any_value(m.role) AS role, any_value(m.section) AS section, p.part, min(m.ord) AS ord, string_agg(m.text, chr(10) ORDER BY m.ord) AS content,
               array_to_string(list_sort(list(DISTINCT m.page_number)), ',') AS pages, min(m.page_number) AS page, count(*) AS n_blocks, {box("min(m.x0)", "min(m.y0)", "max(m.x0 + length(m.text) * 5)", "max(m.y0 + 8)")} AS box
        FROM pack_members m JOIN packing p USING (doc_id, run, k) GROUP BY m.doc_id, m.run, p.part
    ), packed_parts AS (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS parts FROM packed)"""


def table_parts(limit: int) -> str:
    return rf"""cells AS (SELECT doc_id, i, (i - 1) // {limit} + 1 AS part, concat_ws(' | ', order_id, status, total, day) AS line FROM account_orders),
    grouped AS (SELECT doc_id, part, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS row_count FROM cells GROUP BY doc_id, part),
    table_parts AS (
        SELECT t.doc_id, t.bare, g.part::INTEGER AS part, (count(*) OVER (PARTITION BY t.doc_id))::INTEGER AS parts, g.row_count::INTEGER AS row_count,
               regexp_replace(CASE WHEN t.bare THEN '' ELSE 'Order | Status | Total Price | Order Date' END || chr(10) || g.body, '^\s+|\s+$', '', 'g') AS content
        FROM tables t JOIN grouped g USING (doc_id))"""


CHUNKS = rf"""{WITH}, {ITEMS}, {packs(200, 200)}, {table_parts(20)}, made0 AS (
        SELECT doc_id, ord, 1 AS part, 1 AS parts, 'section_header' AS chunk_type, text AS content, page_number::VARCHAR AS pages, page_number AS page, NULL AS section,
               'Section ' || nullif(regexp_extract(text, '^\s*((?:\d+\.)*\d+)\b', 1), '') AS label, NULL AS bare, 0 AS row_count, NULL AS caption,
               {box('x0', 'y0', 'x0 + length(text) * 5', 'y0 + 8')} AS box FROM items WHERE role = 'heading'
        UNION ALL SELECT doc_id, ord, part, parts, CASE WHEN role = 'text' THEN 'section_text' WHEN parts > 1 THEN 'list_segment' ELSE 'numbered_list' END, content, pages, page, section, NULL, NULL, 0, NULL, box FROM packed_parts
        UNION ALL SELECT i.doc_id, i.ord, t.part, t.parts, CASE WHEN t.parts > 1 THEN 'table_segment' ELSE 'table' END, t.content, i.page_number::VARCHAR, i.page_number, i.section, 'Table 1', t.bare, t.row_count, NULL, {box('i.x0', 'i.y0', '480', 'i.y0 + 200')}
        FROM items i JOIN table_parts t USING (doc_id) WHERE i.role = 'table'
        UNION ALL SELECT doc_id, ord, 1, 1, 'figure', coalesce(nullif(trim(coalesce(caption, '')), ''), '[Figure: chart]'), page_number::VARCHAR, page_number, section, 'Figure 1', NULL, 0, caption, {box('x0', 'y0', '300', 'y0 + 80')} FROM items WHERE role = 'figure'
    ), made1 AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord, part) AS n FROM made0
    ), made2 AS (SELECT *, format('{{}}-{{}}-{{:04d}}', doc_id, chunk_type, n) AS chunk_id FROM made1
    ), made3 AS (
        SELECT *, lag(chunk_id) OVER (PARTITION BY doc_id ORDER BY n) AS previous, max(CASE WHEN chunk_type = 'section_header' THEN n END) OVER (PARTITION BY doc_id ORDER BY n) AS head_n,
               {TOKENS.format("content")}::BIGINT AS tokens,
               sha256(concat_ws('|', trim(regexp_replace(content, '\s+', ' ', 'g')), chunk_type, pages, coalesce(section, ''))) AS content_hash
        FROM made2
    ), made AS (SELECT m.*, CASE WHEN m.chunk_type <> 'section_header' THEN h.chunk_id END AS section_chunk FROM made3 m LEFT JOIN made3 h ON h.doc_id = m.doc_id AND h.n = m.head_n)"""

PATTERNS = {"table": r"(?i)\b(?:see|refer to)?\s*Table\s+(\d+)\b", "figure": r"(?i)\b(?:see|refer to)?\s*Figure\s+(\d+)\b", "section": r"(?i)\b(?:see|refer to)?\s*Section\s+((?:\d+\.)*\d+)\b"}


def found_references(kind: str) -> str:
    p = PATTERNS[kind]
    chars = lambda what, n: f"coalesce(list_sum(list_transform({what}[1:{n}], lambda x: length(x))), 0)"
    return f"""SELECT doc_id, chunk_id, '{kind}' AS kind, numbers[i] AS number, {chars("pieces", "i")} + {chars("wholes", "i - 1")} AS place FROM (
            SELECT doc_id, chunk_id, regexp_extract_all(content, '{p}', 1) AS numbers, regexp_extract_all(content, '{p}', 0) AS wholes, regexp_split_to_array(content, '{p}') AS pieces, unnest(range(1, len(numbers) + 1)) AS i FROM made)"""


EDGES = rf"""{CHUNKS}, refs0 AS (
        {found_references("table")} UNION ALL {found_references("figure")} UNION ALL {found_references("section")}
    ), labels AS (SELECT doc_id, label, arg_min(chunk_id, n) AS target FROM made WHERE label IS NOT NULL GROUP BY doc_id, label
    ), refs1 AS (SELECT *, upper(kind[1]) || kind[2:] || ' ' || number AS name FROM refs0
    ), refs AS (
        SELECT r.doc_id, r.chunk_id, 'references_' || kind AS edge_type, l.target, name AS label, l.target IS NOT NULL AS resolved,
               'rel-' || substr(sha256(concat_ws(':', r.chunk_id, 'references_' || kind, name, place::BIGINT::VARCHAR)), 1, 12) AS edge_id
        FROM refs1 r LEFT JOIN labels l ON l.doc_id = r.doc_id AND l.label = name
    ), structural AS (
        SELECT doc_id, chunk_id, 'belongs_to_section' AS edge_type, section_chunk AS target, section AS label, true AS resolved FROM made WHERE section_chunk IS NOT NULL
        UNION ALL SELECT doc_id, chunk_id, 'follows', previous, previous, true FROM made WHERE chunk_type <> 'section_header' AND previous IS NOT NULL
    ), edges AS (SELECT * FROM structural UNION ALL SELECT * EXCLUDE (edge_id) FROM refs)"""

BROKEN = rf"""{EDGES}, typed AS (SELECT doc_id, chunk_id, list(DISTINCT edge_type) AS kinds FROM edges GROUP BY doc_id, chunk_id
    ), checked AS (SELECT m.*, coalesce(t.kinds, []) AS kinds FROM made m LEFT JOIN typed t USING (doc_id, chunk_id)
    ), broken AS (
        SELECT doc_id, n, 3 AS rule, 'table_header_missing' AS code FROM checked WHERE chunk_type IN ('table', 'table_segment') AND bare
        UNION ALL SELECT doc_id, n, 9, 'table_reference_not_resolved' FROM checked WHERE contains(content, 'Table ') AND NOT list_contains(kinds, 'references_table')
        UNION ALL SELECT doc_id, n, 10, 'figure_reference_not_resolved' FROM checked WHERE contains(content, 'Figure ') AND NOT list_contains(kinds, 'references_figure')
        UNION ALL SELECT doc_id, n, 11, 'section_reference_not_resolved' FROM checked WHERE contains(content, 'Section ') AND NOT list_contains(kinds, 'references_section'))"""

SECTIONS = rf"""{CHUNKS}, heads0 AS (
        SELECT doc_id, trim(content) AS title, row_number() OVER (PARTITION BY doc_id ORDER BY page, chunk_id) AS h, nullif(regexp_extract(content, '^\s*((?:\d+\.)*\d+)\b', 1), '') AS number
        FROM made WHERE chunk_type = 'section_header'
    ), heads AS (
        SELECT c.doc_id, c.title, c.h, arg_max(p.title, p.h) AS parent
        FROM heads0 c LEFT JOIN heads0 p ON p.doc_id = c.doc_id AND p.h < c.h AND p.number = nullif(regexp_extract(c.number, '^(.*)\.\d+$', 1), '') GROUP BY c.doc_id, c.title, c.h
        UNION ALL SELECT DISTINCT doc_id, 'Document', 1, NULL FROM made WHERE doc_id NOT IN (SELECT doc_id FROM heads0)
    ), walk AS (
        SELECT doc_id, title, h, title AS path, NULL::VARCHAR AS parent_path, 1 AS depth, lpad(h::VARCHAR, 9, '0') AS sort_path FROM heads WHERE parent IS NULL
        UNION ALL SELECT c.doc_id, c.title, c.h, w.path || ' > ' || c.title, w.path, w.depth + 1, w.sort_path || '/' || lpad(c.h::VARCHAR, 9, '0') FROM walk w JOIN heads c ON c.doc_id = w.doc_id AND c.parent = w.title
    ), sections AS (
        SELECT *, doc_id || '-section-' || substr(sha256(doc_id || ':' || path), 1, 12) AS section_id,
               CASE WHEN parent_path IS NOT NULL THEN doc_id || '-section-' || substr(sha256(doc_id || ':' || parent_path), 1, 12) END AS parent_id FROM walk
    ), owned AS (
        SELECT m.*, s.sort_path FROM made m JOIN sections s ON s.doc_id = m.doc_id AND s.title = CASE WHEN m.chunk_type = 'section_header' THEN trim(m.content) ELSE coalesce(m.section, 'Document') END
    ), members AS (
        SELECT o.*, s.section_id, s.path, o.sort_path = s.sort_path AS direct FROM owned o JOIN sections s ON s.doc_id = o.doc_id AND (o.sort_path = s.sort_path OR starts_with(o.sort_path, s.sort_path || '/')))"""

MONEY = r"(?:USD|EUR|KES|GBP|\$|€|£)?\s*-?\d[\d,]*(?:\.\d+)?"
PERCENT = r"-?\d+(?:\.\d+)?%"
DATE = r"\b(?:\d{4}-\d{2}-\d{2}|[A-Z][a-z]{2,9}\s+\d{1,2},\s+\d{4})\b"
FACTS_TAIL = rf"""chunk_lines AS (
        SELECT doc_id, chunk_id, n, page, content, chunk_type, list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x)), lambda x: length(x) > 0) AS ls FROM made
    ), kv AS (
        SELECT doc_id, chunk_id, page, content, trim(regexp_extract(line, '^([A-Za-z][A-Za-z0-9 /&()%-]{{1,60}}):\s*(.+)$', 1)) AS name, trim(regexp_extract(line, '^([A-Za-z][A-Za-z0-9 /&()%-]{{1,60}}):\s*(.+)$', 2)) AS value
        FROM (SELECT *, unnest(ls) AS line FROM chunk_lines) WHERE regexp_matches(line, '^([A-Za-z][A-Za-z0-9 /&()%-]{{1,60}}):\s*(.+)$')
    ), tabular AS (
        SELECT *, list_filter(list_transform(string_split(ls[1], '|'), lambda x: trim(x)), lambda x: length(x) > 0) AS heads FROM chunk_lines
        WHERE (chunk_type IN ('table', 'table_segment') OR contains(content, '|')) AND len(ls) >= 2
    ), rows0 AS (SELECT *, list_transform(string_split(unnest(ls[2:]), '|'), lambda x: trim(x)) AS cell FROM tabular WHERE len(heads) >= 2
    ), rows1 AS (SELECT *, unnest(range(2, len(heads) + 1)) AS c FROM rows0 WHERE len(cell) = len(heads)
    ), tab AS (SELECT doc_id, chunk_id, page, content, trim(cell[1] || ' ' || heads[c]) AS name, cell[c] AS value FROM rows1 WHERE length(cell[c]) > 0
    ), hinted AS (
        SELECT doc_id, chunk_id, page, content, list_filter(['amount due', 'date', 'expenditure', 'expense', 'fiscal period', 'income', 'invoice number', 'margin', 'period', 'profit', 'ratio', 'revenue'], lambda h: contains(lower(content), h)) AS hints,
               coalesce(nullif(trim(regexp_extract(content, '{MONEY}')), ''), nullif(trim(regexp_extract(content, '{PERCENT}')), ''), nullif(trim(regexp_extract(content, '{DATE}')), '')) AS value FROM made
    ), inl AS (SELECT doc_id, chunk_id, page, content, unnest(hints) AS name, value FROM hinted
    ), every AS (SELECT *, 1 AS rank FROM kv UNION ALL SELECT *, 2 FROM tab UNION ALL SELECT *, 3 FROM inl WHERE value IS NOT NULL
    ), named AS (SELECT *, regexp_replace(lower(trim(name)), '\s+', ' ', 'g') AS normalized_name, trim(replace(value, ',', '')) AS cleaned FROM every WHERE length(value) > 0
    ), typed_facts AS (
        SELECT *, 'fact-' || substr(sha256(concat_ws(':', doc_id, chunk_id, normalized_name, value)), 1, 16) AS fact_id,
               CASE WHEN regexp_full_match(cleaned, '{PERCENT}') THEN 'percentage' WHEN regexp_full_match(cleaned, '{MONEY}') THEN 'currency' WHEN regexp_full_match(trim(value), '{DATE}') THEN 'date'
                    WHEN regexp_matches(regexp_replace(cleaned, '[^0-9.-]', '', 'g'), '[0-9]') THEN 'number' ELSE 'text' END AS value_type,
               try_cast(nullif(regexp_replace(cleaned, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS num, nullif(trim(regexp_extract(content, '{DATE}')), '') AS period
        FROM named
    ), facts AS (
        SELECT fact_id, doc_id, chunk_id, normalized_name, value AS fact_value, value_type,
               CASE WHEN value_type = 'percentage' THEN '%' WHEN value_type = 'currency' AND (starts_with(cleaned, 'USD') OR starts_with(cleaned, '$')) THEN 'USD' WHEN value_type = 'currency' AND starts_with(cleaned, 'KES') THEN 'KES' END AS unit,
               CASE WHEN value_type IN ('percentage', 'currency', 'number') THEN num END AS numeric_value, period, page AS page_number, rank, name
        FROM typed_facts
    ), one AS (SELECT * FROM facts QUALIFY row_number() OVER (PARTITION BY fact_id ORDER BY rank DESC, name DESC) = 1)"""
FACTS = f"{CHUNKS}, {FACTS_TAIL}"
FACT_COLUMNS = "fact_id, doc_id, normalized_name, fact_value, value_type, unit, numeric_value, period, page_number"

ENTITIES = rf"""{SECTIONS}, found AS (
        SELECT doc_id, section_id, unnest(regexp_extract_all(content, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b')) AS raw, 1 AS score FROM members
        UNION ALL SELECT doc_id, section_id, unnest(regexp_extract_all(content, '\b[A-Z]{{2,}}[A-Z0-9\-]{{1,}}\b')), 2 FROM members
    ), scored AS (
        SELECT doc_id, section_id, regexp_replace(trim(raw), '\s+', ' ', 'g') AS entity, sum(score)::BIGINT AS score FROM found
        WHERE lower(regexp_replace(trim(raw), '\s+', ' ', 'g')) NOT IN ('section', 'table', 'figure', 'document') GROUP BY ALL
    ), entities AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section_id ORDER BY score DESC, lower(entity), entity) AS rank FROM scored QUALIFY rank <= 8)"""
TYPE = "CASE WHEN chunk_type IN ('section_header', 'section_text') THEN 'narrative_text' WHEN chunk_type IN ('table', 'table_segment') THEN 'tables' WHEN chunk_type = 'figure' THEN 'figures' ELSE 'lists' END"
SUMMARIES = r""", first_chunks AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id, section_id ORDER BY sort_path, n) AS k FROM members WHERE chunk_type <> 'section_header' QUALIFY k <= 6
    ), joined AS (SELECT doc_id, section_id, replace(string_agg(content, ' ' ORDER BY k), chr(10), '. ') AS t, count(*)::INTEGER AS n_sources FROM first_chunks GROUP BY doc_id, section_id
    ), summaries AS (
        SELECT doc_id, section_id, n_sources, array_to_string(list_transform(list_filter(regexp_split_to_array(t, '[.?]'), lambda s: length(trim(s)) > 0)[1:3], lambda s: trim(s)), '. ') AS summary FROM joined)"""
TERMS = "list_distinct(regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+'))"
def index(texts: tuple[str, ...]) -> str:
    return rf"""{ENTITIES}{SUMMARIES}, spans AS (
        SELECT doc_id, section_id, min(page) AS page_start, max(page) AS page_end, list(DISTINCT {TYPE}) AS types FROM members GROUP BY doc_id, section_id
    ), names AS (SELECT doc_id, section_id, string_agg(entity, ' ') AS e FROM entities GROUP BY doc_id, section_id
    ), index AS (
        SELECT s.doc_id, s.section_id, s.title, p.page_start, p.types AS d, {TERMS.format("s.title")} AS a, {TERMS.format("n.e")} AS b, {TERMS.format("y.summary")} AS c
        FROM sections s JOIN spans p USING (doc_id, section_id) LEFT JOIN names n USING (doc_id, section_id) LEFT JOIN summaries y USING (doc_id, section_id)
    ), topics AS (
        SELECT k AS request_id, doc_id, {TERMS.format(f"{list(texts)}[k % 4 + 1]")} AS t FROM accounts
    ), pairs AS (
        SELECT *, len(list_intersect(t, a)) AS ia, len(list_intersect(t, b)) AS ib, len(list_intersect(t, c)) AS ic, len(list_intersect(t, d)) AS id FROM topics JOIN index USING (doc_id))"""


TOPICS = ("order results", "revenue of the account", "account overview tables", "chart figures")
QUESTIONS = ("What is the revenue?", "Show the account balance", "market segment", "Which order date is 2001?")
INDEX = index(TOPICS)
#: How many terms fall into each of eight buckets of their hash, plus one.
EMBEDDING = "list_transform(range(8), lambda d: (len(list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+'), lambda t: ('0x' || substr(md5(t), 1, 4))::INTEGER % 8 = d)) + 1)::DOUBLE)"
VECTORS = rf"""vectors AS (
        SELECT m.doc_id, m.chunk_id AS vec_id, {EMBEDDING.format("m.content")} AS e, m.content, coalesce(o.section_id, '') AS section_id, coalesce(s.title, '') AS section_title, m.page AS page_number, m.pages AS page_refs, m.box AS bounding_box, m.chunk_type, m.content_hash
        FROM made m LEFT JOIN members o ON o.doc_id = m.doc_id AND o.chunk_id = m.chunk_id AND o.direct LEFT JOIN sections s ON s.section_id = o.section_id)"""
LOOKUPS = """lookups AS (
        SELECT request_id, fact_id, any_value(page_number) AS page_number, any_value(fact_value) AS fact_value, any_value(chunk_id) AS chunk_id, any_value(trim(name)) AS fact_name, any_value(doc_id) AS doc_id, any_value(rank) AS kind,
               sum((normalized_name = t)::INT * 4 + contains(normalized_name, t)::INT * 2 + contains(lower(name), t)::INT + contains(lower(fact_value), t)::INT)::BIGINT AS score
        FROM (SELECT request_id, doc_id AS d, unnest(ts) AS t FROM asked) JOIN one ON one.doc_id = d GROUP BY request_id, fact_id HAVING score > 0
    ), looked AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_number, fact_id) AS k FROM lookups)"""
ASKED = "asked AS (SELECT k AS request_id, doc_id, [['revenue'], ['account', 'balance'], ['market', 'segment'], ['order', 'date', '2001']][k % 4 + 1] AS ts FROM accounts WHERE k % 4 <> 2)"
ANSWERS = rf"""{index(QUESTIONS)}, {VECTORS}, {FACTS_TAIL}, {ASKED}, {LOOKUPS}, placed AS (
        SELECT l.request_id, l.k, l.fact_id, CASE WHEN l.kind = 3 THEN upper(l.fact_name[1]) ELSE l.fact_name[1] END || l.fact_name[2:] AS fact_name, l.kind, l.fact_value, s.section_id FROM looked l JOIN made m ON m.doc_id = l.doc_id AND m.chunk_id = l.chunk_id
        LEFT JOIN sections s ON s.doc_id = l.doc_id AND s.title = coalesce(m.section, 'Document') AND (m.section IS NOT NULL OR NOT EXISTS (SELECT 1 FROM heads0 h WHERE h.doc_id = l.doc_id)) WHERE l.k <= 5
    ), by_facts AS (
        SELECT request_id, 'structured_query' AS path, string_agg(fact_name || ' = ' || fact_value, '; ' ORDER BY k) AS answer, array_to_string(list_sort(list(DISTINCT section_id) FILTER (section_id IS NOT NULL)), ',') AS matched_section_ids,
               array_to_string(list_sort(list(fact_id)), ',') AS matched_fact_ids, count(*) AS n_provenance FROM placed GROUP BY request_id
    ), others AS (SELECT k, doc_id FROM accounts WHERE k NOT IN (SELECT request_id FROM looked)
    ), fitting AS (
        SELECT request_id, doc_id, section_id FROM pairs WHERE request_id IN (SELECT k FROM others) AND 4 * ia + 2 * ib + ic + id > 0
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY 4 * ia + 2 * ib + ic + id DESC, page_start, title, section_id) <= 5
    ), near AS (
        SELECT k AS request_id, v.*, round(1 - list_cosine_similarity(v.e, {EMBEDDING.format(f"{list(QUESTIONS)}[k % 4 + 1]")}), 9) AS d FROM others a JOIN vectors v ON v.doc_id = a.doc_id WHERE
        (v.section_id IN (SELECT f.section_id FROM fitting f WHERE f.request_id = k) OR NOT EXISTS (SELECT 1 FROM fitting f WHERE f.request_id = k))
    ), nearest AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY d, page_number, vec_id) AS k FROM near QUALIFY k <= 5
    ), by_chunks AS (
        SELECT request_id, CASE WHEN request_id % 4 = 2 THEN '' ELSE 'structured_query,' END || 'pageindex_navigate,semantic_search' AS path, arg_min(string_split(content, chr(10))[1], k) AS answer, array_to_string(list_sort(list(DISTINCT section_id) FILTER (section_id <> '')), ',') AS matched_section_ids,
               '' AS matched_fact_ids, count(*) AS n_provenance FROM nearest GROUP BY request_id
    ), answers AS (SELECT *, 'supported' AS status FROM by_facts UNION ALL SELECT *, 'supported' FROM by_chunks)"""


CLASSED = r"""per AS (
        SELECT l_orderkey AS doc_id, count(*) AS pages, sum(l_quantity::BIGINT * 10)::BIGINT AS chars, max(l_discount) * 10 AS image, max(l_tax) AS tax, min(l_returnflag) <> 'R' AS font, least(count(DISTINCT l_shipdate), 2) AS x_clusters
        FROM lineitem GROUP BY l_orderkey
    ), stats AS (SELECT *, chars / 500000.0::DOUBLE AS density, tax >= 0.08::DOUBLE AS form, tax * 5 AS grid FROM per
    ), originated AS (
        SELECT *, CASE WHEN form THEN 'form_fillable'
            WHEN (density >= 0.002::DOUBLE AND image <= 0.2::DOUBLE AND font) AND NOT (chars / pages <= 20 AND image >= 0.6::DOUBLE) THEN 'native_digital'
            WHEN (chars / pages <= 20 AND image >= 0.6::DOUBLE) THEN 'scanned_image'
            WHEN image > 0.3::DOUBLE AND density > 0.0005::DOUBLE THEN 'mixed' WHEN density <= 0.0003::DOUBLE THEN 'scanned_image' ELSE 'native_digital' END AS origin,
            (x_clusters >= 2)::INT + (grid >= 0.35::DOUBLE)::INT + (image >= 0.45::DOUBLE)::INT AS flags FROM stats
    ), profiled0 AS (
        SELECT *, CASE WHEN flags > 1 THEN 'mixed' WHEN grid >= 0.35::DOUBLE THEN 'table_heavy' WHEN image >= 0.45::DOUBLE THEN 'figure_heavy' WHEN x_clusters >= 2 THEN 'multi_column' ELSE 'single_column' END AS layout FROM originated
    ), profiled AS (
        SELECT *, CASE WHEN origin = 'scanned_image' OR layout = 'figure_heavy' THEN 'needs_vision_model'
                       WHEN origin IN ('mixed', 'form_fillable') OR layout IN ('multi_column', 'table_heavy', 'mixed') THEN 'needs_layout_model' ELSE 'fast_text_sufficient' END AS cost,
               CASE WHEN origin = 'scanned_image' THEN 'vision' WHEN layout IN ('multi_column', 'table_heavy', 'mixed') OR origin IN ('mixed', 'form_fillable') THEN 'layout_aware' ELSE 'fast_text' END AS initial,
               greatest(0, least(1, 0.35::DOUBLE * least(1.0::DOUBLE, chars / 200) + 0.35::DOUBLE * least(1.0::DOUBLE, density / 0.001::DOUBLE)
                   + 0.2::DOUBLE * CASE WHEN image <= 0.35::DOUBLE THEN 1 ELSE 1 - (image - 0.35::DOUBLE) END + 0.1::DOUBLE * font::INT)) AS c_fast FROM profiled0)"""
ATTEMPTS = rf"""{CLASSED}, rungs AS (
        SELECT doc_id, initial, 0 AS rung, 'fast_text' AS strategy, c_fast AS confidence, true AS has, 0.001::DOUBLE + 0.0002::DOUBLE * pages AS price, 0.7::DOUBLE AS need FROM profiled
        UNION ALL SELECT doc_id, initial, 1, 'layout_aware', greatest(0, least(1, 0.45::DOUBLE + least(1, chars / 50 / 80 + 0.15::DOUBLE * (pages % 3)))), pages > 1, 0.01::DOUBLE + 0.001::DOUBLE * pages, 0.75::DOUBLE FROM profiled
        UNION ALL SELECT doc_id, initial, 2, 'vision', CASE WHEN chars / 50 <= 0 THEN 0 ELSE 0.55::DOUBLE + 0.45::DOUBLE * least(1, chars / 50 / greatest(1, 12 * sqrt(pages))) END, true, round((300 + 1200 * pages) / 1000.0::DOUBLE * 0.006::DOUBLE, 8), 0.78::DOUBLE FROM profiled
    ), tried0 AS (
        SELECT *, has AND confidence >= need AS ok FROM rungs WHERE rung >= CASE initial WHEN 'fast_text' THEN 0 WHEN 'layout_aware' THEN 1 ELSE 2 END
    ), tried1 AS (
        SELECT *, coalesce(bool_or(ok) OVER before, false) AS done, coalesce(sum(price) OVER before, 0) AS spent FROM tried0
        WINDOW before AS (PARTITION BY doc_id ORDER BY rung ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), tried2 AS (SELECT *, strategy = 'vision' AND spent + 0.009::DOUBLE > 0.15::DOUBLE AS over, row_number() OVER (PARTITION BY doc_id ORDER BY rung) AS attempt FROM tried1 WHERE NOT done
    ), attempts AS (
        SELECT doc_id, attempt, strategy, confidence, price AS cost, spent + CASE WHEN over THEN 0 ELSE price END AS budget_spent, ok AND NOT over AS accepted, attempt > 1 AS escalated,
               CASE WHEN over THEN 'budget_cap_exceeded' WHEN rung = 2 AND NOT ok THEN 'all_strategies_below_threshold' END AS error FROM tried2)"""

LANGUAGES = r"""lang_words AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g'), ' ') AS w FROM documents),
    lang_counts AS (SELECT doc_id, len(list_filter(w, lambda x: x IN ('der', 'die', 'das', 'und', 'ein', 'nicht', 'mit', 'sich', 'den', 'von'))) AS de,
                     len(list_filter(w, lambda x: x IN ('the', 'and', 'of', 'to', 'in', 'is', 'that', 'for', 'with', 'are'))) AS en,
                     len(list_filter(w, lambda x: x IN ('el', 'los', 'las', 'del', 'que', 'con', 'por', 'para', 'una', 'al'))) AS es,
                     len(list_filter(w, lambda x: x IN ('le', 'les', 'des', 'et', 'que', 'dans', 'pour', 'est', 'du', 'qui'))) AS fr FROM lang_words),
    signals AS (SELECT doc_id, CASE WHEN greatest(de, en, es, fr) = 0 THEN 'und' WHEN de = greatest(de, en, es, fr) THEN 'de' WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS code,
               CASE WHEN greatest(de, en, es, fr) = 0 THEN 0.5::DOUBLE ELSE round(greatest(de, en, es, fr) / (de + en + es + fr), 6) END AS confidence FROM lang_counts)"""
PAGES = """p0 AS (
            SELECT doc_id, page_number, count(*) AS n, sum((x1 - x0) / 5)::BIGINT AS chars, count(*) FILTER (c < 0.4::DOUBLE * 612) AS l, count(*) FILTER (c > 0.6::DOUBLE * 612) AS r FROM words GROUP BY doc_id, page_number
        ), bins AS (SELECT doc_id, page_number, floor(x / 10) AS b, count(*) AS k FROM (SELECT doc_id, page_number, unnest([x0, x1]) AS x FROM words) GROUP BY doc_id, page_number, b
        ), rep AS (SELECT doc_id, page_number, avg(CASE WHEN k > 2 THEN 1.0::DOUBLE ELSE 0 END) AS s FROM bins GROUP BY doc_id, page_number
        ), j AS (SELECT *, CASE WHEN l / n >= 0.25::DOUBLE AND r / n >= 0.25::DOUBLE THEN greatest(0, 1 - 2 * ((n - l - r) / n)) ELSE 0 END AS bal FROM p0 JOIN rep USING (doc_id, page_number))"""
CLUSTERS = """o AS (SELECT doc_id, page_number, list_sort(list(c)) AS cs FROM words GROUP BY doc_id, page_number),
        clusters AS (SELECT doc_id, page_number, list_reduce(list_transform(cs, lambda x: {'a': x, 'n': 1::BIGINT}), lambda s, x: CASE WHEN x.a - s.a > 0.12::DOUBLE * 612 THEN {'a': x.a, 'n': s.n + 1} ELSE s END).n AS x_clusters FROM o)"""
DOMAINS = """domain_tokens AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS t FROM {0}),
        domain_counts AS (SELECT doc_id, sum(len(list_filter(t, lambda x: x IN ('balance', 'invoice', 'revenue', 'tax')))) AS f, sum(len(list_filter(t, lambda x: x IN ('agreement', 'clause', 'contract', 'statute')))) AS l,
                     sum(len(list_filter(t, lambda x: x IN ('architecture', 'api', 'module', 'protocol')))) AS e, sum(len(list_filter(t, lambda x: x IN ('diagnosis', 'patient', 'treatment', 'clinical')))) AS m FROM domain_tokens GROUP BY doc_id),
        domains AS (SELECT doc_id, CASE WHEN greatest(f, l, e, m) = 0 THEN 'general' WHEN f = greatest(f, l, e, m) THEN 'financial' WHEN l = greatest(f, l, e, m) THEN 'legal' WHEN e = greatest(f, l, e, m) THEN 'technical' ELSE 'medical' END AS domain FROM domain_counts)"""

#: Blocks of web pages with their places: page_id, pos, block_type, x.
HTML = r"""c AS (SELECT page_id, regexp_replace(coalesce(html, ''), '<(?:style|script)[^>]*>(?:.|\n)*?</(?:style|script)>', '', 'g') AS h FROM pages),
        found AS (SELECT page_id, """ + " || ".join(
    f"list_transform(regexp_extract_all(h, '<{tag}(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)', 1), lambda t: {{'block_type': '{kind}', 'raw': t}})"
    for tag, kind in (("title", "title"), ("h1", "heading"), ("li", "list_item"), ("p", "paragraph"))
) + r""" AS list FROM c),
        raws AS (SELECT page_id, unnest(list, recursive := true), generate_subscripts(list, 1) - 1 AS pos FROM found),
        h AS (SELECT * FROM (SELECT page_id, pos, block_type, trim(replace(replace(replace(replace(replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), ' ') AS x FROM raws) WHERE length(x) > 0)"""

ORACLE_SQL: dict[str, str] = {
    "token_count": rf"WITH {LINES} SELECT doc_id, count(*) AS n_blocks, max(page_number) AS n_pages, sum({TOKENS.format('text')})::BIGINT AS n_tokens FROM lines GROUP BY doc_id",
    "word_blocks": rf"""WITH {LINES}, w0 AS (SELECT doc_id, page_number, ord, list_filter(regexp_split_to_array(text, '\s+'), lambda w: length(w) > 0) AS w FROM lines),
        w AS (SELECT doc_id, page_number, ord, unnest(range(1, len(w) + 1)) AS i, w FROM w0)
        SELECT doc_id, page_number, count(*) AS n_words, count(*) AS last_order, arg_max(w[i], (ord, i)) AS last_word FROM w GROUP BY doc_id, page_number""",
    "triage_domain": rf"""WITH {WITH}, t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS t FROM blocks),
        c AS (SELECT doc_id, count(*) FILTER (t IN ('balance', 'invoice', 'revenue', 'tax')) AS f, count(*) FILTER (t IN ('agreement', 'clause', 'contract', 'statute')) AS l,
                     count(*) FILTER (t IN ('architecture', 'api', 'module', 'protocol')) AS e, count(*) FILTER (t IN ('diagnosis', 'patient', 'treatment', 'clinical')) AS m FROM t GROUP BY doc_id)
        SELECT doc_id, CASE WHEN greatest(f, l, e, m) = 0 THEN 'general' WHEN f = greatest(f, l, e, m) THEN 'financial' WHEN l = greatest(f, l, e, m) THEN 'legal' WHEN e = greatest(f, l, e, m) THEN 'technical' ELSE 'medical' END AS domain,
               greatest(f, l, e, m) AS hits FROM c""",
    "language_signal": r"""WITH t AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g'), ' ') AS w FROM documents),
        c AS (SELECT doc_id, len(list_filter(w, lambda x: x IN ('der', 'die', 'das', 'und', 'ein', 'nicht', 'mit', 'sich', 'den', 'von'))) AS de,
                     len(list_filter(w, lambda x: x IN ('the', 'and', 'of', 'to', 'in', 'is', 'that', 'for', 'with', 'are'))) AS en,
                     len(list_filter(w, lambda x: x IN ('el', 'los', 'las', 'del', 'que', 'con', 'por', 'para', 'una', 'al'))) AS es,
                     len(list_filter(w, lambda x: x IN ('le', 'les', 'des', 'et', 'que', 'dans', 'pour', 'est', 'du', 'qui'))) AS fr FROM t)
        SELECT doc_id, CASE WHEN greatest(de, en, es, fr) = 0 THEN 'und' WHEN de = greatest(de, en, es, fr) THEN 'de' WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS code,
               CASE WHEN greatest(de, en, es, fr) = 0 THEN 0.5::DOUBLE ELSE round(greatest(de, en, es, fr) / (de + en + es + fr), 6) END AS confidence FROM c""",
    "page_rollup": rf"""WITH {LINES}, {BOXES}, p AS (
            SELECT doc_id, page_number, count(*) AS n, sum((x1 - x0) / 5)::BIGINT AS chars, count(*) FILTER (c < 0.4::DOUBLE * 612) AS l, count(*) FILTER (c > 0.6::DOUBLE * 612) AS r FROM words GROUP BY doc_id, page_number
        ), bins AS (SELECT doc_id, page_number, floor(x / 10) AS b, count(*) AS k FROM (SELECT doc_id, page_number, unnest([x0, x1]) AS x FROM words) GROUP BY doc_id, page_number, b
        ), rep AS (SELECT doc_id, page_number, avg(CASE WHEN k > 2 THEN 1.0::DOUBLE ELSE 0 END) AS s FROM bins GROUP BY doc_id, page_number
        ), j AS (SELECT *, CASE WHEN l / n >= 0.25::DOUBLE AND r / n >= 0.25::DOUBLE THEN greatest(0, 1 - 2 * ((n - l - r) / n)) ELSE 0 END AS bal FROM p JOIN rep USING (doc_id, page_number))
        SELECT doc_id, count(*) AS pages, sum(chars)::BIGINT AS chars, round(avg(chars / (612 * 792)), 9) AS density, round(max(bal), 6)::DOUBLE AS balance, round(avg(0.45::DOUBLE * s), 6) AS grid FROM j GROUP BY doc_id""",
    "cluster_1d": rf"""WITH {LINES}, {BOXES}, o AS (SELECT doc_id, page_number, list_sort(list(c)) AS cs FROM words GROUP BY doc_id, page_number)
        SELECT doc_id, page_number, list_reduce(list_transform(cs, lambda x: {{'a': x, 'n': 1::BIGINT}}), lambda s, x: CASE WHEN x.a - s.a > 0.12::DOUBLE * 612 THEN {{'a': x.a, 'n': s.n + 1}} ELSE s END).n AS x_clusters FROM o""",
    "origin_class": f"WITH {CLASSED} SELECT doc_id, origin FROM profiled",
    "layout_class": f"WITH {CLASSED} SELECT doc_id, layout FROM profiled",
    "cost_class": f"WITH {CLASSED} SELECT origin, layout, cost, cost <> 'fast_text_sufficient' AS advanced, count(*) AS n FROM profiled GROUP BY origin, layout, cost",
    "initial_strategy": f"WITH {CLASSED} SELECT doc_id, initial, CASE WHEN doc_id % 50 = 0 THEN 'vision' ELSE initial END AS start FROM profiled",
    "fast_confidence": f"WITH {CLASSED} SELECT doc_id, round(c_fast, 6) AS confidence, round(0.001::DOUBLE + 0.0002::DOUBLE * pages, 6) AS fast_cost, round(round((300 + 1200 * pages) / 1000.0::DOUBLE * 0.006::DOUBLE, 8), 6) AS vision_cost FROM profiled",
    "escalation_ladder": f"WITH {ATTEMPTS} SELECT doc_id, attempt, strategy, round(confidence, 6) AS confidence, round(cost, 6) AS cost, round(budget_spent, 6) AS budget_spent, accepted, escalated, error FROM attempts",
    "budget_guard": f"""WITH {ATTEMPTS}, o AS (SELECT doc_id, max(CASE WHEN accepted THEN strategy END) AS strategy, max(error) AS error, max(attempt) AS attempts FROM attempts GROUP BY doc_id)
        SELECT strategy, error, count(*) AS n, sum(attempts)::BIGINT AS attempts FROM o GROUP BY strategy, error""",
    "cell_matrix": r"""WITH c AS (SELECT l_orderkey AS table_id, l_linenumber AS row, (l_suppkey % 5)::INTEGER AS col, max(l_returnflag || l_linestatus) AS text FROM lineitem GROUP BY ALL),
        w AS (SELECT table_id, row, max(col) AS width, list(col) AS cols, list(text) AS texts FROM c GROUP BY table_id, row)
        SELECT table_id, row, row = 0 AS is_header, array_to_string(list_transform(range(width + 1), lambda k: coalesce(texts[list_position(cols, k::INTEGER)], '')), '|') AS cells FROM w""",
    "items_sorted": f"WITH {WITH}, {ITEMS} SELECT doc_id, ord, block_id, role FROM items",
    "active_section": f"WITH {WITH}, {ITEMS} SELECT doc_id, block_id, section FROM items",
    "text_runs": f"WITH {WITH}, {ITEMS} SELECT doc_id, run, count(*) AS n, any_value(role) AS role FROM runs GROUP BY doc_id, run",
    "greedy_chunks": rf"""WITH RECURSIVE {LINES}, m AS (SELECT doc_id, ord, {TOKENS.format('text')} AS t, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM lines),
        p AS (SELECT doc_id, ord, k, t, t AS held, 1 AS part FROM m WHERE k = 1 UNION ALL
              SELECT m.doc_id, m.ord, m.k, m.t, CASE WHEN p.held + m.t > 200 THEN m.t ELSE p.held + m.t END, CASE WHEN p.held + m.t > 200 THEN p.part + 1 ELSE p.part END FROM p JOIN m ON m.doc_id = p.doc_id AND m.k = p.k + 1)
        SELECT doc_id, part::BIGINT AS part, min(ord) AS start, sum(t)::BIGINT AS tokens FROM p GROUP BY doc_id, part""",
    "table_segments": f"WITH {WITH}, {table_parts(5)} SELECT doc_id, part, parts, row_count, sha256(content) AS content_hash FROM table_parts",
    "list_segments": f"WITH RECURSIVE {WITH}, {ITEMS}, {packs(200, 60)} SELECT doc_id, part, parts::INTEGER AS parts, n_blocks::INTEGER AS n_blocks, pages, sha256(content) AS content_hash FROM packed_parts WHERE role = 'numbered'",
    "chunks": f"WITH RECURSIVE {CHUNKS} SELECT doc_id, chunk_id, chunk_type, pages, section, tokens, label, content_hash FROM made",
    "structural_edges": f"WITH RECURSIVE {EDGES} SELECT doc_id, chunk_id, edge_type, target, label FROM structural",
    "reference_edges": f"WITH RECURSIVE {EDGES} SELECT edge_id, doc_id, chunk_id, edge_type, target, label, resolved FROM refs",
    "validator_violations": f"WITH RECURSIVE {BROKEN} SELECT doc_id, n, code FROM broken",
    "document_errors": f"WITH RECURSIVE {BROKEN} SELECT doc_id, arg_min(code, (n, rule)) AS error FROM broken GROUP BY doc_id",
    "dangling_edges": rf"""WITH RECURSIVE {EDGES}, kept AS (SELECT doc_id, chunk_id FROM made WHERE NOT (regexp_extract(doc_id, '(\d+)$', 1)::BIGINT % 5 = 0 AND list_contains(string_split(pages, ','), '2')))
        SELECT edge_type, count(*) AS n FROM edges e WHERE resolved AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.doc_id = e.doc_id AND k.chunk_id = e.target) GROUP BY edge_type""",
    "section_tree": f"WITH RECURSIVE {SECTIONS} SELECT doc_id, section_id, parent_id, title, path, depth::BIGINT AS depth FROM sections",
    "section_ranges": f"WITH RECURSIVE {SECTIONS} SELECT doc_id, path, min(page) AS page_start, max(page) AS page_end, count(*) AS n_chunks, count(*) FILTER (direct) AS n_direct FROM members GROUP BY doc_id, path",
    "section_chunks": f"WITH RECURSIVE {SECTIONS} SELECT doc_id, section_id, string_agg(chunk_id, ',' ORDER BY sort_path, n) AS chunk_ids FROM members GROUP BY doc_id, section_id",
    "key_entities": f"WITH RECURSIVE {ENTITIES} SELECT doc_id, section_id, rank, entity, score FROM entities",
    "data_types": f"WITH RECURSIVE {SECTIONS} SELECT doc_id, section_id, array_to_string(list_sort(list(DISTINCT {TYPE})), ',') AS data_types FROM members GROUP BY doc_id, section_id",
    "section_summaries": rf"""WITH RECURSIVE {SECTIONS}{SUMMARIES} SELECT doc_id, section_id, summary, n_sources,
        len(list_filter(regexp_split_to_array(summary, '[.?]'), lambda s: length(trim(s)) > 0)) BETWEEN 2 AND 3 AS fits FROM summaries""",
    "central_summaries": rf"""WITH RECURSIVE {SECTIONS}{SUMMARIES}, told AS (
            SELECT doc_id, section_id, k, chunk_id, unnest(x) AS sentence, generate_subscripts(x, 1) AS pl
            FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(replace(content, chr(10), '. '), '[.?]'), lambda s: trim(s)), lambda s: length(s) > 0) AS x FROM first_chunks)
        ), once AS (SELECT doc_id, section_id, sentence, min((k, pl, chunk_id)) AS p, any_value({TERMS.format("sentence")}) AS t FROM told GROUP BY doc_id, section_id, sentence
        ), s AS (SELECT *, p[3] AS chunk_id, row_number() OVER (PARTITION BY doc_id, section_id ORDER BY p) AS i FROM once
        ), j AS (SELECT a.doc_id, a.section_id, a.i, b.i AS o, len(list_intersect(a.t, b.t))::BIGINT AS n FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.section_id = b.section_id AND a.i <> b.i
        ), w1 AS (SELECT doc_id, section_id, i, sum(n) AS w FROM j GROUP BY ALL
        ), w2 AS (SELECT j.doc_id, j.section_id, j.i, sum(n * w) AS w FROM j JOIN w1 ON w1.doc_id = j.doc_id AND w1.section_id = j.section_id AND w1.i = j.o GROUP BY ALL
        ), w3 AS (SELECT j.doc_id, j.section_id, j.i, sum(n * w) AS w FROM j JOIN w2 ON w2.doc_id = j.doc_id AND w2.section_id = j.section_id AND w2.i = j.o GROUP BY ALL
        ), best AS (SELECT s.doc_id, s.section_id, s.i, sentence, chunk_id, row_number() OVER (PARTITION BY s.doc_id, s.section_id ORDER BY coalesce(w, 0) DESC, s.i) AS r FROM s LEFT JOIN w3 ON w3.doc_id = s.doc_id AND w3.section_id = s.section_id AND w3.i = s.i QUALIFY r <= 3
        ), chunk AS (SELECT doc_id, section_id, chunk_id, min(i) AS i FROM best GROUP BY ALL
        ), sources AS (SELECT doc_id, section_id, string_agg(chunk_id, ',' ORDER BY i) AS sources FROM chunk GROUP BY ALL)
        SELECT doc_id, section_id, string_agg(sentence, '. ' ORDER BY i) AS summary, any_value(sources) AS sources FROM best JOIN sources USING (doc_id, section_id) GROUP BY doc_id, section_id""",
    "kv_facts": f"WITH RECURSIVE {FACTS} SELECT {FACT_COLUMNS} FROM facts WHERE rank = 1",
    "table_facts": f"WITH RECURSIVE {FACTS} SELECT {FACT_COLUMNS} FROM facts WHERE rank = 2",
    "inline_facts": f"WITH RECURSIVE {FACTS} SELECT {FACT_COLUMNS} FROM facts WHERE rank = 3",
    "facts_dedup": f"WITH RECURSIVE {FACTS} SELECT doc_id, count(*) AS n, sum(numeric_value) AS total, min(fact_id) AS first_id FROM one GROUP BY doc_id",
    "fact_store": rf"WITH RECURSIVE {FACTS} SELECT value_type, count(*) AS n, count(DISTINCT fact_id) AS n_ids FROM one WHERE regexp_extract(doc_id, '(\d+)$', 1)::BIGINT % 50 <> 1 GROUP BY value_type",
    "navigate": f"""WITH RECURSIVE {INDEX}, best AS (SELECT *, (4 * ia + 2 * ib + ic + id)::DOUBLE AS score FROM pairs WHERE 4 * ia + 2 * ib + ic + id > 0
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_start, title, section_id) <= 5)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_start, title, section_id) AS rank, title, score,
               array_to_string(list_sort(list_intersect(t, list_distinct(a || b || c || d))), ',') AS matched FROM best""",
    "rank_sections": f"""WITH RECURSIVE {INDEX}, best AS (SELECT *, (3 * ia + 2 * ib + ic)::DOUBLE AS score FROM pairs)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_start, title, section_id) AS rank, title, score,
               array_to_string(list_sort(list_intersect(t, list_distinct(a || b || c))), ',') AS matched FROM best QUALIFY rank <= 5""",
    "structured_query": f"""WITH RECURSIVE {FACTS}, asked AS (
            SELECT k AS request_id, doc_id, [['revenue'], ['account', 'balance'], ['market', 'segment'], ['order', 'date', '2001']][k % 4 + 1] AS ts FROM accounts
        ), terms AS (SELECT request_id, doc_id, unnest(ts) AS t FROM asked
        ), points AS (
            SELECT request_id, fact_id, any_value(page_number) AS page_number, any_value(fact_value) AS fact_value,
                   sum((normalized_name = t)::INT * 4 + contains(normalized_name, t)::INT * 2 + contains(lower(name), t)::INT + contains(lower(fact_value), t)::INT)::BIGINT AS score
            FROM terms JOIN one USING (doc_id) GROUP BY request_id, fact_id HAVING score > 0)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_number, fact_id) AS rank, fact_id, score, fact_value FROM points QUALIFY rank <= 5""",
    "provenance": f"""WITH RECURSIVE {FACTS}, asked AS (
            SELECT k AS request_id, doc_id, [['revenue'], ['account', 'balance'], ['market', 'segment'], ['order', 'date', '2001']][k % 4 + 1] AS ts FROM accounts
        ), terms AS (SELECT request_id, doc_id, unnest(ts) AS t FROM asked
        ), points AS (
            SELECT request_id, fact_id, any_value(page_number) AS page_number, any_value(chunk_id) AS chunk_id,
                   sum((normalized_name = t)::INT * 4 + contains(normalized_name, t)::INT * 2 + contains(lower(name), t)::INT + contains(lower(fact_value), t)::INT) AS score
            FROM terms JOIN one USING (doc_id) GROUP BY request_id, fact_id HAVING score > 0
        ), hits AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, page_number, fact_id) AS rank FROM points QUALIFY rank <= 5
        ), sums AS (SELECT request_id, count(*) + count(DISTINCT chunk_id) AS n_evidence, count(*) AS n_facts, arg_min(chunk_id, rank) AS first_evidence FROM hits GROUP BY request_id)
        SELECT k AS request_id, CASE WHEN n_facts > 0 THEN 'supported' ELSE 'not_found' END AS status, coalesce(n_evidence, 0) AS n_evidence, coalesce(n_facts, 0) AS n_facts, first_evidence
        FROM accounts LEFT JOIN sums ON sums.request_id = k""",
    "semantic_topk": """WITH q AS (SELECT vec_id AS request_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0),
        s AS (SELECT request_id, e.vec_id, 1 - list_cosine_similarity(e.embedding::DOUBLE[], q) AS d FROM embeddings e, q)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY d, vec_id) AS rank, vec_id, round(1 / (1 + d), 6) AS score FROM s QUALIFY rank <= 15""",
    "semantic_section_filter": """WITH q AS (SELECT vec_id AS request_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 20 = 0),
        s AS (SELECT request_id, e.vec_id, 1 - list_cosine_similarity(e.embedding::DOUBLE[], q) AS d FROM embeddings e, q WHERE label % 2 = 0)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY d, vec_id) AS rank, vec_id, round(1 / (1 + d), 6) AS score FROM s QUALIFY rank <= 5""",
    "route_queries": r"""SELECT conv_id, turn, CASE WHEN regexp_matches(coalesce(text, ''), '(?i)\b(revenue|amount|total|balance|ratio|margin|date|period|invoice|expense|expenditure|profit|tax|fiscal)\b')
        OR regexp_matches(coalesce(text, ''), '[0-9]') THEN 'structured_query' ELSE 'pageindex_navigate' END AS path FROM conversations WHERE role = 'user'""",
    "audit_claims": r"""WITH c AS (SELECT item_id, trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) AS t FROM benchmark),
        d AS (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) AS t FROM documents),
        h AS (SELECT item_id, count(*) AS n, min(doc_id) AS f FROM c JOIN d ON contains(' ' || d.t || ' ', ' ' || c.t || ' ') WHERE c.t <> '' GROUP BY item_id)
        SELECT item_id AS claim_id, coalesce(n, 0) AS n_docs, f AS first_doc, CASE WHEN n > 0 THEN 'supported' ELSE 'not_found' END AS status FROM benchmark LEFT JOIN h USING (item_id)""",
    "html_payload": r"""WITH c AS (SELECT page_id, regexp_replace(coalesce(html, ''), '<(?:style|script)[^>]*>(?:.|\n)*?</(?:style|script)>', '', 'g') AS h FROM pages),
        b AS (
            SELECT page_id, 'title' AS block_type, unnest(regexp_extract_all(h, '<title(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)', 1)) AS raw FROM c
            UNION ALL SELECT page_id, 'heading', unnest(regexp_extract_all(h, '<h1(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)', 1)) FROM c
            UNION ALL SELECT page_id, 'list_item', unnest(regexp_extract_all(h, '<li(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)', 1)) FROM c
            UNION ALL SELECT page_id, 'paragraph', unnest(regexp_extract_all(h, '<p(?: [^>]*)?>([^<]*(?:</?(?:a|b|br|em|i)(?: [^>]*)?>[^<]*)*)', 1)) FROM c
        ), t AS (SELECT page_id, block_type, trim(replace(replace(replace(replace(replace(regexp_replace(raw, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), ' ') AS x FROM b)
        SELECT page_id, block_type, count(*) AS n, sum(length(x))::BIGINT AS chars FROM t WHERE length(x) > 0 GROUP BY page_id, block_type""",
    "provider_payload": rf"""WITH {HTML}, d AS (SELECT *, page_id % 3 AS kind, pos // 10 + 1 AS page FROM h WHERE page_id % 11 <> 0 AND NOT (page_id % 3 = 1 AND pos % 3 = 0)),
        n AS (SELECT page_id, pos, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS idx FROM h)
        SELECT page_id, idx::INTEGER AS idx, CASE WHEN kind = 0 THEN 'b' || pos ELSE 'ltb-' || page || '-' || idx END AS item_id, page::INTEGER AS page_number,
               CASE kind WHEN 0 THEN printf('%.1f,1.5,%.1f,3.0', pos::DOUBLE, (pos + 9)::DOUBLE) WHEN 1 THEN printf('%.1f,2.0,1.0,1.0', pos::DOUBLE) ELSE printf('%.1f,2.0,4.0,8.0', pos::DOUBLE) END AS box,
               CASE WHEN kind = 0 AND pos > 0 THEN pos ELSE idx END::INTEGER AS reading_order, CASE WHEN kind = 0 THEN block_type ELSE 'paragraph' END AS block_type, sha256(x) AS content_hash, CASE WHEN kind = 0 THEN 0.7 ELSE 0.9 END::DOUBLE AS confidence
        FROM d JOIN n USING (page_id, pos)""",
    "payload_documents": rf"""WITH {HTML} SELECT page_id, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 3 = 0 THEN count(*) WHEN page_id % 3 = 1 THEN 4 ELSE 2 END::INTEGER AS page_count,
        CASE WHEN page_id % 11 = 0 THEN 'layout_provider_conversion_failed' END AS error FROM h GROUP BY page_id""",
    "layout_pages": rf"""WITH {HTML} SELECT page_id, pos::INTEGER AS pos, block_type, x AS text, 0.9::DOUBLE AS confidence FROM h""",
    "payload_tables": r"""WITH e AS (SELECT user_id, day(ts) AS day, event_id, event_type || '|' || coalesce(props ->> '$.k', '') ||
            CASE WHEN value > 5 THEN '|' || event_id WHEN user_id % 2 = 0 THEN '|' ELSE '' END AS line FROM events)
        SELECT user_id || '-' || day AS doc_id, 'tbl-1-0' AS item_id, CASE WHEN user_id % 2 = 1 THEN 'events' END AS caption, 'type|k' AS headers, count(*) AS n_rows,
               sha256('type|k' || chr(10) || string_agg(line, chr(10) ORDER BY event_id)) AS content_hash FROM e GROUP BY user_id, day""",
    "upsert_vectors": "SELECT label, version, count(*) AS n FROM (SELECT label, unnest(CASE WHEN label % 2 = 1 THEN [3, 4] ELSE [1] END) AS version FROM embeddings) GROUP BY label, version",
    "ledger_summary": f"WITH {ATTEMPTS} SELECT strategy, accepted, count(*) AS n, round(sum(cost), 4) AS cost FROM attempts GROUP BY strategy, accepted",
    "language_posterior": r"""WITH w AS (SELECT doc_id, lang, unnest(list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g'), ' '), lambda x: x <> '')) AS word FROM documents),
        c AS (SELECT doc_id, any_value(lang) AS lang, word, count(*) AS n FROM w GROUP BY doc_id, word),
        g AS (SELECT doc_id, any_value(lang) AS lang, gram, sum(n) AS n FROM (SELECT doc_id, lang, n, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) AS gram FROM c) GROUP BY doc_id, gram),
        p AS (SELECT lang, gram, sum(n) AS n FROM g WHERE doc_id % 5 <> 0 AND lang IS NOT NULL GROUP BY lang, gram),
        u AS (SELECT lang, ln(sum(n) + (SELECT count(DISTINCT gram) + 1 FROM p)) AS unseen FROM p GROUP BY lang),
        s AS (SELECT g.doc_id, p.lang, sum(g.n * ln(p.n + 1)) AS gain FROM g JOIN p ON p.gram = g.gram GROUP BY g.doc_id, p.lang),
        t AS (SELECT doc_id, sum(n) AS total FROM g GROUP BY doc_id),
        l AS (SELECT doc_id, lang, gain - total * unseen AS score FROM s JOIN t USING (doc_id) JOIN u USING (lang)),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS k, exp(score - max(score) OVER (PARTITION BY doc_id)) AS p FROM l),
        f AS (SELECT doc_id, max(lang) FILTER (k = 1) AS code, 1 / sum(p) AS confidence FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(code, 'und') AS code, round(coalesce(confidence, 0.5), 4) AS confidence FROM documents LEFT JOIN f USING (doc_id)""",
    "ldu_cache": rf"""WITH RECURSIVE {CHUNKS}, kept AS (SELECT doc_id, regexp_extract(doc_id, '(\d+)$', 1)::BIGINT % 50 <> 10 AS there FROM accounts)
        SELECT doc_id, chunk_id, content_hash, NULL AS error FROM made JOIN kept USING (doc_id) WHERE there UNION ALL
        SELECT doc_id, NULL, NULL, 'missing_ldu_cache' FROM kept WHERE NOT there""",
    "page_index_store": rf"""WITH RECURSIVE {SECTIONS}, kept AS (SELECT doc_id, regexp_extract(doc_id, '(\d+)$', 1)::BIGINT % 50 <> 10 AS there FROM accounts)
        SELECT doc_id, section_id, parent_id, title, NULL AS error FROM sections JOIN kept USING (doc_id) WHERE there UNION ALL
        SELECT doc_id, NULL, NULL, NULL, 'missing_page_index' FROM kept WHERE NOT there""",
    "section_json": f"""WITH RECURSIVE {SECTIONS}, leaves AS (
            SELECT parent_id, string_agg('{{"section_id":"' || section_id || '","title":"' || title || '","path":"' || path || '","child_sections":[]}}', ',' ORDER BY sort_path) AS j FROM sections WHERE depth = 2 GROUP BY parent_id)
        SELECT doc_id, '[' || string_agg('{{"section_id":"' || section_id || '","title":"' || title || '","path":"' || path || '","child_sections":[' || coalesce(j, '') || ']}}', ',' ORDER BY sort_path) || ']' AS tree
        FROM sections s LEFT JOIN leaves l ON l.parent_id = s.section_id WHERE depth = 1 GROUP BY doc_id""",
    "chunking_ledger": f"""WITH RECURSIVE {BROKEN}, e AS (SELECT doc_id, arg_min(code, (n, rule)) AS error FROM broken GROUP BY doc_id), c AS (SELECT doc_id, count(*) AS chunks FROM made GROUP BY doc_id), r AS (SELECT doc_id, count(*) AS relationships FROM edges GROUP BY doc_id)
        SELECT CASE WHEN error IS NULL THEN 'validated' ELSE 'failed_closed' END AS status, error, count(*) AS n, sum(chunks)::BIGINT AS chunks, sum(relationships)::BIGINT AS relationships FROM accounts LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN e USING (doc_id) GROUP BY ALL""",
    "answers": f"WITH RECURSIVE {ANSWERS} SELECT request_id, status, answer, path, matched_section_ids, matched_fact_ids, n_provenance FROM answers",
    "result_invariants": f"""WITH RECURSIVE {ANSWERS}, broken AS (
            SELECT unnest(list_filter([CASE WHEN request_id % 10 = 0 THEN 'supported_without_provenance' END, CASE WHEN request_id % 14 = 0 THEN 'path_empty' END,
                   CASE WHEN request_id % 14 <> 0 AND request_id % 9 = 0 THEN 'path_not_unique' END, CASE WHEN request_id % 12 = 0 THEN 'explanation_missing' END], lambda x: x IS NOT NULL)) AS code FROM answers)
        SELECT code, count(*) AS n FROM broken GROUP BY code""",
    "audit_facts": f"""WITH RECURSIVE {FACTS}, asked AS (SELECT k AS request_id, doc_id, CASE WHEN k % 5 = 0 THEN ['zzz'] ELSE ['account', 'balance'] END AS ts FROM accounts), {LOOKUPS}, j AS (
            SELECT a.k AS request_id, count(l.fact_id) AS n, count(*) FILTER (contains(lower('The balance is USD ' || (balance + a.k % 2)::VARCHAR), lower(fact_value))) AS c
            FROM accounts a LEFT JOIN looked l ON l.request_id = a.k AND l.k <= 6 GROUP BY a.k)
        SELECT request_id, CASE WHEN n = 0 THEN 'not_found' WHEN c > 0 THEN 'supported' ELSE 'unverifiable' END AS status,
               CASE WHEN n = 0 THEN 'No evidence was found for this claim.' WHEN c > 0 THEN 'Facts of the document state this claim.' ELSE 'The facts that were found do not state this claim.' END AS explanation, c AS n_citations FROM j""",
    "vector_ingest": f"WITH RECURSIVE {SECTIONS}, {VECTORS} SELECT vec_id, array_to_string(list_transform(e, lambda x: x::INTEGER), ',') AS embedding, section_id, section_title, page_number, page_refs, bounding_box, chunk_type, content_hash FROM vectors",
    "chunk_search": f"""WITH RECURSIVE {SECTIONS}, {VECTORS}, near AS (
            SELECT k AS request_id, v.*, round(1 - list_cosine_similarity(v.e, {EMBEDDING.format(f"{list(QUESTIONS)}[k % 4 + 1]")}), 9) AS d FROM accounts a JOIN vectors v ON v.doc_id = a.doc_id WHERE k % 20 = 0)
        SELECT request_id, row_number() OVER (PARTITION BY request_id ORDER BY d, page_number, vec_id) AS rank, vec_id AS chunk_id, nullif(section_id, '') AS section_id, round(1 / (1 + d), 6) AS score FROM near QUALIFY rank <= 5""",
    "fact_rows": f"""WITH RECURSIVE {SECTIONS}, {FACTS_TAIL} SELECT fact_id, o.doc_id AS document_name, s.section_id, m.box AS bounding_box, 0.0::DOUBLE AS score FROM one o JOIN made m ON m.doc_id = o.doc_id AND m.chunk_id = o.chunk_id
        LEFT JOIN sections s ON s.doc_id = o.doc_id AND s.title = coalesce(m.section, 'Document') AND (m.section IS NOT NULL OR NOT EXISTS (SELECT 1 FROM heads0 h WHERE h.doc_id = o.doc_id))""",
    "summary_sources": f"""WITH RECURSIVE {SECTIONS} SELECT doc_id, section_id, coalesce(string_agg(chunk_id, ',' ORDER BY sort_path, n) FILTER (contains(chunk_id, '-table')), string_agg(chunk_id, ',' ORDER BY sort_path, n)) AS sources FROM members GROUP BY doc_id, section_id""",
    "index_invariants": f"""WITH RECURSIVE {EDGES}, {SECTIONS[len(CHUNKS) + 2:]}, s AS (
            SELECT section_id, doc_id, any_value(regexp_extract(doc_id, '(\\d+)$', 1)::BIGINT) AS k, min(page) AS p, max(page) AS q FROM members GROUP BY section_id, doc_id
        ), codes AS (
            SELECT CASE WHEN k % 19 = 0 THEN 'page_order' END AS code FROM s UNION ALL SELECT CASE WHEN k % 7 = 0 THEN 'data_types_not_unique' WHEN k % 23 = 0 THEN 'data_types_not_supported' END FROM s
            UNION ALL SELECT 'parent_missing' FROM sections WHERE parent_id IS NOT NULL AND regexp_extract(doc_id, '(\\d+)$', 1)::BIGINT % 29 = 0
            UNION ALL SELECT DISTINCT ON (doc_id) CASE WHEN k % 31 = 0 THEN 'section_count' END FROM s
            UNION ALL SELECT CASE WHEN resolved THEN CASE WHEN regexp_extract(doc_id, '(\\d+)$', 1)::BIGINT % 37 = 0 THEN 'resolved_without_target' END WHEN regexp_extract(doc_id, '(\\d+)$', 1)::BIGINT % 41 = 0 THEN 'unresolved_without_label' END FROM edges)
        SELECT code, count(*) AS n FROM codes WHERE code IS NOT NULL GROUP BY code""",
    "stage_errors": f"""WITH {WITH}, e AS (
            SELECT 'missing_extracted_document' AS error FROM accounts WHERE k % 9 = 0 UNION ALL SELECT 'missing_chunked_document' FROM accounts WHERE k % 12 = 0
            UNION ALL SELECT 'mixed_document_ids' FROM accounts WHERE k % 12 <> 0 AND k % 15 = 0 UNION ALL SELECT 'missing_query_request' FROM accounts WHERE k % 8 = 0)
        SELECT error, count(*) AS n FROM e GROUP BY error""",
    "page_signals": """WITH m AS (
            SELECT l_orderkey AS doc_id, least(1, sum(abs(l_linenumber * 20.0::DOUBLE) * abs(l_discount * 1000)) / (612.0::DOUBLE * 792)) AS i, count(*) FILTER (l_linenumber % 2 = 0 AND l_tax * 1000 > 5) AS v, count(*) FILTER (l_linenumber % 2 = 1 AND l_quantity > 5) AS h,
                   sum(l_quantity::BIGINT) AS w, least(1, count(*) FILTER (l_returnflag = 'R') / 2) AS t FROM lineitem GROUP BY l_orderkey
        ), e AS (SELECT *, least(1, least(v, h) / greatest(1, w // 5)) AS e FROM m)
        SELECT doc_id, round(i, 6) AS image_ratio, round(e, 6) AS edge_density, t AS table_score, round(0.45::DOUBLE * 0.5::DOUBLE + 0.3::DOUBLE * e + 0.25::DOUBLE * t, 6) AS grid FROM e""",
    "payload_rules": """WITH g AS (
            SELECT l_orderkey AS k, count(*) AS lines, string_agg(l_returnflag || '|' || l_linenumber::VARCHAR, chr(10) ORDER BY l_linenumber, l_returnflag) AS body FROM lineitem GROUP BY l_orderkey
        ), t AS (SELECT *, k % 5 <> 0 OR k % 7 <> 0 AS has FROM g)
        SELECT k AS doc_id, (CASE WHEN k % 3 = 0 THEN 3 WHEN k % 4 = 0 THEN 7 WHEN k % 5 < 3 THEN lines ELSE 1 END)::INTEGER AS page_count, CASE WHEN k % 2 = 0 THEN k::DOUBLE ELSE 1.5::DOUBLE END AS number,
               CASE WHEN has THEN sha256(CASE WHEN k % 5 <> 0 THEN 'flag|line' ELSE '' END || chr(10) || CASE WHEN k % 7 <> 0 THEN body ELSE '' END) END AS content_hash,
               k % 2 = 0 AND NOT has AND k % 3 <> 0 AND k % 11 <> 0 AS retry FROM t""",
    "bound_invariants": f"""WITH {ATTEMPTS}, {LANGUAGES}, codes AS (
            SELECT CASE WHEN doc_id % 40 = 0 THEN 'language_code' END AS c FROM signals UNION ALL SELECT CASE WHEN doc_id % 50 = 0 THEN 'language_confidence' END FROM signals
            UNION ALL SELECT CASE WHEN doc_id % 33 = 0 THEN 'attempt_index' END FROM attempts UNION ALL SELECT CASE WHEN doc_id % 21 = 0 THEN 'attempt_strategy' END FROM attempts
            UNION ALL SELECT CASE WHEN doc_id % 44 = 0 THEN 'attempt_confidence' END FROM attempts UNION ALL SELECT CASE WHEN doc_id % 55 = 0 THEN 'attempt_cost' END FROM attempts)
        SELECT c AS code, count(*) AS n FROM codes WHERE c IS NOT NULL GROUP BY c""",
    "profile_store": f"""WITH {LINES}, {BOXES}, {PAGES}, d AS (
            SELECT doc_id, sum(chars)::BIGINT AS chars, avg(chars / (612 * 792)) AS density, max(bal) AS balance, avg(0.45::DOUBLE * s) AS grid FROM j GROUP BY doc_id
        ), {CLUSTERS}, x AS (SELECT doc_id, max(x_clusters) AS x FROM clusters GROUP BY doc_id), {LANGUAGES}, {DOMAINS.format("documents")}, p AS (
            SELECT *, CASE WHEN density >= 0.002::DOUBLE THEN 'native_digital' WHEN density <= 0.0003::DOUBLE THEN 'scanned_image' ELSE 'native_digital' END AS origin, (x >= 2 OR balance >= 0.55::DOUBLE) AS cols, grid >= 0.35::DOUBLE AS tab
            FROM d JOIN x USING (doc_id) JOIN signals USING (doc_id) JOIN domains USING (doc_id)
        ), l AS (SELECT *, CASE WHEN cols AND tab THEN 'mixed' WHEN tab THEN 'table_heavy' WHEN cols THEN 'multi_column' ELSE 'single_column' END AS layout FROM p)
        SELECT origin, layout, CASE WHEN origin = 'scanned_image' THEN 'needs_vision_model' WHEN layout <> 'single_column' THEN 'needs_layout_model' ELSE 'fast_text_sufficient' END AS cost, code AS language, domain,
               count(*) AS profiles, sum(chars)::BIGINT AS chars, (count(*) + count(*) FILTER (doc_id % 3 = 0))::BIGINT AS entries FROM l GROUP BY ALL""",
    "ledger_stream_window": "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS entries, round(sum(value), 2) AS total FROM events GROUP BY ALL",
    "ledger_latest": "SELECT user_id, arg_max(event_id, (ts, event_id)) AS latest, count(*) AS n FROM events GROUP BY user_id",
}
#: The stream makes the attempts of the ladder; the tools find what the operators find.
ORACLE_SQL |= {"escalation_stream": ORACLE_SQL["escalation_ladder"], "tool_navigate": ORACLE_SQL["navigate"], "indexed_query": ORACLE_SQL["structured_query"], "tool_structured_query": ORACLE_SQL["structured_query"], "tool_semantic_search": ORACLE_SQL["chunk_search"]}
