"""SQL equivalents of ``checks.queries`` for DuckDB, written from the definitions.

Scores here count words in the whole normalised texts and boolean queries are
spelled out per document, so nothing is shared with the Spark plans.
"""

from __future__ import annotations

from acervo.functions.text import stopwords


def _stop_list() -> str:
    """The Spanish stop words as an SQL list."""
    return "[" + ", ".join(f"'{word}'" for word in stopwords()) + "]"


WS = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

TEXTS = """texts AS (
  SELECT doc_id, 'https://' || source || '.example/doc/' || doc_id || '.txt.pdf' AS url,
         doc_id || '.txt' AS title, text
  FROM documents)"""

TOKENS = f"""{TEXTS},
toks AS (
  SELECT doc_id, url, title, text,
    list_filter(string_split_regex(lower(regexp_replace(regexp_replace(text, '[\\n\\t\\r]', ' ', 'g'),
        '[<>¿?,;:.()\\[\\]"''¡!]', '', 'g')), '{WS}'),
      lambda w: w <> '' AND NOT list_contains({_stop_list()}, w)) AS tokens
  FROM texts),
norm_docs AS (SELECT doc_id, url, title, text, tokens, array_to_string(tokens, ' ') AS nt FROM toks),
terms AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS term FROM toks) GROUP BY doc_id, term),
norms AS (
  SELECT d.doc_id, sqrt(CAST(coalesce(sum(t.tf * t.tf), 0) AS DOUBLE)) AS norm
  FROM texts d LEFT JOIN terms t ON d.doc_id = t.doc_id GROUP BY d.doc_id)"""

SNIPPET = "substring(text, 1, 120) || '...'"


def _with(sql: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{TOKENS} {sql}"


def _has(word: str) -> str:
    return f"EXISTS (SELECT 1 FROM terms t WHERE t.doc_id = d.doc_id AND t.term = '{word}')"


def _matching(condition: str) -> str:
    return _with(f"SELECT d.doc_id FROM texts d WHERE {condition}")


def _scored(lines: list[tuple[int, str, list[str], str]]) -> str:
    """CTEs giving ``scored(query_id, doc_id, query_tf, squares, score, is_match)``."""
    words = ", ".join(
        f"({query_id}, '{word}', {words.count(word)})"
        for query_id, _, words, _ in lines
        for word in dict.fromkeys(words)
    )
    names = ", ".join(f"({query_id}, '{canon}')" for query_id, canon, _, _ in lines)
    truths = " UNION ALL ".join(
        f"SELECT {query_id} AS query_id, doc_id, {condition} AS is_match FROM norm_docs"
        for query_id, _, _, condition in lines
    )
    return f"""{TOKENS},
qw(query_id, w, m) AS (VALUES {words}),
qn(query_id, query) AS (VALUES {names}),
truths AS ({truths}),
counted AS (
  SELECT q.query_id, d.doc_id,
    sum(q.m * ((length(nt) - length(replace(nt, lower(w), ''))) // length(w))) AS query_tf,
    sum(CASE WHEN contains(nt, w) THEN q.m * q.m ELSE 0 END) AS squares
  FROM norm_docs d, qw q GROUP BY q.query_id, d.doc_id),
scored AS (
  SELECT c.query_id, c.doc_id, CAST(query_tf AS BIGINT) AS query_tf, squares, is_match,
    CASE WHEN squares > 0 THEN CAST(query_tf AS DOUBLE) / (norm * sqrt(CAST(squares AS DOUBLE)))
      ELSE 0.0::DOUBLE END AS score
  FROM counted c JOIN norms n ON c.doc_id = n.doc_id
  JOIN truths t ON t.query_id = c.query_id AND t.doc_id = c.doc_id)"""


def _search(lines: list[tuple[int, str, list[str], str]], n: int, batch: bool) -> str:
    head = "CAST(r.query_id AS BIGINT) AS query_id, q.query, " if batch else ""
    return f"""WITH {_scored(lines)},
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE is_match)
SELECT {head}r.rank, r.doc_id, d.url, {SNIPPET} AS snippet, r.score
FROM ranked r JOIN texts d ON r.doc_id = d.doc_id JOIN qn q ON q.query_id = r.query_id
WHERE r.rank <= {n}"""


def _in(word: str) -> str:
    return f"list_contains(tokens, '{word}')"


SCORE = (
    0,
    "",
    ["tion", "mente", "ing", "ado", "Tion", "tion"],
    f"((({_in('tion')} OR {_in('mente')}) AND NOT ({_in('ing')} AND {_in('ado')})) OR {_in('Tion')}) OR {_in('tion')}",
)
MIXED = (
    1,
    "((mente AND NOT ado) OR tion)",
    ["mente", "ado", "tion"],
    f"({_in('mente')} AND NOT {_in('ado')}) OR {_in('tion')}",
)
BATCH = [
    MIXED,
    (2, "ado", ["ado"], _in("ado")),
    (
        3,
        "((tion OR mente) AND NOT (ing AND ado))",
        ["tion", "mente", "ing", "ado"],
        f"({_in('tion')} OR {_in('mente')}) AND NOT ({_in('ing')} AND {_in('ado')})",
    ),
    (4, "NOT the", ["the"], f"NOT {_in('the')}"),
    (5, "(Tion OR tion)", ["Tion", "tion"], f"{_in('Tion')} OR {_in('tion')}"),
    (6, "NOT ing", ["ing"], f"NOT {_in('ing')}"),
    (8, "(NOT zzzz AND NOT qqqq)", ["zzzz", "qqqq"], f"NOT {_in('zzzz')} AND NOT {_in('qqqq')}"),
]

LINES = r"""flat AS (
  SELECT conv_id * 1000 + turn AS query_id, turn,
    replace(replace(text, chr(10), ' '), ' ', CASE WHEN role = 'assistant' THEN ' OR ' ELSE ' ' END) AS body
  FROM conversations),
bodies AS (
  SELECT query_id, turn,
    regexp_replace(regexp_replace(regexp_replace(body, '[,;:]( OR)? +', ' AND ', 'g'),
      '[.?!]( OR)? +', ') OR NOT (', 'g'), '[.?!]+$', '') AS body
  FROM flat),
lines AS (
  SELECT query_id, CASE turn WHEN 0 THEN body WHEN 3 THEN '(' || body
    ELSE '(' || body || ')' END AS line
  FROM bodies),
qtoks AS (SELECT query_id, line, regexp_extract_all(line, '[()]|[^ \t\n()]+') AS tokens FROM lines),
kinds AS (
  SELECT query_id, line, tokens, coalesce(array_to_string(list_transform(tokens, lambda t:
    CASE t WHEN 'AND' THEN 'A' WHEN 'OR' THEN 'O' WHEN 'NOT' THEN 'N'
           WHEN '(' THEN 'L' WHEN ')' THEN 'R' ELSE 'W' END), ''), '') AS kinds
  FROM qtoks),
moves AS (
  SELECT query_id, pos, sum(CASE t WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END)
      OVER (PARTITION BY query_id ORDER BY pos) AS depth, len
  FROM (SELECT query_id, len(tokens) AS len, unnest(tokens) AS t, unnest(range(1, len(tokens) + 1)) AS pos FROM qtoks)),
depths AS (
  SELECT query_id, min(depth) AS lowest, max(CASE WHEN pos = len THEN depth END) AS final
  FROM moves GROUP BY query_id),
checked AS (
  SELECT k.*, CASE WHEN len(tokens) = 0 THEN 'empty query'
    WHEN regexp_matches(kinds, '[WR][WNL]') THEN 'operator missing'
    WHEN regexp_matches(kinds, '[AOL][AOR]|N[AONR]') OR NOT regexp_matches(kinds, '^[WNL].*[WR]$|^W$') THEN 'operand missing'
    WHEN lowest < 0 OR final <> 0 THEN 'unbalanced parentheses' END AS reason
  FROM kinds k LEFT JOIN depths d ON d.query_id = k.query_id)"""

FOLD = r""",
fold AS (
  SELECT query_id, tokens, 1 AS pos, [NULL::VARCHAR] AS v, [NULL::VARCHAR] AS o, [false] AS n
  FROM checked WHERE reason IS NULL
  UNION ALL
  SELECT query_id, tokens, pos + 1,
    CASE WHEN t = '(' THEN list_append(v, NULL::VARCHAR)
         WHEN t IN ('AND', 'OR', 'NOT') THEN v
         ELSE list_append(bv[1:len(bv)-1], CASE WHEN bo[-1] IS NULL THEN y
              ELSE '(' || bv[-1] || ' ' || bo[-1] || ' ' || y || ')' END) END,
    CASE WHEN t = '(' THEN list_append(o, NULL::VARCHAR)
         WHEN t = 'NOT' THEN o
         WHEN t IN ('AND', 'OR') THEN list_append(o[1:len(o)-1], t)
         ELSE list_append(bo[1:len(bo)-1], NULL::VARCHAR) END,
    CASE WHEN t = '(' THEN list_append(n, false)
         WHEN t = 'NOT' THEN list_append(n[1:len(n)-1], true)
         WHEN t IN ('AND', 'OR') THEN n
         ELSE list_append(bn[1:len(bn)-1], false) END
  FROM (SELECT *, CASE WHEN bn[-1] THEN 'NOT ' || x ELSE x END AS y
    FROM (SELECT query_id, tokens, pos, tokens[pos] AS t, v, o, n,
      CASE WHEN tokens[pos] = ')' THEN v[-1] ELSE tokens[pos] END AS x,
      CASE WHEN tokens[pos] = ')' THEN v[1:len(v)-1] ELSE v END AS bv,
      CASE WHEN tokens[pos] = ')' THEN o[1:len(o)-1] ELSE o END AS bo,
      CASE WHEN tokens[pos] = ')' THEN n[1:len(n)-1] ELSE n END AS bn
      FROM fold WHERE pos <= len(tokens))))
SELECT min(query_id) AS query_id, v[1] AS canon FROM fold WHERE pos = len(tokens) + 1 GROUP BY v[1]"""

HREFS = """hrefs AS (
  SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site,
    unnest(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS href
  FROM pages)"""

EDGES = f"""{HREFS},
edges AS (
  SELECT site AS src, href AS dst FROM hrefs UNION SELECT href, site FROM hrefs)"""

FETCHES = """fetches AS (
  SELECT event_id AS seq, 'https://u.example/' || user_id AS url,
    CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS status_code
  FROM events)"""

ALL_URLS = f"WITH {TEXTS} SELECT url FROM pages UNION ALL SELECT url FROM texts"

STEPS = f"""WITH t1 AS (SELECT doc_id, regexp_replace(text, '[\\n\\t\\r]', ' ', 'g') AS t1 FROM documents),
t2 AS (SELECT *, regexp_replace(t1, '[<>¿?,;:.()\\[\\]"''¡!]', '', 'g') AS t2 FROM t1),
t3 AS (SELECT *, trim(regexp_replace(t2, '{WS}', ' ', 'g')) AS t3 FROM t2),
t4 AS (SELECT *, list_filter(string_split(lower(t3), ' '), lambda w: w <> '') AS t4 FROM t3),
t5 AS (SELECT *, list_filter(t4, lambda w: NOT list_contains({_stop_list()}, w)) AS t5 FROM t4)
SELECT doc_id, md5(t1) AS t1, md5(t2) AS t2, md5(t3) AS t3, len(t4) AS n_words,
  md5(coalesce(array_to_string(t4, ' '), '')) AS t4, len(t5) AS n_tokens,
  md5(coalesce(array_to_string(t5, ' '), '')) AS t6 FROM t5"""

ORACLES: dict[str, str] = {
    "norm_text": _with("SELECT doc_id, nt AS norm_text FROM norm_docs"),
    "norm_steps": STEPS,
    "snippet": f"SELECT doc_id, {SNIPPET} AS snippet FROM documents",
    "doc_terms": _with("SELECT term, doc_id, tf FROM terms"),
    "doc_norm": _with("SELECT doc_id, norm FROM norms"),
    "postings_list": _with(
        "SELECT term, doc_id // 4096 AS list_no, count(*) AS n_docs,"
        " string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids"
        " FROM terms GROUP BY term, doc_id // 4096"
    ),
    "document_frequency": _with(
        "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM terms GROUP BY term"
    ),
    "document_table": _with(
        f"SELECT d.doc_id, title, url, nt AS text, {SNIPPET} AS snippet, norm"
        " FROM norm_docs d JOIN norms n ON d.doc_id = n.doc_id"
    ),
    "document_numbering": f"WITH {TEXTS} SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id,"
    " url, doc_id AS given_id FROM texts",
    "corpus_stats": _with(
        "SELECT (SELECT count(DISTINCT term) FROM terms) AS n_words,"
        " (SELECT count(*) FROM texts) AS n_docs"
    ),
    "index_round_trip": _with(
        ", dfs AS (SELECT term, count(*) AS df FROM terms GROUP BY term)"
        " SELECT t.term, t.doc_id, t.tf, n.norm, n.norm AS document_norm, d.url, f.df FROM terms t"
        " JOIN norms n ON n.doc_id = t.doc_id JOIN texts d ON d.doc_id = t.doc_id"
        " JOIN dfs f ON f.term = t.term"
    ),
    "index_blocks": "WITH placed AS (SELECT doc_id * 1000003 AS id, (row_number() OVER (ORDER BY doc_id) - 1) // 300 AS b FROM documents)"
    " SELECT CAST(b AS BIGINT) AS doc_block, min(id) AS first_id, max(id) AS last_id, count(*) AS n_docs FROM placed GROUP BY b",
    "term_blocks": _with(
        ", placed AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS b FROM texts)"
        " SELECT t.term, CAST(p.b AS BIGINT) AS doc_block, count(*) AS df, CAST(sum(t.tf) AS BIGINT) AS cf,"
        " max(t.tf / n.norm) AS top FROM terms t JOIN placed p ON p.doc_id = t.doc_id"
        " JOIN norms n ON n.doc_id = t.doc_id GROUP BY t.term, p.b"
    ),
    "query_file": f"WITH {LINES} SELECT CAST(row_number() OVER (ORDER BY query_id) - 1 AS BIGINT) AS query_id, line FROM lines",
    "term_lookup": _matching(_has("tion")),
    "bool_and": _matching(f"{_has('tion')} AND {_has('ing')}"),
    "bool_or": _matching(f"{_has('tion')} OR {_has('mente')}"),
    "bool_not": _matching(f"NOT {_has('the')}"),
    "bool_left_to_right": _matching(
        f"(({_has('mente')} OR {_has('tion')}) AND {_has('ing')}) AND NOT {_has('er')}"
    ),
    "bool_grouped": _matching(
        f"NOT ({_has('tion')} AND ({_has('ing')} OR {_has('mente')}))"
        f" OR ({_has('the')} AND NOT {_has('er')})"
    ),
    "bool_combined": _matching(
        f"({_has('tion')} OR {_has('mente')}) AND NOT ({_has('ing')} AND {_has('er')})"
    ),
    "query_tokens": f"WITH {LINES} SELECT query_id, coalesce(array_to_string(tokens, '|'), '') AS tokens, kinds FROM kinds",
    "query_terms": f"WITH {LINES} SELECT query_id, word, count(*) AS repeats"
    " FROM (SELECT query_id, unnest(tokens) AS word FROM qtoks)"
    " WHERE word NOT IN ('AND', 'OR', 'NOT', '(', ')') GROUP BY query_id, word",
    "query_valid": f"WITH {LINES} SELECT query_id, reason IS NULL AS valid, reason FROM checked",
    "query_canonical": f"WITH RECURSIVE {LINES}{FOLD}",
    "query_rejects": f"WITH {LINES} SELECT query_id, line, reason FROM checked WHERE reason IS NOT NULL",
    "word_expansion": _with(
        "SELECT term, word, CAST((length(term) - length(replace(term, lower(word), ''))) // length(lower(word)) AS BIGINT)"
        " AS occ, contains(term, word) AS as_typed, term = word AS exact"
        " FROM (SELECT DISTINCT term FROM terms),"
        " (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark)"
        " WHERE word <> '' AND contains(term, lower(word))"
    ),
    "score_tf": f"WITH {_scored([SCORE])} SELECT doc_id, query_tf FROM scored WHERE query_tf > 0",
    "score_query_norm": f"WITH {_scored([SCORE])} SELECT doc_id,"
    " sqrt(CAST(squares AS DOUBLE)) AS query_norm FROM scored WHERE squares > 0",
    "score": f"WITH {_scored([SCORE])} SELECT doc_id, score, is_match FROM scored WHERE query_tf > 0",
    "search_one": _search([MIXED], 10, batch=False),
    "search_not": _search(
        [
            (
                0,
                "",
                ["zzzz", "qqqq", "ado"],
                f"(NOT {_in('zzzz')} AND NOT {_in('qqqq')}) OR {_in('ado')}",
            )
        ],
        60,
        batch=False,
    ),
    "search_batch": _search(BATCH, 10, batch=True),
    "search_by_blocks": _search(BATCH, 10, batch=True),
    "page_links": f"WITH {HREFS} SELECT page_id AS doc_id, href FROM hrefs",
    "site_links": f"WITH {HREFS} SELECT url, site || href AS dst FROM hrefs"
    " WHERE starts_with(site || href, 'https://blog.')",
    "relative_links": rf"WITH {HREFS} SELECT url AS src, site || href AS dst FROM hrefs"
    r" WHERE regexp_matches(href, '^/.*[aeiou]\w*$') AND NOT ends_with(url, '.pdf')",
    "url_type": f"SELECT url, CASE WHEN ends_with(url, '.pdf') THEN 'pdf' ELSE 'html' END AS type FROM ({ALL_URLS})",
    "url_strip": "SELECT url, string_split(url, '?')[1] AS stripped FROM pages",
    "url_key": "SELECT url, key, 'store/' || key || '/content.json' AS file FROM (SELECT url,"
    " CASE WHEN starts_with(url, 'https://') THEN substring(string_split(url, '?')[1], 9)"
    " ELSE string_split(url, '?')[1] END AS key FROM pages)",
    "page_dedup": "WITH twice AS (SELECT page_id AS seq, url, html FROM pages"
    " UNION ALL SELECT page_id + 1000000000, url || '?again', html FROM pages),"
    " keyed AS (SELECT *, regexp_replace(string_split(url, '?')[1], '^https://', '') AS key FROM twice)"
    " SELECT url, md5(html) AS text_md5, 'html' AS type FROM keyed"
    " QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1",
    "page_upsert": "WITH crawls AS (SELECT page_id AS seq, url, html FROM pages"
    " UNION ALL SELECT CASE WHEN page_id % 5 = 0 THEN page_id + 1000000000 ELSE -page_id - 1 END,"
    " CASE WHEN page_id % 5 = 1 THEN url || '/more' ELSE url END, html || 'second' FROM pages),"
    " keyed AS (SELECT *, regexp_replace(string_split(url, '?')[1], '^https://', '') AS key FROM crawls)"
    " SELECT url, md5(html) AS text_md5, CASE WHEN ends_with(url, '.pdf') THEN 'pdf' ELSE 'html' END AS type FROM keyed"
    " QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC, url DESC) = 1",
    "page_files": "SELECT CASE WHEN page_id % 10 <> 3 THEN url END AS url,"
    " CASE WHEN page_id % 10 NOT IN (3, 7) THEN md5(html) END AS text_md5,"
    " CASE WHEN page_id % 10 <> 3 THEN CASE WHEN ends_with(url, '.pdf') THEN 'pdf' ELSE 'html' END END AS type,"
    " CASE page_id % 10 WHEN 3 THEN 'malformed JSON' WHEN 7 THEN 'missing text' END AS reason FROM pages",
    "frontier_fetched": f"""WITH RECURSIVE {EDGES},
fetches AS (
  SELECT url, k, substring(md5(url || '#' || k), 1, 1) AS drawn
  FROM (SELECT DISTINCT src AS url FROM edges), range(1, 5) t(k)),
logged AS (
  SELECT url, row_number() OVER (PARTITION BY url ORDER BY k) AS attempt,
    CASE WHEN drawn < '7' THEN 200 WHEN drawn < 'b' THEN 429 ELSE 404 END AS status
  FROM fetches WHERE drawn <> 'f'),
tried AS (
  SELECT url, coalesce(min(attempt) FILTER (status = 200), max(attempt)) AS attempts,
    coalesce(min(status) FILTER (status = 200), arg_max(status, attempt)) AS status_code, bool_or(status = 200) AS fetched
  FROM logged WHERE attempt <= 3 GROUP BY url),
reached AS (
  SELECT src AS url, 0 AS depth FROM edges WHERE starts_with(src, 'http')
  UNION
  SELECT e.dst, r.depth + CAST(t.attempts AS INTEGER) FROM reached r JOIN tried t ON t.url = r.url AND t.fetched
  JOIN edges e ON e.src = r.url WHERE r.depth < 40),
least_depth AS (SELECT url, min(depth) AS depth FROM reached GROUP BY url)
SELECT l.url, l.depth, CAST(coalesce(t.attempts, 0) AS INTEGER) AS attempts, CAST(t.status_code AS INTEGER) AS status_code,
  coalesce(t.fetched, false) AS fetched
FROM least_depth l LEFT JOIN tried t ON t.url = l.url""",
    "fetch_outcome": f"WITH {FETCHES}, latest AS (SELECT url, arg_max(status_code, seq) AS status_code,"
    " bool_or(status_code = 429) AS was_throttled FROM fetches GROUP BY url)"
    " SELECT url, status_code, status_code <> 200 AS retry, status_code = 429 AS throttled, was_throttled FROM latest",
    "fetch_success": f"WITH {FETCHES} SELECT seq, url FROM fetches WHERE status_code = 200",
    "fetch_retry": f"WITH {FETCHES} SELECT url, arg_max(status_code, seq) = 429 AS throttled"
    " FROM fetches GROUP BY url HAVING arg_max(status_code, seq) <> 200",
    "frontier_step": f"WITH {EDGES} SELECT DISTINCT dst AS url FROM edges WHERE starts_with(src, 'http://')"
    " AND dst NOT IN (SELECT dst FROM edges WHERE starts_with(src, 'https://'))",
    "frontier_bfs": f"""WITH RECURSIVE {EDGES},
reached AS (
  SELECT min(src) AS url, 0 AS depth FROM edges WHERE starts_with(src, 'http')
  UNION
  SELECT e.dst, r.depth + 1 FROM reached r JOIN edges e ON e.src = r.url
  -- paths alternate between sites and targets, and a shortest one meets no site twice
  WHERE r.depth < (SELECT 2 * count(DISTINCT site) FROM hrefs)),
least_depth AS (SELECT url, min(depth) AS depth FROM reached GROUP BY url)
SELECT url, depth FROM least_depth ORDER BY depth, url LIMIT 300""",
    "page_reader": "SELECT page_id AS doc_id,"
    " replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&') AS title,"
    " array_to_string(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), ' ') AS hrefs FROM pages",
    "title_html": "SELECT page_id AS doc_id,"
    " CASE WHEN regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1) <> ''"
    " THEN regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)"
    " WHEN regexp_matches(html, '(?i)<title[\\s>]') THEN 'None' ELSE '' END AS title FROM pages",
    "title_stem": "SELECT url, regexp_replace(list_extract(string_split(rtrim(url, '/'), '/'), -1),"
    f" '(.)\\.[^.]+$', '\\1') AS title FROM ({ALL_URLS})",
}
