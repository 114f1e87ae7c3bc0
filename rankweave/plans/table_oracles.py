"""The results of ``table_queries`` as DuckDB SQL over the same tables."""

from __future__ import annotations

# --- inputs -----------------------------------------------------------------

TITLE = r"regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"

ARTICLES = rf"""
titled AS (
    SELECT {TITLE} AS title, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS text
    FROM pages
    WHERE regexp_matches(html, '(?s)<title>.*?</title>')
),
articles AS (
    SELECT replace(title, ' ', '_') AS page, text
    FROM titled
    WHERE text <> '' AND NOT contains(title, ':')
)"""

WIKI = rf"""
wiki AS (
    SELECT replace({TITLE}, ' ', '_') AS page,
        regexp_replace(html, '<a href="/([^"]*)">([^<]*)</a>', '[[\1|\2]]', 'g') AS text
    FROM pages
    WHERE NOT contains({TITLE}, ':')
)"""

RULES = """
texts AS (
    SELECT 'Doc_' || doc_id AS page, 'Doc ' || doc_id AS x, 'Doc_' || (doc_id // 2) AS y, CASE doc_id % 16
        WHEN 0 THEN 'see [x] here'
        WHEN 1 THEN '[[x#y|z]]'
        WHEN 2 THEN '[[x|y#z]] and [[y]]'
        WHEN 3 THEN '[[-x]] [[.x]] [[''x]] [[{x]]'
        WHEN 4 THEN '[[:x]] [[x:y]]'
        WHEN 5 THEN '[[x&y]] [[&x]]'
        WHEN 6 THEN '[[ x' || chr(9) || 'y ]]'
        WHEN 7 THEN '[[|x]] [[#x]]'
        WHEN 8 THEN '[[x|' || repeat('z', 120) || ']] [[x|' || repeat('z', 90) || ']]'
        WHEN 9 THEN '[[x' || chr(128512) || 'y]]'
        WHEN 10 THEN '[[File:x.png|see [[y]]]] [[y]]'
        WHEN 11 THEN '[[x,y]] [[,x]]'
        WHEN 12 THEN '[[]] [[x]]'
        WHEN 13 THEN '[[x|y|z]] [1]'
        WHEN 14 THEN '[[' || repeat(chr(128512), 60) || ']] [[' || repeat(chr(128512), 40) || ']]'
        ELSE '[[x]] [[x|y]] [[x]]' END AS form
    FROM documents
),
wiki AS (SELECT page, replace(replace(form, 'x', x), 'y', y) AS text FROM texts)"""

PIECES = r"""
pieces AS (
    SELECT page, unnest(regexp_extract_all(text, '\[[^\n\r\x{85}\x{2028}\x{2029}]+?\]')) AS link FROM wiki
)"""

LINKS = rf"""{PIECES},
measured AS (
    SELECT page, link, CASE WHEN starts_with(link, '[[') THEN 2 ELSE 1 END AS width,
        length(link) + length(regexp_replace(link, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')) AS units,
        CASE WHEN contains(link, '#') THEN instr(link, '#')
             WHEN contains(link, '|') THEN instr(link, '|')
             ELSE instr(link, ']') END AS stop
    FROM pieces
),
targets AS (
    SELECT page AS src,
        regexp_replace(substr(link, width + 1, greatest(stop - 1 - width, 0)), '[ \t\n\x0B\f\r]', '_', 'g') AS dst
    FROM measured
    WHERE length(link) >= width + 2 AND units <= 100
        AND substr(link, width + 1, 1) NOT IN ('#', ',', '.', '&', '''', '-', '{{')
        AND NOT contains(link, ':') AND NOT contains(link, ',') AND NOT contains(link, '&')
),
edges AS (SELECT src, dst FROM targets WHERE dst <> '')"""

WIKI_EDGES = f"{WIKI},{LINKS}"

DOCUMENTS = "docs AS (SELECT CAST(doc_id AS VARCHAR) AS page, text FROM documents)"

DOCUMENT_EDGES = """
edges AS (
    SELECT CAST(doc_id AS VARCHAR) AS src, CAST(doc_id // 2 AS VARCHAR) AS dst FROM documents
    UNION ALL
    SELECT CAST(doc_id AS VARCHAR), CAST(doc_id // 3 AS VARCHAR) FROM documents
)"""

SALES = "sales AS (SELECT o_custkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"

TRADE_EDGES = f"""{SALES},
edges AS (
    SELECT b.n_name AS src, s.n_name AS dst
    FROM sales
    JOIN customer ON o_custkey = c_custkey JOIN nation b ON c_nationkey = b.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
)"""

ACCOUNT_EDGES = f"""{SALES},
edges AS (
    SELECT 'customer-' || o_custkey AS src, 'supplier-' || l_suppkey AS dst FROM sales
    UNION ALL
    SELECT 'supplier-' || l_suppkey, 'customer-' || o_custkey FROM sales
)"""

STATUS_EDGES = """
edges AS (
    SELECT 'status-' || o_orderstatus AS src, 'customer-' || o_custkey AS dst FROM orders
    UNION ALL
    SELECT 'customer-' || o_custkey, 'status-' || o_orderstatus FROM orders
)"""

DUMP = """
docs AS (
    SELECT 'Doc_' || doc_id AS page,
        replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')
            || ' [[Doc ' || (doc_id // 2) || ']] [[Doc ' || (doc_id // 3) || '|other]]' AS text
    FROM documents
)"""

DUMP_EDGES = """
edges AS (
    SELECT 'Doc_' || doc_id AS src, 'Doc_' || (doc_id // 2) AS dst FROM documents
    UNION ALL
    SELECT 'Doc_' || doc_id, 'Doc_' || (doc_id // 3) FROM documents
)"""

# --- operators --------------------------------------------------------------


def _tokens(delimiters: str) -> str:
    return rf"""
words AS (SELECT page AS doc, unnest(regexp_split_to_array(text, '{delimiters}')) AS word FROM docs),
tokens AS (
    SELECT lower(regexp_replace(word, '[^a-zA-Z]', '', 'g')) AS term, doc
    FROM words
    WHERE regexp_matches(word, '[a-zA-Z]')
)"""


TOKENS = _tokens("[ ''-]")
POSTINGS = f"{TOKENS},\npostings AS (SELECT term, doc, count(*) AS tf FROM tokens GROUP BY term, doc)"


# The terms of the keywords in the queries, written out.
FEW_TERMS = "'the', 'and'"
MANY_TERMS = "'the', 'that', 's', 'with', 'de', 'la', 'und', 'jean', 'louis'"


def _found(terms: str) -> str:
    return f"found AS (SELECT term, doc, tf FROM postings WHERE term IN ({terms}))"


HITS = "hits AS (SELECT doc, CAST(sum(tf) AS BIGINT) AS tf FROM found GROUP BY doc)"

WEIGHTS = """
links AS (SELECT src, dst, count(*) AS copies FROM edges GROUP BY src, dst),
degrees AS (SELECT src AS page, count(*) AS links FROM edges GROUP BY src),
weights AS (
    SELECT src, dst, copies / CAST(degrees.links AS DOUBLE) AS weight FROM links JOIN degrees ON src = page
),
nodes AS (SELECT src AS page FROM edges UNION SELECT dst FROM edges),
ranks0 AS (SELECT page, CAST(0.85 AS DOUBLE) AS rank FROM nodes)"""


def _ranks(rounds: int, damping: float = 0.85) -> str:
    d = f"CAST({damping} AS DOUBLE)"
    steps = [
        f"""
sums{n} AS (SELECT dst, sum(weight * rank) AS total FROM weights JOIN ranks{n - 1} ON src = page GROUP BY dst),
ranks{n} AS (
    SELECT page, {d} * coalesce(total, 0) + (1 - {d}) AS rank FROM nodes LEFT JOIN sums{n} ON dst = page
)"""
        for n in range(1, rounds + 1)
    ]
    return ",".join([WEIGHTS, *steps])


def _scores(rounds: int) -> str:
    return f"SELECT doc, round(tf * rank, 8) AS score FROM hits JOIN ranks{rounds} ON doc = page"


def _inner_ranks(rounds: int, damping: float) -> str:
    return f"WITH {_ranks(rounds, damping)} SELECT page, round(rank, 8) AS rank FROM ranks{rounds}"


def _rank_query(edges: str, rounds: int, damping: float = 0.85) -> str:
    return f"WITH {edges},{_ranks(rounds, damping)} SELECT page, round(rank, 8) AS rank FROM ranks{rounds}"


ADJACENCY = """SELECT src AS page, CAST(0.85 AS DOUBLE) AS rank, string_agg(dst, ',' ORDER BY dst) AS links
FROM edges GROUP BY src"""


def _split_sizes(key: str, rows: str) -> str:
    return f"""SELECT {key}, count(*) AS entries, count(*) > 20 AS split, TRUE AS parts_differ
FROM {rows} GROUP BY {key}"""


EDGES = f"WITH {ACCOUNT_EDGES} SELECT src, dst FROM edges"
FOUND_POSTINGS = f"WITH {DOCUMENTS},{POSTINGS} SELECT term, doc, tf FROM postings"
DOC_HITS = f"WITH {DOCUMENTS},{POSTINGS},{_found(FEW_TERMS)},{HITS} SELECT doc, tf FROM hits"

# Of the last page of a file, its first bytes: as many as the file's number. Whole it has 53, and 54 from ten on.
CUT_DUMPS = """
SELECT 'Doc_' || doc_id AS page, 'x' AS text FROM documents
UNION ALL
SELECT 'Last_' || kind, '[[x]]' FROM (SELECT DISTINCT doc_id % 60 AS kind FROM documents)
WHERE kind >= length('<page><title>Last ' || kind || '</title><text>[[x]]</text></page>')"""

ORACLES = {
    "page_titles": f"WITH {ARTICLES} SELECT page FROM articles",
    "page_bodies": f"WITH {ARTICLES} SELECT page, text FROM articles",
    "page_dump": f"WITH {DUMP} SELECT page, text FROM docs",
    "link_pieces": f"WITH {WIKI},{PIECES} SELECT page, link FROM pieces",
    "wiki_links": f"WITH {WIKI_EDGES} SELECT src, dst FROM edges",
    "edge_list_parse": EDGES,
    "edge_list_file": EDGES,
    "out_degree": f"WITH {ACCOUNT_EDGES} SELECT src AS page, count(*) AS links FROM edges GROUP BY src",
    "node_set": f"WITH {ACCOUNT_EDGES} SELECT src AS page FROM edges UNION SELECT dst FROM edges",
    "adjacency_init": f"WITH {DOCUMENT_EDGES} SELECT *, CAST(0 AS BIGINT) AS part FROM ({ADJACENCY})",
    "rank_state_file": f"WITH {ACCOUNT_EDGES} {ADJACENCY}",
    "rank_state_rounds": f"""WITH {ACCOUNT_EDGES},{_ranks(2)}
SELECT page, CAST(0 AS BIGINT) AS part, round(rank, 8) AS rank,
    coalesce(string_agg(dst, ',' ORDER BY dst), '') AS links
FROM ranks2 LEFT JOIN edges ON src = page GROUP BY page, rank""",
    "link_contributions": f"""WITH {ACCOUNT_EDGES},{WEIGHTS}
SELECT dst AS page, rank * weight AS contribution FROM weights JOIN ranks0 ON src = page""",
    "rank_step": _rank_query(TRADE_EDGES, 1),
    "rank_trade_2": _rank_query(TRADE_EDGES, 2),
    "rank_trade_5": _rank_query(TRADE_EDGES, 5),
    "rank_accounts": _rank_query(ACCOUNT_EDGES, 10),
    "rank_damping": _rank_query(ACCOUNT_EDGES, 3, 0.5),
    "rank_resume": _rank_query(ACCOUNT_EDGES, 3),
    "page_dump_cut": CUT_DUMPS,
    "rank_hubs": _rank_query(STATUS_EDGES, 3),
    "rank_numbered": f"""SELECT page, rank, links FROM ({_rank_query(ACCOUNT_EDGES, 3)})
LEFT JOIN (WITH {ACCOUNT_EDGES} SELECT src AS page, count(*) AS links FROM edges GROUP BY src) USING (page)""",
    "adjacency_hubs": f"WITH {STATUS_EDGES} {_split_sizes('page', '(SELECT src AS page FROM edges)')}",
    "adjacency_parts": f"WITH {STATUS_EDGES} SELECT src, dst FROM edges",
    "rank_rows": f"""WITH {DOCUMENT_EDGES},{_ranks(2)}
SELECT row_number() OVER (ORDER BY round(rank, 8), page) AS place, round(rank, 8) AS rank, page FROM ranks2""",
    "rank_clamped": f"""WITH {TRADE_EDGES}
SELECT 'high' AS setting, page, rank FROM ({_inner_ranks(2, 1.0)})
UNION ALL SELECT 'low', page, rank FROM ({_inner_ranks(2, 0.0)})
UNION ALL SELECT 'none', page, rank FROM ({_inner_ranks(1, 0.85)})""",
    "rank_replaced": _rank_query(DUMP_EDGES, 3),
    "wiki_rules": f"WITH {RULES},{LINKS} SELECT src, dst FROM edges",
    "wiki_rules_dump": f"WITH {RULES},{LINKS} SELECT src, dst FROM edges",
    "page_rules": """SELECT 'Doc_' || doc_id AS page, doc_id || ' [[x]]' AS text
FROM documents WHERE doc_id % 6 IN (0, 5)""",
    "rank_links": _rank_query(WIKI_EDGES, 3),
    "rank_order": _rank_query(DOCUMENT_EDGES, 2),
    "rank_file": _rank_query(DUMP_EDGES, 2),
    "tokens": f"WITH {DOCUMENTS},{TOKENS} SELECT term, doc FROM tokens",
    "tokens_by_line": "WITH {},{} SELECT term, doc FROM tokens".format(DOCUMENTS, _tokens(r"[ ''\n\t-]")),
    "postings": FOUND_POSTINGS,
    "posting_lists": f"""WITH {DOCUMENTS},{POSTINGS}
SELECT term, CAST(0 AS BIGINT) AS part, string_agg(doc || ':' || tf, ' ' ORDER BY doc) AS postings FROM postings GROUP BY term""",
    "posting_parse": FOUND_POSTINGS,
    "posting_split": f"WITH {DOCUMENTS},{POSTINGS} {_split_sizes('term', 'postings')}",
    "posting_parts": FOUND_POSTINGS,
    "posting_colon": f"WITH {DOCUMENTS},{POSTINGS} SELECT term, 'a:b:' || doc AS doc, tf FROM postings",
    "malformed_lines": """
SELECT 'd' || doc_id AS page, CAST(doc_id AS DOUBLE) AS number, kind
FROM documents, (VALUES ('rank'), ('state'), ('hit'), ('posting')) AS kinds(kind)
WHERE doc_id % 3 <> 0""",
    "posting_file": FOUND_POSTINGS,
    "index_dump_stored": f"WITH {DUMP},{POSTINGS} SELECT term, doc, tf FROM postings",
    "term_lookup": f"WITH {DOCUMENTS},{POSTINGS},{_found(FEW_TERMS)} SELECT term, doc, tf FROM found",
    "term_lookup_stored": f"WITH {DOCUMENTS},{POSTINGS},{_found(MANY_TERMS)} SELECT term, doc, tf FROM found",
    "doc_tf": DOC_HITS,
    "hits_file": DOC_HITS,
    "search_few": f"WITH {DOCUMENTS},{POSTINGS},{_found(FEW_TERMS)},{HITS},{DOCUMENT_EDGES},{_ranks(2)} {_scores(2)}",
    "search_many": f"WITH {DOCUMENTS},{POSTINGS},{_found(MANY_TERMS)},{HITS},{DOCUMENT_EDGES},{_ranks(2)} {_scores(2)}",
    "search_top_k": f"""WITH {DOCUMENTS},{POSTINGS},{_found(MANY_TERMS)},{HITS},{DOCUMENT_EDGES},{_ranks(2)}
SELECT doc, tf * round(rank, 8) AS score FROM hits JOIN ranks2 ON doc = page ORDER BY score DESC, doc LIMIT 10""",
    "term_lookup_list": f"""WITH {DOCUMENTS},{POSTINGS},
keywords AS (SELECT unnest(regexp_split_to_array(text, '[ ''-]')) AS word FROM benchmark)
SELECT term, doc, tf FROM postings WHERE term IN (SELECT lower(regexp_replace(word, '[^a-zA-Z]', '', 'g')) FROM keywords)""",
    "search_dump": f"WITH {DUMP},{POSTINGS},{_found(FEW_TERMS)},{HITS},{DUMP_EDGES},{_ranks(2)} {_scores(2)}",
    "search_stored": f"WITH {DUMP},{POSTINGS},{_found(FEW_TERMS)},{HITS},{DUMP_EDGES},{_ranks(2)} {_scores(2)}",
}
