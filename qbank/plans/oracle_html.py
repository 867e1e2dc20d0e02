"""Round-trip oracles of the crawl jobs: the expected extraction, stated in SQL
straight from the document lines the site was rendered from."""

from __future__ import annotations

import re

from qbank.plans.oracle_sql import ORACLES

DOCS = """
docs AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS ln,
         len(string_split(text, chr(10))) AS n,
         'https://books.example.org/books/econ-' || source || '/pages/' AS econ_base,
         'https://books.example.org/books/finance-' || source || '/pages/' AS finance_base
  FROM documents
)"""

STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _s(x: str) -> str:
    return STRIP.format(x=x)


def toc_links() -> str:
    return f"""WITH {DOCS},
l(slug, route, book) AS (VALUES
  ('self-check-questions', 'self_check', 'econ'), ('key-terms', 'key_terms', 'econ'),
  ('key-concepts-and-summary', 'key_concepts', 'econ'), ('key-terms', 'key_terms', 'finance'),
  ('summary', 'summary', 'finance'), ('multiple-choice', 'multiple_choice', 'finance'),
  ('review-questions', 'review_questions', 'finance'), ('problems', 'problems', 'finance'),
  ('chapter-intro', 'chapter', 'finance'), ('missing-page', 'chapter', 'finance'))
SELECT CASE WHEN book = 'econ' THEN econ_base ELSE finance_base END || CAST(doc_id AS VARCHAR) || '-' || slug
         AS resolved_url, route, book
FROM docs, l"""


def econ_key_terms() -> str:
    return f"""WITH {DOCS}, p AS (SELECT doc_id, ln, unnest(range((n + 1) // 2)) AS pos FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-key-terms' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       {_s('ln[2 * pos + 1]')} AS term, {_s('ln[2 * pos + 2]')} AS definition
FROM p WHERE ln[2 * pos + 1] <> '' AND ln[2 * pos + 2] <> ''"""


def econ_key_concepts() -> str:
    return f"""WITH {DOCS}, g AS (SELECT doc_id, ln, unnest(range((n + 2) // 3)) AS pos FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-key-concepts-and-summary' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       {_s('ln[3 * pos + 1]')} AS concept, {_s("coalesce(ln[3 * pos + 2], '') || ' ' || coalesce(ln[3 * pos + 3], '')")} AS definition
FROM g WHERE ln[3 * pos + 1] <> '' AND coalesce(ln[3 * pos + 2], '') || coalesce(ln[3 * pos + 3], '') <> ''"""


def econ_self_check() -> str:
    return f"""WITH {DOCS},
p AS (SELECT doc_id, ln, n, unnest(range(1, (n + 1) // 2 + 1)) AS i FROM docs),
q AS (
  SELECT doc_id, ln[2 * i - 1] || 'Show' AS question,
         CASE WHEN i % 4 = 0 THEN 'Answer not found' WHEN i % 5 = 0 THEN '' ELSE ln[2 * i] END AS answer
  FROM p WHERE 2 * i <= n
)
SELECT CAST(doc_id AS VARCHAR) || '-self-check-questions' AS chapter_name, question, answer,
       'Question: ' || question || ' Answer: ' || answer AS section_text
FROM q"""


def _concat_blocks(k: int, expr: str) -> str:
    lines = re.sub(r"(ln\[[^\]]*\])", r"coalesce(\1, '')", expr)
    return f"array_to_string(list_transform(range((n + {k - 1}) // {k}), lambda g: {lines}), '')"


def main_texts() -> str:
    layouts = [
        ("key-terms", "'Key Terms' || " + _concat_blocks(2, 'ln[2 * g + 1] || ln[2 * g + 2]')),
        ("key-concepts-and-summary", _concat_blocks(3, "CAST(g + 1 AS VARCHAR) || ' ' || ln[3 * g + 1] || ln[3 * g + 2] || ln[3 * g + 3]")),
        ("key-terms", _concat_blocks(2, "ln[2 * g + 1] || CASE WHEN (g + 1) % 5 = 0 THEN ln[2 * g + 2] || ln[2 * g + 2] ELSE ln[2 * g + 2] END")),
        ("summary", _concat_blocks(2, 'ln[2 * g + 1] || ln[2 * g + 2]')),
        ("multiple-choice", _concat_blocks(5, "ln[5 * g + 1] || ln[5 * g + 2] || ln[5 * g + 3] || ln[5 * g + 4] || ln[5 * g + 5]")),
        ("review-questions", "array_to_string(ln, '')"),
        ("problems", "array_to_string(list_transform(range(n), lambda i: CAST(i + 1 AS VARCHAR) || ln[i + 1]), '')"),
    ]
    parts = [f"SELECT CAST(doc_id AS VARCHAR) || '-{slug}' AS chapter_name, '{slug.replace('-', '')}' AS section_name, {expr} AS section_text FROM docs"
             for slug, expr in layouts]
    return f"WITH {DOCS}\n" + "\nUNION ALL\n".join(parts)


def finance_key_terms() -> str:
    return f"""WITH {DOCS},
b AS (SELECT doc_id, ln, range((n + 1) // 2) AS bl FROM docs),
d AS (
  SELECT doc_id, list_filter(list_transform(bl, lambda p: ln[2 * p + 1]), lambda x: x <> '') AS terms,
         list_filter(flatten(list_transform(bl, lambda p: CASE WHEN (p + 1) % 5 = 0
                     THEN [ln[2 * p + 2], ln[2 * p + 2]] ELSE [ln[2 * p + 2]] END)), lambda x: x <> '') AS defs
  FROM b
),
p AS (SELECT doc_id, terms, defs, unnest(range(least(len(terms), len(defs)))) AS pos FROM d)
SELECT CAST(doc_id AS VARCHAR) || '-key-terms' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       {_s('terms[pos + 1]')} AS term, {_s('defs[pos + 1]')} AS definition
FROM p"""


def finance_summary() -> str:
    return f"""WITH {DOCS}, p AS (SELECT doc_id, ln, unnest(range((n + 1) // 2)) AS pos FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-summary' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       {_s('ln[2 * pos + 1]')} AS question, {_s('ln[2 * pos + 2]')} AS answer
FROM p WHERE ln[2 * pos + 1] <> '' AND ln[2 * pos + 2] <> ''"""


def finance_multiple_choice() -> str:
    return f"""WITH {DOCS}, p AS (SELECT doc_id, ln, unnest(range((n + 4) // 5)) AS pos FROM docs),
c AS (SELECT *, list_filter(ln[5 * pos + 2:5 * pos + 5], lambda x: x <> '') AS choices FROM p)
SELECT CAST(doc_id AS VARCHAR) || '-multiple-choice' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       {_s('ln[5 * pos + 1]')} AS question,
       array_to_string(list_transform(choices, lambda x: {_s('x')}), chr(10)) AS choices_joined
FROM c WHERE ln[5 * pos + 1] <> '' AND len(choices) > 0"""


def finance_review() -> str:
    return f"""WITH {DOCS}, p AS (SELECT doc_id, ln, unnest(range(n)) AS pos FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-review-questions' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       CAST(NULL AS VARCHAR) AS question_number, {_s('ln[pos + 1]')} AS question
FROM p WHERE ln[pos + 1] <> ''"""


def finance_problems() -> str:
    return f"""WITH {DOCS}, p AS (SELECT doc_id, ln, unnest(range(n)) AS pos FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-problems' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       CAST(pos + 1 AS VARCHAR) AS question_number, {_s('ln[pos + 1]')} AS question
FROM p WHERE ln[pos + 1] <> ''"""


def finance_chapters() -> str:
    return f"""WITH {DOCS}
SELECT CAST(doc_id AS VARCHAR) || '-chapter-intro' AS chapter_name,
       '<h2> ' || {_s('ln[1]')} || ' </h2>' || array_to_string(list_transform(range(2, n + 1),
         lambda i: chr(10) || '<' || ['p', 'section', 'div'][i % 3 + 1] || '> ' || {_s('ln[i]')} || ' </'
                   || ['p', 'section', 'div'][i % 3 + 1] || '>'), '') AS section_text
FROM docs"""


def crawl_section_counts() -> str:
    return f"""WITH {DOCS},
sc AS (SELECT count(*) AS c FROM (SELECT n, unnest(range(1, (n + 1) // 2 + 1)) AS i FROM docs) WHERE 2 * i <= n),
k(section_name) AS (VALUES ('keyterms'), ('keyconceptsandsummary'), ('keyterms'), ('summary'),
                            ('multiplechoice'), ('reviewquestions'), ('problems'), (NULL))
SELECT k.section_name, count(*) AS n_sections FROM docs, k GROUP BY k.section_name
UNION ALL SELECT 'self-check-questions', c FROM sc WHERE c > 0"""


ORACLES.update({
    "toc_links": toc_links,
    "econ_key_terms": econ_key_terms,
    "econ_key_concepts": econ_key_concepts,
    "econ_self_check": econ_self_check,
    "main_texts": main_texts,
    "finance_key_terms": finance_key_terms,
    "finance_summary": finance_summary,
    "finance_multiple_choice": finance_multiple_choice,
    "finance_review": finance_review,
    "finance_problems": finance_problems,
    "finance_chapters": finance_chapters,
    "crawl_section_counts": crawl_section_counts,
})


def _unescape(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&#39;', ''''), '&amp;', '&')")


def page_stats() -> str:
    hrefs = "regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1)"
    return f"""
SELECT page_id, CAST(len({hrefs}) AS INTEGER) AS n_links,
       array_to_string(list_transform({hrefs}, lambda h: {_unescape('h')}), ' ') AS hrefs,
       CAST(len(regexp_extract_all(html, '<p[ >]')) AS INTEGER) AS n_p,
       {_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title
FROM pages"""


ORACLES["page_stats"] = page_stats
ORACLES["stream_self_check"] = econ_self_check
ORACLES["stream_section_counts"] = crawl_section_counts
ORACLES["econ_key_terms_rows"] = econ_key_terms
ORACLES["econ_self_check_rows"] = econ_self_check
ORACLES["econ_key_concepts_rows"] = econ_key_concepts
ORACLES["finance_problems_rows"] = finance_problems


def page_article_text() -> str:
    body = "regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1), '<[^>]*>', '', 'g')"
    return f"SELECT page_id, {_unescape(body)} AS article_text FROM pages"


ORACLES["page_article_text"] = page_article_text
ORACLES["seeded_section_counts"] = crawl_section_counts


def crawl_quarantine() -> str:
    """The links of the damaged site whose pages are gone, empty or broken."""
    return f"""SELECT * FROM (
SELECT resolved_url, book, route,
       CASE WHEN slug = 'missing-page' OR (doc_id % 4 = 3 AND slug = 'review-questions') THEN 'missing'
            WHEN doc_id % 4 = 2 AND slug = 'problems' THEN 'no_markup'
            WHEN doc_id % 4 = 1 THEN 'recovered' ELSE 'ok' END AS status,
       CASE WHEN slug <> 'missing-page' AND doc_id % 4 = 1 THEN 1
            WHEN slug = 'missing-page' OR (doc_id % 4 = 3 AND slug = 'review-questions')
                 OR (doc_id % 4 = 2 AND slug = 'problems') THEN NULL ELSE 0 END AS n_faults
FROM (SELECT *, split_part(c, '-', 1)::BIGINT AS doc_id, substr(c, strpos(c, '-') + 1) AS slug
      FROM (SELECT *, split_part(resolved_url, '/pages/', 2) AS c FROM ({toc_links()}))))
WHERE status <> 'ok'"""


def damaged_main_texts() -> str:
    return f"""SELECT chapter_name, section_name,
       CASE WHEN doc_id % 4 = 2 AND section_name = 'problems' THEN NULL ELSE section_text END AS section_text
FROM (SELECT *, split_part(chapter_name, '-', 1)::BIGINT AS doc_id FROM ({main_texts()}))
WHERE NOT (doc_id % 4 = 3 AND section_name = 'reviewquestions')"""


ORACLES["crawl_quarantine"] = crawl_quarantine
ORACLES["damaged_main_texts"] = damaged_main_texts


def stream_waiting_answers() -> str:
    """An answer counts if it lands within the wait; one of five comes after it, one never."""
    return f"""SELECT chapter_name, question, CASE WHEN answer_status = 'absent' THEN '' ELSE answer END AS answer, answer_status
FROM (SELECT *, CASE WHEN answer = 'Answer not found' AND i % 4 = 0 THEN 'no_link'
                     WHEN i % 5 = 0 OR doc_id % 5 >= 3 THEN 'absent' ELSE 'found' END AS answer_status
      FROM ({econ_self_check().replace("SELECT doc_id, ln[2 * i - 1] ||", "SELECT doc_id, i, ln[2 * i - 1] ||")
             .replace("question, answer," + chr(10), "question, answer, doc_id, i," + chr(10))}))"""


ORACLES["stream_waiting_answers"] = stream_waiting_answers
ORACLES["stream_last_results"] = lambda: """
SELECT conv_id::VARCHAR AS custom_id, max(turn) AS seq, arg_max(text, turn) AS response
FROM conversations WHERE role = 'assistant' GROUP BY conv_id"""
