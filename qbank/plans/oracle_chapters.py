"""Round-trip oracles of the chapter callbacks."""

from __future__ import annotations

from qbank.plans.oracle_html import DOCS
from qbank.plans.oracle_sql import ORACLES


def econ_chapter_sections() -> str:
    return f"""WITH {DOCS},
s AS (SELECT doc_id, ln, unnest(list_filter(range(2, n + 1), lambda i: i % 3 = 1)) AS i FROM docs)
SELECT CAST(doc_id AS VARCHAR) || '-chapter-intro' AS chapter_name,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos,
       ln[i] AS section_name, ln[i] AS section_text
FROM s"""


def econ_chapter_intro() -> str:
    return f"""WITH {DOCS},
c AS (
  SELECT doc_id, ln, n, length(ln[1]) AS k,
         list_transform(list_filter(range(2, n + 1), lambda i: i % 3 = 1), lambda i: ln[i]) AS secs,
         list_transform(list_filter(range(2, n + 1), lambda i: i % 3 = 2), lambda i: ln[i]) AS boxes
  FROM docs
),
w AS (
  SELECT *, array_to_string(CASE WHEN ln[1] <> '' THEN ln[1:k] || [chr(10)] || ln[k + 1:] ELSE ln END, '') AS joined
  FROM c
)
SELECT CAST(doc_id AS VARCHAR) || '-chapter-intro' AS chapter_name, ln[1] AS section_name,
       list_reduce([joined] || secs || boxes, lambda acc, x: replace(acc, x, '')) AS section_text,
       CAST(len(boxes) AS INTEGER) AS n_boxes
FROM w"""


def econ_problem_texts() -> str:
    return f"""WITH {DOCS}
SELECT CAST(doc_id AS VARCHAR) || '-self-check-questions' AS chapter_name,
       'selfcheckquestions' AS section_name,
       array_to_string(list_transform(range(1, (n + 1) // 2 + 1),
         lambda i: ln[2 * i - 1] || CASE WHEN 2 * i <= n THEN 'Show' ELSE '' END), '') AS section_text
FROM docs"""


ORACLES.update({
    "econ_chapter_sections": econ_chapter_sections,
    "econ_chapter_intro": econ_chapter_intro,
    "econ_problem_texts": econ_problem_texts,
})


def econ_chapter_feed() -> str:
    return f"""WITH {DOCS},
c AS (
  SELECT doc_id, ln, n, length(ln[1]) AS k,
         list_transform(list_filter(range(2, n + 1), lambda i: i % 3 = 1), lambda i: ln[i]) AS secs,
         list_transform(list_filter(range(2, n + 1), lambda i: i % 3 = 2), lambda i: ln[i]) AS boxes
  FROM docs
),
w AS (
  SELECT *, list_reduce([array_to_string(CASE WHEN ln[1] <> '' THEN ln[1:k] || [chr(10)] || ln[k + 1:] ELSE ln END, '')]
                        || secs || boxes, lambda acc, x: replace(acc, x, '')) AS intro
  FROM c
),
r AS (
  SELECT doc_id,
         list_transform(boxes, lambda x: {{'section_name': 'os-figure', 'section_text': x}})
         || [{{'section_name': ln[1], 'section_text': intro}}]
         || list_transform(secs, lambda x: {{'section_name': x, 'section_text': x}}) AS recs
  FROM w
),
e AS (SELECT doc_id, recs, unnest(range(len(recs))) AS pos FROM r)
SELECT CAST(doc_id AS VARCHAR) || '-chapter-intro' AS chapter_name, CAST(pos AS INTEGER) AS pos,
       recs[pos + 1].section_name AS section_name, recs[pos + 1].section_text AS section_text
FROM e"""


ORACLES["econ_chapter_feed"] = econ_chapter_feed
