"""DuckDB SQL oracles: for each registered query, the same result stated in
SQL over the raw tables. Shared fragments (CTEs) are composed here; prompt
text comes from the same templates the Spark jobs use."""

from __future__ import annotations

from qbank.functions import prompts as P

LETTERS_SQL = "'ABCDEFGHIJK'"


def _shuffle_sql(choices: str, seed: str, row_id: str) -> str:
    return (f"list_transform(list_sort(list_transform(range(len({choices})), "
            f"lambda i: {{'k': md5(CAST({seed} AS VARCHAR) || ':' || CAST({row_id} AS VARCHAR) || ':' "
            f"|| CAST(i AS VARCHAR)), 'i': i, 'x': {choices}[i + 1]}})), lambda s: s.x)")


def _render_sql(question: str, choices: str) -> str:
    return (f"{question} || chr(10) || array_to_string(list_transform(range(len({choices})), "
            f"lambda i: substr({LETTERS_SQL}, i + 1, 1) || ': ' || {choices}[i + 1] || chr(10)), '')")


def pair_sql(major: str, minor: str) -> str:
    """``fixtures.pair_key`` in SQL."""
    return (f"CAST(CAST({major} AS HUGEINT) * CAST(10000000000000000000 AS HUGEINT) + {minor} AS DECIMAL(38, 0))")


def shuffled_cte(seed: int = 42) -> str:
    """CTEs ``sets`` and ``mcqs`` (choice sets, shuffle, gold, render)."""
    return f"""
sets AS (
  SELECT {pair_sql('doc_id', 'block')} AS seq, source, block_lines[-1] AS question,
         block_lines[1:len(block_lines) - 1] AS choices
  FROM (SELECT doc_id, source, block, lines[5 * block + 1:5 * block + 5] AS block_lines
        FROM (SELECT doc_id, source, lines, unnest(range((len(lines) - 1) // 5 + 1)) AS block
              FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents)))
),
shuf AS (
  SELECT *, {_shuffle_sql('choices', str(seed), 'seq')} AS shuffled FROM sets WHERE len(choices) > 0
),
mcqs AS (
  SELECT *, CAST(list_position(shuffled, choices[1]) - 1 AS INTEGER) AS gold_index,
         {_render_sql('question', 'shuffled')} AS mcq
  FROM shuf
)"""


def answer_cte(task: str = "answer", scoring: str = "one_based") -> str:
    """CTE ``answered`` over ``mcqs``: rule-backend reply, normalised choice."""
    tpl = P.ANSWER if task == "answer" else P.ANSWER_BATCH
    prompt = tpl.to_sql(mcq="mcq")
    base = 1 if task == "answer" else 0
    shift = {"one_based": 1, "zero_based": 0, "as_published": 2}.get(scoring)
    # rule reply: c = ascii(h[0]) % 4; number c + base unless form 2 (letter of c)
    if scoring == "letter":
        pred = "CASE WHEN form = 2 THEN c END"
    else:
        pred = f"CASE WHEN form = 2 THEN c ELSE c + {base} - {shift} END"
    return f"""
replied AS (
  SELECT *, ascii(h) % 4 AS c, ascii(substr(h, 2, 1)) % 3 AS form
  FROM (SELECT *, md5({prompt}) AS h FROM mcqs)
),
answered AS (
  SELECT *, {pred} AS predicted_index,
         coalesce(({pred}) = gold_index, false) AS correct
  FROM replied
)"""


def mcq_accuracy() -> str:
    return f"""
WITH {shuffled_cte()},
{answer_cte()},
log AS (
  SELECT question, arg_max(source, seq) AS source, arg_max(correct, seq) AS correct
  FROM answered GROUP BY question
)
SELECT source, count(*) AS n_questions, CAST(sum(CAST(correct AS BIGINT)) AS BIGINT) AS n_correct,
       CAST(sum(CAST(correct AS BIGINT)) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS accuracy_pct
FROM log GROUP BY source
"""


ORACLES = {
    "mcq_accuracy": mcq_accuracy,
}


def oracle_sql() -> dict[str, str]:
    import qbank.plans.oracle_eval  # noqa: F401  (each module registers its oracles)
    import qbank.plans.oracle_gen  # noqa: F401
    import qbank.plans.oracle_html  # noqa: F401
    import qbank.plans.oracle_variants  # noqa: F401
    import qbank.plans.oracle_chapters  # noqa: F401
    import qbank.plans.oracle_replay  # noqa: F401
    import qbank.plans.oracle_records  # noqa: F401
    return {k: f() for k, f in ORACLES.items()}


# -- E1 feed ---------------------------------------------------------------------

SECTIONS_CTE = """
sec_src AS (
  SELECT doc_id, text, source, string_split(text, chr(10)) AS ln, slug = 'self-check-questions' AS sc,
         'https://books.example.org/books/' || source || '/pages/' || CAST(doc_id AS VARCHAR) || '-'
           || slug AS chapter_url
  FROM documents, (VALUES ('self-check-questions'), ('key-terms'), ('key-concepts-and-summary')) s(slug)
),
sec_q AS (
  SELECT *, string_split(chapter_url, '/')[-1] AS chapter_name,
         string_split(chapter_url, '/')[5] AS textbook_name,
         chr(10) || CAST(doc_id % 20 + 1 AS VARCHAR) || '. ' || chr(10) || chr(10) || ln[1] || chr(10) AS q,
         array_to_string(ln[2:], chr(10)) AS a
  FROM sec_src
),
sections AS (
  SELECT doc_id,
         CASE WHEN sc THEN 'self-check-questions'
              ELSE array_to_string(list_slice(string_split(chapter_name, '-'), 2, len(string_split(chapter_name, '-'))), '') END AS section_name,
         CASE WHEN sc THEN 'Question: ' || q || ' Answer: ' || a ELSE text END AS section_text,
         chapter_name, textbook_name, chapter_url,
         CASE WHEN sc THEN q END AS question,
         CASE WHEN sc THEN a END AS answer
  FROM sec_q
)"""


def url_parts() -> str:
    return """
SELECT page_id, string_split(url, '/')[-1] AS chapter_name,
       string_split(url, '/')[5] AS textbook_name,
       array_to_string(list_slice(string_split(string_split(url, '/')[-1], '-'), 2,
                       len(string_split(string_split(url, '/')[-1], '-'))), '') AS section_name,
       left(url, length(url) - length(string_split(url, '/')[-1])) AS base_url
FROM pages"""


def sections() -> str:
    return f"WITH {SECTIONS_CTE} SELECT * FROM sections"


def section_counts() -> str:
    return f"WITH {SECTIONS_CTE} SELECT section_name, count(*) AS n_sections FROM sections GROUP BY 1"


def self_check_questions() -> str:
    return f"""WITH {SECTIONS_CTE}
SELECT doc_id, chapter_name, question, answer,
       regexp_replace(question, '^\\s*\\d+\\.\\s*', '') AS clean_question,
       CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index
FROM sections WHERE section_name = 'self-check-questions'"""


QA_CTE = f"""
qa AS (
  SELECT {pair_sql('u.conv_id', 'u.turn')} AS seq,
         chr(10) || CAST(u.turn // 2 + 1 AS VARCHAR) || '. ' || chr(10) || chr(10) || u.text || chr(10) AS question,
         a.text AS answer,
         'https://books.example.org/books/conversations/pages/' || CAST(u.conv_id AS VARCHAR) || '-self-check-questions' AS chapter_url
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'
)"""


def qa_pairs() -> str:
    return f"""WITH {QA_CTE}
SELECT seq, 'self-check-questions' AS section_name,
       'Question: ' || question || ' Answer: ' || answer AS section_text,
       string_split(chapter_url, '/')[-1] AS chapter_name,
       string_split(chapter_url, '/')[5] AS textbook_name,
       chapter_url, question, answer,
       regexp_replace(question, '^\\s*\\d+\\.\\s*', '') AS clean_question
FROM qa"""


def delivery_records() -> str:
    return f"""WITH {SECTIONS_CTE}
SELECT section_text AS text, '2024-11-01' AS date_downloaded, chapter_url AS site_url,
       chapter_name AS chapter, section_name AS section, textbook_name AS textbook,
       '2052' AS volunteer_id, 'Atlanta, USA' AS location
FROM sections"""


def rejected_choice_sets() -> str:
    return f"""WITH {shuffled_cte()}
SELECT seq, source, question, 0 AS n_choices, 'no choices' AS reject_reason
FROM sets WHERE len(choices) = 0"""


ORACLES.update({
    "rejected_choice_sets": rejected_choice_sets,
    "url_parts": url_parts,
    "sections": sections,
    "section_counts": section_counts,
    "self_check_questions": self_check_questions,
    "qa_pairs": qa_pairs,
    "delivery_records": delivery_records,
})
