"""SQL oracles of the record forms."""

from __future__ import annotations

from qbank.functions import prompts as P
from qbank.plans.oracle_gen import GEN_CTE, _sample_sql
from qbank.plans.oracle_html import DOCS, _unescape
from qbank.plans.oracle_sql import ORACLES, SECTIONS_CTE, _render_sql, shuffled_cte


def json_array_roundtrip() -> str:
    return ORACLES["sections"]()


def mcq_records() -> str:
    return f"""WITH {GEN_CTE}
SELECT q.seq, 'self-check-questions' AS type, q.question, q.answer, g.status,
       array_to_string(g.choices, chr(10) || '~' || chr(10)) AS choices, g.correct_answer,
       string_split(q.chapter_url, '/')[-1] AS chapter_name, string_split(q.chapter_url, '/')[5] AS textbook_name,
       q.chapter_url
FROM qa q JOIN (SELECT seq, status, choices, correct_answer FROM gen
                UNION ALL SELECT seq, 'too_few_keypoints', NULL, NULL FROM kp WHERE n < 3) g USING (seq)"""


def prompt_audit() -> str:
    true = P.TRUE_ANSWER.to_sql(question="question", keypoints=P.pairs_block_sql("keypoints", "keypoint", "detail"))
    mislead = P.MISLEAD_ANSWER.to_sql(question="question", new_name="nk", new_detail="nd",
                                      keypoints=P.pairs_block_sql("remaining", "keypoint", "detail"))
    return f"""WITH {GEN_CTE},
t AS (SELECT seq, md5({true}) AS h FROM ok),
w AS (SELECT seq, j, md5({mislead}) AS h FROM d2)
SELECT seq, 'extract_keypoints' AS stage, 0 AS pos, h1 AS prompt_md5,
       array_to_string(list_transform(keypoints, lambda x: x.keypoint), ',') AS told FROM ok
UNION ALL SELECT seq, 'generate_true_answer', 0, h, 'ans-' || substr(h, 1, 12) FROM t
UNION ALL SELECT seq, 'distort_keypoint', CAST(j AS INTEGER), h2, nk FROM d2
UNION ALL SELECT seq, 'generate_mislead_answer', CAST(j AS INTEGER), h, 'ans-' || substr(h, 1, 12) FROM w"""


def generation_report() -> str:
    return f"""WITH {GEN_CTE},
k(status) AS (VALUES ('ok'), ('not_all_distorted'), ('too_few_keypoints'), ('unreadable_keypoints'),
                     ('failed_true_answer'), ('failed_distortion'), ('failed_mislead_answer')),
c AS (SELECT status FROM gen UNION ALL SELECT 'too_few_keypoints' FROM kp WHERE n < 3)
SELECT k.status, count(c.status) AS n_questions FROM k LEFT JOIN c USING (status) GROUP BY k.status"""


def unshuffled_mcqs() -> str:
    return f"""WITH {shuffled_cte()}
SELECT seq, 0 AS gold_index, 'A' AS gold_letter, {_render_sql('question', 'choices')} AS mcq
FROM sets WHERE len(choices) > 0"""


def sampled_keypoints() -> str:
    return f"""
WITH src AS (SELECT doc_id AS seq, string_split(text, chr(10)) AS ln FROM documents),
sets AS (SELECT seq, list_transform(range(len(ln)), lambda i: {{'pos': i, 'keypoint':
           'kp' || CAST(CASE WHEN (i + 1) % 3 = 0 THEN i ELSE i + 1 END AS VARCHAR)}}) AS kps FROM src),
s AS (SELECT seq, unnest({_sample_sql('kps', 3, 42, 'seq')}) AS x FROM sets)
SELECT seq, CAST(x.pos AS INTEGER) AS pos, x.keypoint AS keypoint FROM s"""


def delivery_sentences() -> str:
    ws = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}]"
    return f"""WITH {SECTIONS_CTE}
SELECT array_to_string(list_filter(list_transform(string_split(section_text, '.'),
         lambda x: regexp_replace(x, '^{ws}+|{ws}+$', '', 'g')), lambda x: x <> ''), ' ') AS text,
       chapter_url AS site_url
FROM sections"""


def page_class_texts() -> str:
    ads = "regexp_extract_all(html, '<div class=\"ad\">([^<]*)</div>', 1)"
    return f"""SELECT page_id, {_unescape(f"array_to_string({ads}, '')")} AS class_text
FROM pages"""


def nested_boxes() -> str:
    return f"""WITH {DOCS},
g AS (SELECT doc_id, ln, unnest(range((n + 2) // 3)) AS pos FROM docs),
s AS (SELECT doc_id, pos, ln[3 * pos + 1] AS head, coalesce(ln[3 * pos + 2], '') AS para, coalesce(ln[3 * pos + 3], '') AS box
      FROM g)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, 0 AS nth, ['bringhome', 'clearup', 'linkup', 'os-figure'][pos % 4 + 1] AS section_name,
       box AS section_text FROM s
UNION ALL
SELECT doc_id, CAST(pos AS INTEGER), 1, CASE WHEN pos % 2 = 0 AND head <> '' THEN head ELSE 'learning obj' END,
       CASE WHEN box = '' THEN head || para ELSE replace(head || para || box, box, '') END FROM s"""


ORACLES.update({f.__name__: f for f in (json_array_roundtrip, mcq_records, prompt_audit, generation_report, unshuffled_mcqs,
                                        sampled_keypoints, delivery_sentences, page_class_texts, nested_boxes)})
