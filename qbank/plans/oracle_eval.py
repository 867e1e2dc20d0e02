"""SQL oracles of the E3 (answer / score / label) jobs."""

from __future__ import annotations

from qbank.functions import prompts as P
from qbank.plans.oracle_sql import ORACLES, SECTIONS_CTE, answer_cte, shuffled_cte

DATA_CTE = """
data AS (
  SELECT seq, question, mcq, gold_index, CAST(row_number() OVER (ORDER BY seq) - 1 AS BIGINT) AS row_index
  FROM mcqs
)"""

LOG_CTE = """
log AS (
  SELECT question, max(seq) AS seq, arg_max(source, seq) AS source,
         arg_max(gold_index, seq) AS gold_index, arg_max(predicted_index, seq) AS predicted_index,
         arg_max(correct, seq) AS correct, min(seq) AS first_seq
  FROM answered GROUP BY question
)"""


def shuffled_mcqs() -> str:
    return f"""WITH {shuffled_cte()}
SELECT seq, source, question, gold_index, substr('ABCDEFGHIJK', gold_index + 1, 1) AS gold_letter,
       len(list_filter(choices, lambda x: x = choices[1])) > 1 AS gold_ambiguous, mcq
FROM mcqs"""


def answer_log_table() -> str:
    return f"WITH {shuffled_cte()}, {answer_cte()}, {LOG_CTE} SELECT * FROM log"


def enriched_log() -> str:
    return f"""WITH {shuffled_cte()}, {answer_cte()}, {LOG_CTE}, {DATA_CTE},
last AS (SELECT question, arg_max(mcq, seq) AS mcq, arg_max(row_index, seq) AS row_index
         FROM data GROUP BY question)
SELECT question, l.predicted_index, l.gold_index, l.correct, last.mcq, last.row_index
FROM (SELECT question, predicted_index, gold_index, correct FROM log) l
FULL OUTER JOIN last USING (question)"""


def spot_check() -> str:
    return f"""WITH {shuffled_cte()}, {answer_cte()}, {LOG_CTE}, {DATA_CTE},
n AS (SELECT count(*) AS n FROM data),
picks AS (
  SELECT r.range AS draw,
         CAST(('0x' || substr(md5('7:' || CAST(r.range AS VARCHAR)), 1, 8))::BIGINT % n.n AS BIGINT) AS row_index
  FROM range(1, 11) r, n
)
SELECT p.draw, p.row_index, d.question, l.gold_index + 1 AS gold_position, l.predicted_index, l.correct
FROM picks p JOIN data d ON d.row_index = p.row_index
LEFT JOIN log l ON l.question = d.question"""


def pick_row() -> str:
    return f"""WITH {shuffled_cte()}, {DATA_CTE}
SELECT seq, question, mcq, row_index FROM data WHERE row_index = 562"""


def first_rows() -> str:
    return f"""WITH {shuffled_cte()}
SELECT seq, question, gold_index FROM mcqs ORDER BY seq LIMIT 10"""


def classified_questions() -> str:
    prompt = P.CLASSIFY.to_sql(question="clean_question")
    return f"""WITH {SECTIONS_CTE},
sc AS (
  SELECT doc_id, question, regexp_replace(question, '^\\s*\\d+\\.\\s*', '') AS clean_question
  FROM sections WHERE section_name = 'self-check-questions'
),
lab AS (
  SELECT doc_id, question, 'rule:' || substr(h, 1, 8) AS reason,
         CAST([0, 1, 2, 3, 9][ascii(h) % 5 + 1] AS INTEGER) AS completeness_choice,
         CAST([1, 2, 3, 4, 5, 9, 8][ascii(substr(h, 2, 1)) % 7 + 1] AS INTEGER) AS type_choice,
         CAST(ascii(substr(h, 3, 1)) % 2 AS INTEGER) AS mcq_choice
  FROM (SELECT *, md5({prompt}) AS h FROM sc)
)
SELECT question, max(doc_id) AS doc_id,
       arg_max(reason, doc_id) AS completeness_reason, arg_max(reason, doc_id) AS type_reason,
       arg_max(reason, doc_id) AS mcq_reason,
       arg_max(completeness_choice, doc_id) AS completeness_choice,
       arg_max(type_choice, doc_id) AS type_choice, arg_max(mcq_choice, doc_id) AS mcq_choice,
       arg_max(type_choice <> 8, doc_id) AS codes_valid
FROM lab GROUP BY question"""


BATCH_CTE = """
breq AS (
  SELECT question, arg_max(mcq, seq) AS mcq, arg_max(gold_index, seq) AS gold_index
  FROM mcqs GROUP BY question
)"""


def batch_request_fields() -> str:
    prompt = P.ANSWER_BATCH.to_sql(mcq="mcq")
    return f"""WITH {shuffled_cte()}, {BATCH_CTE}
SELECT sha256(question) AS custom_id, question, gold_index, 'rule-batch' AS model,
       1000 AS max_tokens, md5({prompt}) AS prompt_md5
FROM breq"""


def batch_accuracy() -> str:
    prompt = P.ANSWER_BATCH.to_sql(mcq="mcq")
    return f"""WITH {shuffled_cte()}, {BATCH_CTE},
scored AS (SELECT gold_index, ascii(md5({prompt})) % 4 AS c FROM breq)
SELECT count(*) AS n_requests, count(*) AS n_succeeded,
       CAST(sum(CAST(c = gold_index AS BIGINT)) AS BIGINT) AS n_correct,
       CAST(sum(CAST(c = gold_index AS BIGINT)) AS DOUBLE) * 100.0 / count(*) AS accuracy_pct
FROM scored"""


ORACLES.update({
    "shuffled_mcqs": shuffled_mcqs,
    "answer_log": answer_log_table,
    "enriched_log": enriched_log,
    "spot_check": spot_check,
    "pick_row": pick_row,
    "first_rows": first_rows,
    "classified_questions": classified_questions,
    "batch_requests": batch_request_fields,
    "batch_accuracy": batch_accuracy,
})
