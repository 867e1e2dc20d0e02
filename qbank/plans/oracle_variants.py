"""SQL oracles of the distractor variants (rule backend restated)."""

from __future__ import annotations

from qbank.functions import prompts as P
from qbank.plans.oracle_gen import _sample_sql
from qbank.plans.oracle_html import DOCS, _s
from qbank.plans.oracle_sql import ORACLES, QA_CTE, _shuffle_sql

QS = f"""{QA_CTE.strip()},
qs AS (SELECT seq, question, answer, string_split(chapter_url, '/')[5] AS textbook_name FROM qa)"""

JOIN_SEP = "chr(10) || '~' || chr(10)"


def _choices(h: str) -> str:
    return (f"['gold-' || substr({h}, 1, 8), 'wrong1-' || substr({h}, 1, 8), "
            f"'wrong2-' || substr({h}, 1, 8), 'wrong3-' || substr({h}, 1, 8)]")


def _numbered(q: str, ch: str) -> str:
    return (f"'Question: ' || {q} || chr(10) || array_to_string(list_transform(range(len({ch})), "
            f"lambda i: 'Choice ' || CAST(i + 1 AS VARCHAR) || ': ' || {ch}[i + 1]), chr(10))")


def direct_distractors() -> str:
    prompt = P.DIRECT_DISTRACTORS.to_sql(question="question", answer="answer", textbook="textbook_name")
    return f"""WITH {QS},
r AS (SELECT seq, md5({prompt}) AS h FROM qs),
c AS (SELECT seq, 'q-' || substr(h, 1, 8) AS reply_question, {_choices('h')} AS choices FROM r)
SELECT seq, reply_question, array_to_string(choices, {JOIN_SEP}) AS choices_joined,
       'ans-' || substr(md5({P.CHECK_CHOICE.to_sql(numbered=_numbered('reply_question', 'choices'))}), 1, 12) AS check_reply
FROM c"""


def keypoint_distractors() -> str:
    prompt = P.KEYPOINT_DISTRACTORS.to_sql(question="question", answer="answer")
    return f"""WITH {QS}, r AS (SELECT seq, md5({prompt}) AS h FROM qs)
SELECT seq, 'rule:' || substr(h, 1, 8) AS analysis, array_to_string({_choices('h')}, {JOIN_SEP}) AS choices_joined
FROM r"""


def structured_distractors() -> str:
    prompt = P.STRUCTURED_DISTRACTORS.to_sql(question="question", answer="answer")
    return f"""WITH {QS},
r AS (SELECT seq, md5({prompt}) AS h FROM qs),
e AS (SELECT seq, h, unnest(range(2 + ascii(h) % 3)) AS pos FROM r)
SELECT seq, 'gold-' || substr(h, 1, 8) AS gold_answer, CAST(pos AS INTEGER) AS pos,
       'incorrect_choice_' || CAST(pos + 1 AS VARCHAR) AS label,
       'wrong' || CAST(pos + 1 AS VARCHAR) || '-' || substr(h, 1, 8) AS answer,
       'kp' || CAST(pos + 1 AS VARCHAR) AS key_point_changed
FROM e"""


def question_breakdowns() -> str:
    return f"""WITH {QS}
SELECT seq, 'ans-' || substr(md5({P.BREAKDOWN.to_sql(question='question')}), 1, 12) AS breakdown,
       'ans-' || substr(md5({P.BREAKDOWN_REWRITE.to_sql(question='question')}), 1, 12) AS rewrite
FROM qs"""


def feature_variant() -> str:
    fa = lambda lst: ("'ans-' || substr(md5(" + P.FEATURE_ANSWER.to_sql(
        question="question", features=P.pairs_block_sql(lst, "feature", "detail")) + "), 1, 12)")
    swap = P.SWAP_FEATURE.to_sql(question="question", name="sel.feature", detail="sel.detail",
                                 others=P.others_block_sql("others", "feature", "detail", "feature"))
    return f"""WITH {QS},
e AS (SELECT seq, question, md5({P.EXTRACT_FEATURES.to_sql(question='question', answer='answer')}) AS h1 FROM qs),
e2 AS (SELECT *, CAST(2 + ascii(h1) % 6 AS INTEGER) AS n, ascii(substr(h1, 2, 1)) % 4 AS dm FROM e),
f AS (
  SELECT *, list_transform(range(1, n + 1), lambda j: {{
      'feature': 'f' || CAST(CASE WHEN dm = 0 AND n >= 4 AND j = n THEN 1
                                  WHEN dm = 1 AND n >= 3 AND j = 2 THEN 1 ELSE j END AS VARCHAR),
      'detail': substr(md5(h1 || CAST(j AS VARCHAR)), 1, 12)}}) AS features
  FROM e2
),
ok AS (SELECT *, {_sample_sql('features', 3, 42, 'seq')} AS sampled FROM f WHERE n >= 3),
ex AS (SELECT seq, question, features, sampled, unnest(range(3)) AS j FROM ok),
ex2 AS (SELECT seq, question, features, j, sampled[j + 1] AS sel,
               list_filter(features, lambda x: x.feature IS DISTINCT FROM sampled[j + 1].feature) AS others FROM ex),
sw AS (SELECT *, md5({swap}) AS h2 FROM ex2),
sw2 AS (
  SELECT seq, question, features, j,
         CASE WHEN ascii(substr(h2, 3, 1)) % 5 = 0 THEN upper(sel.feature) ELSE sel.feature END AS old,
         'new-' || substr(h2, 1, 6) AS nf, substr(h2, 7, 12) AS nd
  FROM sw
),
sw3 AS (
  SELECT seq, question, features, j,
         list_transform(features, lambda x: CASE WHEN x.feature = old THEN {{'feature': nf, 'detail': nd}} ELSE x END) AS fl
  FROM sw2
),
lists AS (
  SELECT seq, question, features, -1 AS j, features AS fl FROM ok
  UNION ALL SELECT seq, question, features, j, fl FROM sw3
),
ans AS (SELECT seq, j, {fa('fl')} AS a, (j >= 0 AND fl = features) AS same FROM lists),
g AS (SELECT seq, list(a ORDER BY j) AS answers, CAST(sum(CAST(same AS INTEGER)) AS INTEGER) AS n_unchanged FROM ans GROUP BY seq)
SELECT g.seq, ok.n AS n_features, 'ok' AS status, array_to_string(answers, {JOIN_SEP}) AS answers_joined,
       n_unchanged, CAST(list_position({_shuffle_sql('answers', '42', 'g.seq')}, answers[1]) - 1 AS INTEGER) AS gold_index
FROM g JOIN ok USING (seq)
UNION ALL
SELECT seq, n, 'too_few_features', NULL, NULL, NULL FROM f WHERE n < 3"""


def term_distractors() -> str:
    prompt = P.TERM_DISTRACTORS.to_sql(term="term", definition="definition", textbook="textbook_name")
    return f"""WITH {DOCS},
p AS (SELECT doc_id, source, ln, unnest(range(n // 2)) AS pos FROM docs),
t AS (
  SELECT CAST(doc_id AS VARCHAR) || '-key-terms' AS chapter_name, CAST(pos AS INTEGER) AS pos,
         'econ-' || source AS textbook_name, {_s('ln[2 * pos + 1]')} AS term, {_s('ln[2 * pos + 2]')} AS definition
  FROM p WHERE ln[2 * pos + 1] <> '' AND ln[2 * pos + 2] <> ''
)
SELECT chapter_name, pos, term, array_to_string({_choices(f'md5({prompt})')}, {JOIN_SEP}) AS choices_joined
FROM t"""


ORACLES.update({
    "direct_distractors": direct_distractors,
    "keypoint_distractors": keypoint_distractors,
    "structured_distractors": structured_distractors,
    "question_breakdowns": question_breakdowns,
    "feature_variant": feature_variant,
    "term_distractors": term_distractors,
})


def _stream_oracles():
    from qbank.plans.oracle_eval import batch_accuracy
    from qbank.plans.oracle_html import main_texts
    from qbank.plans.oracle_eval import answer_log_table
    from qbank.plans.oracle_gen import generated_mcqs
    from qbank.plans.oracle_sql import delivery_records, sections
    ORACLES.update({"stream_main_texts": main_texts, "stream_batch_accuracy": batch_accuracy,
                    "feed_roundtrip": sections, "delivery_roundtrip": delivery_records,
                    "answer_log_roundtrip": answer_log_table, "generated_roundtrip": generated_mcqs})
    from qbank.plans.oracle_eval import shuffled_mcqs
    ORACLES["shuffled_roundtrip"] = shuffled_mcqs


_stream_oracles()
