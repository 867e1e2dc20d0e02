"""SQL oracles of the E2 (key points -> MCQ) jobs, rule backend replies
restated in SQL."""

from __future__ import annotations

from qbank.functions import prompts as P
from qbank.plans.oracle_sql import ORACLES, QA_CTE, _render_sql, _shuffle_sql


def _sample_sql(arr: str, k: int, seed: int, row_id: str) -> str:
    return (f"list_transform(list_slice(list_sort(list_transform(range(len({arr})), "
            f"lambda i: {{'k': md5('{seed}:' || CAST({row_id} AS VARCHAR) || ':' || CAST(i AS VARCHAR)), "
            f"'i': i, 'x': {arr}[i + 1]}})), 1, {k}), lambda s: s.x)")


def keypoint_sampling() -> str:
    return f"""
WITH src AS (
  SELECT doc_id AS seq, string_split(text, chr(10)) AS ln FROM documents
),
sets AS (
  SELECT seq, list_transform(range(len(ln)), lambda i: {{'keypoint': 'kp' || CAST(CASE WHEN (i + 1) % 3 = 0 THEN i ELSE i + 1 END AS VARCHAR), 'detail': ln[i + 1]}}) AS keypoints
  FROM src
),
s AS (SELECT seq, keypoints, {_sample_sql('keypoints', 3, 42, 'seq')} AS sampled FROM sets),
ex AS (SELECT seq, keypoints, sampled, unnest(range(len(sampled))) AS j FROM s),
ex2 AS (SELECT seq, keypoints, sampled, j, sampled[j + 1] AS sel FROM ex),
tot AS (
  SELECT seq, sum(len(keypoints) - len(list_filter(keypoints, lambda x: x.keypoint IS DISTINCT FROM sel.keypoint))) AS n_removed_total
  FROM ex2 GROUP BY seq
)
SELECT ex2.seq, CAST(j AS INTEGER) AS j, sel.keypoint AS keypoint,
       CAST(len(list_filter(keypoints, lambda x: NOT (x IS NOT DISTINCT FROM sel))) AS INTEGER) AS n_others,
       CAST(len(list_filter(keypoints, lambda x: x.keypoint IS DISTINCT FROM sel.keypoint)) AS INTEGER) AS n_remaining,
       tot.n_removed_total = 3 AS all_distorted, 'ok' AS status
FROM ex2 JOIN tot USING (seq) WHERE len(keypoints) >= 3
UNION ALL
SELECT seq, NULL, NULL, NULL, NULL, NULL, 'too_few_keypoints' FROM sets WHERE len(keypoints) < 3"""


GEN_CTE = f"""
{QA_CTE.strip()},
e AS (SELECT seq, question, answer, md5({P.EXTRACT_KEYPOINTS.to_sql(question='question', answer='answer')}) AS h1 FROM qa),
e2 AS (SELECT *, CAST(2 + ascii(h1) % 6 AS INTEGER) AS n, ascii(substr(h1, 2, 1)) % 4 AS dm FROM e),
kp AS (
  SELECT *, list_transform(range(1, n + 1), lambda j: {{
      'keypoint': 'kp' || CAST(CASE WHEN dm = 0 AND n >= 4 AND j = n THEN 1
                                    WHEN dm = 1 AND n >= 3 AND j = 2 THEN 1 ELSE j END AS VARCHAR),
      'detail': substr(md5(h1 || CAST(j AS VARCHAR)), 1, 12)}}) AS keypoints
  FROM e2
),
ok AS (SELECT *, {_sample_sql('keypoints', 3, 42, 'seq')} AS sampled FROM kp WHERE n >= 3),
tr AS (
  SELECT seq, 'ans-' || substr(md5({P.TRUE_ANSWER.to_sql(question='question', keypoints=P.pairs_block_sql('keypoints', 'keypoint', 'detail'))}), 1, 12) AS true_answer
  FROM ok
),
ex AS (SELECT seq, question, keypoints, sampled, unnest(range(len(sampled))) AS j FROM ok),
ex2 AS (
  SELECT seq, question, keypoints, j, sampled[j + 1] AS sel,
         list_filter(keypoints, lambda x: NOT (x IS NOT DISTINCT FROM sampled[j + 1])) AS others
  FROM ex
),
d AS (
  SELECT *, md5({P.DISTORT_KEYPOINT.to_sql(question='question', name='sel.keypoint', detail='sel.detail', others=P.others_block_sql('others', 'keypoint', 'detail', 'key point'))}) AS h2,
         list_filter(keypoints, lambda x: x.keypoint IS DISTINCT FROM sel.keypoint) AS remaining
  FROM ex2
),
d2 AS (SELECT *, 'new-' || substr(h2, 1, 6) AS nk, substr(h2, 7, 12) AS nd FROM d),
m AS (
  SELECT seq, j, len(keypoints) - len(remaining) AS n_removed,
         'ans-' || substr(md5({P.MISLEAD_ANSWER.to_sql(question='question', new_name='nk', new_detail='nd', keypoints=P.pairs_block_sql('remaining', 'keypoint', 'detail'))}), 1, 12) AS answer
  FROM d2
),
g AS (SELECT seq, list(answer ORDER BY j) AS answers, CAST(sum(n_removed) AS INTEGER) AS n_removed_total FROM m GROUP BY seq),
gen AS (
  SELECT ok.seq, ok.n AS n_keypoints,
         CASE WHEN g.n_removed_total <> 3 THEN 'not_all_distorted' ELSE 'ok' END AS status,
         'A' AS correct_answer, [tr.true_answer] || g.answers AS choices, g.n_removed_total
  FROM ok JOIN tr USING (seq) JOIN g USING (seq)
)"""


def generated_mcqs() -> str:
    return f"""WITH {GEN_CTE}
SELECT seq, n_keypoints, status, correct_answer,
       array_to_string(choices, chr(10) || '~' || chr(10)) AS choices_joined,
       n_removed_total, 8 AS n_audit
FROM gen
UNION ALL
SELECT seq, n AS n_keypoints, 'too_few_keypoints' AS status, NULL AS correct_answer,
       NULL AS choices_joined, NULL AS n_removed_total, NULL AS n_audit
FROM kp WHERE n < 3"""


def generated_shuffled() -> str:
    return f"""WITH {GEN_CTE},
sh AS (
  SELECT seq, question, choices, {_shuffle_sql('choices', '42', 'seq')} AS shuffled
  FROM gen JOIN (SELECT seq, question FROM qa) USING (seq) WHERE status = 'ok'
),
gm AS (SELECT *, CAST(list_position(shuffled, choices[1]) - 1 AS INTEGER) AS gold_index FROM sh)
SELECT seq, gold_index, substr('ABCDEFGHIJK', gold_index + 1, 1) AS gold_letter,
       len(list_filter(choices, lambda x: x = choices[1])) > 1 AS gold_ambiguous,
       {_render_sql('question', 'shuffled')} AS mcq
FROM gm"""


ORACLES.update({
    "keypoint_sampling": keypoint_sampling,
    "generated_mcqs": generated_mcqs,
    "generated_shuffled": generated_shuffled,
})
