"""Direct distractor prompts (M10-M15) and the older feature-swap flow (M16),
with their reply shaping (P15, P16, J7). Replies are parsed with explicit
schemas; a malformed reply yields NULL fields, not a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.functions import choices as CH
from qbank.functions import prompts as P
from qbank.operators import keypoints as KP
from qbank.operators.infer import Backend, build_requests, infer

_RA = "STRUCT<reason: STRING, answer: STRING>"
DIRECT_SCHEMA = (f"question STRING, choice STRUCT<gold_choice: {_RA}, incorrect_choice_1: {_RA}, "
                 f"incorrect_choice_2: {_RA}, incorrect_choice_3: {_RA}>")
KEYPOINT_SCHEMA = "Analysis STRING, " + DIRECT_SCHEMA
STRUCTURED_SCHEMA = (f"Analysis STRING, question STRING, choices STRUCT<gold_choice: {_RA}, "
                     "incorrect_choices: ARRAY<STRUCT<key_point_changed: STRING, reason: STRING, "
                     "answer: STRING>>>")


def choices_from_struct(reply) -> F.Column:
    """Gold + the three named wrong choices, in order."""
    c = reply["choice"]
    return F.array(c["gold_choice"]["answer"], c["incorrect_choice_1"]["answer"],
                   c["incorrect_choice_2"]["answer"], c["incorrect_choice_3"]["answer"])


def label_distractors(arr) -> F.Column:
    """``incorrect_choice_{i+1}`` labels over an array of wrong choices."""
    return F.transform(arr, lambda x, i: F.struct(
        F.concat(F.lit("incorrect_choice_"), (i + 1).cast("string")).alias("label"),
        x["answer"].alias("answer")))


def _ask(df, backend, id_col, prompt, task, system, keep, name, json_mode=True, model="rule"):
    return infer(build_requests(df, request_id=id_col, prompt=prompt, task=task, system=system,
                                json_mode=json_mode, model=model, keep=keep),
                 backend, name=name)


def direct_distractors(qs: DataFrame, backend: Backend, id_col: str = "seq") -> DataFrame:
    """M10 + P16 + M14: three distractors for a question, then ask which of
    the unshuffled choices is best (text reply)."""
    r = _ask(qs, backend, id_col, P.DIRECT_DISTRACTORS.to_column(
        question="question", answer="answer", textbook="textbook_name"), "distractors",
        P.TEACHER_SYSTEM, [id_col], "distractors")
    r = r.withColumn("_r", F.from_json("response", DIRECT_SCHEMA)).select(
        id_col, F.col("_r.question").alias("reply_question"),
        choices_from_struct(F.col("_r")).alias("choices"))
    chk = _ask(r, backend, id_col, P.CHECK_CHOICE.to_column(
        numbered=CH.render_numbered(F.col("reply_question"), F.col("choices"))), "check_choice",
        P.STUDENT_SYSTEM, [id_col, "reply_question", "choices"], "check", json_mode=False)
    return chk.select(id_col, "reply_question", "choices", F.col("response").alias("check_reply"))


def term_distractors(terms: DataFrame, backend: Backend, id_cols: list[str]) -> DataFrame:
    """M11 over exploded key terms."""
    rid = F.concat_ws("#", *[F.col(c).cast("string") for c in id_cols])
    r = _ask(terms, backend, rid, P.TERM_DISTRACTORS.to_column(
        term="term", definition="definition", textbook="textbook_name"), "distractors",
        P.TEACHER_SYSTEM, id_cols + ["term"], "term-distractors")
    return r.withColumn("_r", F.from_json("response", DIRECT_SCHEMA)).select(
        *id_cols, "term", choices_from_struct(F.col("_r")).alias("choices"))


def keypoint_distractors(qs: DataFrame, backend: Backend, id_col: str = "seq") -> DataFrame:
    """Three distractors, each changing one key point (+ analysis)."""
    r = _ask(qs, backend, id_col, P.KEYPOINT_DISTRACTORS.to_column(
        question="question", answer="answer"), "keypoint_distractors", P.TEACHER_SYSTEM,
        [id_col], "kp-distractors")
    return r.withColumn("_r", F.from_json("response", KEYPOINT_SCHEMA)).select(
        id_col, F.col("_r.Analysis").alias("analysis"),
        choices_from_struct(F.col("_r")).alias("choices"))


def structured_distractors(qs: DataFrame, backend: Backend, id_col: str = "seq") -> DataFrame:
    """M13 + P15: one row per labelled wrong choice."""
    r = _ask(qs, backend, id_col, P.STRUCTURED_DISTRACTORS.to_column(
        question="question", answer="answer"), "structured_distractors", P.TEACHER_SYSTEM,
        [id_col], "structured")
    r = r.withColumn("_r", F.from_json("response", STRUCTURED_SCHEMA))
    lab = r.select(id_col, F.col("_r.choices.gold_choice.answer").alias("gold_answer"),
                   F.col("_r.choices.incorrect_choices").alias("wrong"),
                   label_distractors(F.col("_r.choices.incorrect_choices")).alias("labels"))
    return lab.select(id_col, "gold_answer", F.posexplode(F.arrays_zip("labels", "wrong")).alias(
        "pos", "z")).select(id_col, "gold_answer", "pos", F.col("z.labels.label").alias("label"),
                            F.col("z.labels.answer").alias("answer"),
                            F.col("z.wrong.key_point_changed").alias("key_point_changed"))


def question_breakdown(qs: DataFrame, backend: Backend, id_col: str = "seq") -> DataFrame:
    """Break a question into parts; variant that rewrites one part at a time."""
    a = _ask(qs, backend, id_col, P.BREAKDOWN.to_column(question="question"), "breakdown",
             P.HELPER_SYSTEM, [id_col, "question"], "breakdown", json_mode=False)
    b = _ask(a.select(id_col, "question", F.col("response").alias("breakdown")), backend, id_col,
             P.BREAKDOWN_REWRITE.to_column(question="question"), "breakdown_rewrite",
             P.HELPER_SYSTEM, [id_col, "breakdown"], "rewrite", json_mode=False)
    return b.select(id_col, "breakdown", F.col("response").alias("rewrite"))


def feature_variant(qs: DataFrame, backend: Backend, id_col: str = "seq", k: int = 3,
                    seed: int = 42) -> DataFrame:
    """Extract features -> sample k -> swap each (name taken from the
    reply, J7: a misquoted name leaves the list unchanged) -> one answer from
    the original list and one per swapped list -> seeded shuffle."""
    r = _ask(qs, backend, id_col, P.EXTRACT_FEATURES.to_column(question="question", answer="answer"),
             "extract_features", None, [id_col, "question"], "features")
    f = r.withColumn("_r", F.from_json("response", KP.FEATURES_SCHEMA)).select(
        id_col, "question", F.col("_r.Features").alias("features"))
    f = f.withColumn("n_features", F.coalesce(F.size("features"), F.lit(-1))).withColumn(
        "sampled", KP.sample_keypoints("features", k, F.lit(seed), F.col(id_col)))
    ok = f.where(F.col("sampled").isNotNull())
    bad = f.where(F.col("sampled").isNull()).select(id_col, "n_features", F.lit(
        "too_few_features").alias("status"))
    ex = ok.select(id_col, "question", "features", F.posexplode("sampled").alias("j", "sel"))
    ex = ex.withColumn("others", KP.others_by_name("features", F.col("sel.feature"), "feature"))
    sw = _ask(ex, backend, F.concat_ws("#", F.col(id_col).cast("string"), F.col("j").cast("string")),
              P.SWAP_FEATURE.to_column(question="question", name=F.col("sel.feature"),
                                       detail=F.col("sel.detail"),
                                       others=P.others_block("others", "feature", "detail", "feature")),
              "swap_feature", None, [id_col, "j", "question", "features"], "swap")
    sw = sw.withColumn("_s", F.from_json("response", KP.SWAP_SCHEMA)).withColumn(
        "swapped", KP.swap_by_name("features", F.col("_s.old_feature"), F.col("_s.new_feature"),
                                   F.col("_s.new_feature_detail")))
    # answers: j = -1 is the original list, then one per swapped list
    lists = ok.select(id_col, "question", F.lit(-1).alias("j"), F.col("features").alias("fl")) \
        .unionByName(sw.select(id_col, "question", "j", F.col("swapped").alias("fl")))
    ans = _ask(lists, backend, F.concat_ws("#", F.col(id_col).cast("string"), F.col("j").cast("string")),
               P.FEATURE_ANSWER.to_column(question="question",
                                          features=P.pairs_block("fl", "feature", "detail")),
               "feature_answer", None, [id_col, "j", "fl"], "feature-answers", json_mode=False)
    orig = ok.select(id_col, "features")
    g = (ans.join(orig, id_col)
         .groupBy(id_col).agg(
             F.array_sort(F.collect_list(F.struct("j", "response"))).alias("parts"),
             F.sum(F.when((F.col("j") >= 0) & (F.col("fl") == F.col("features")), 1)
                   .otherwise(0)).alias("n_unchanged")))
    out = g.select(id_col, F.transform("parts", lambda x: x["response"]).alias("answers"),
                   F.col("n_unchanged").cast("int").alias("n_unchanged"))
    out = out.join(ok.select(id_col, "n_features"), id_col)
    sh = CH.shuffled(F.col("answers"), F.lit(seed), F.col(id_col))
    out = (out.withColumn("shuffled", sh)
           .withColumn("gold_index", CH.gold_position("shuffled", F.element_at("answers", 1)))
           .withColumn("status", F.lit("ok")))
    return out.select(id_col, "n_features", "status", "answers", "n_unchanged", "gold_index") \
        .unionByName(bad, allowMissingColumns=True)
