"""Prompt templates of the model stages (M1-M16), written from each stage's slots
and reply keys. Block slots (lists of key points) are rendered by the ``*_block``
helpers, as Spark columns and as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qbank.functions.template import Template, sql_literal
from qbank.functions.util import as_col

STUDENT_SYSTEM = "Role: test taker. Output: JSON only."
TEACHER_SYSTEM = "Role: item writer for exams. Output: JSON only."
HELPER_SYSTEM = "Role: text editor. Output: what the task line names."


def _reply(**keys: str) -> str:
    """The line that names the reply's keys and their types."""
    return "Output keys: " + ", ".join(f"{k} ({t})" for k, t in keys.items()) + ".\n"


# M7: answer a shuffled question (letters shown, number asked for).
ANSWER = Template("Task: solve this item.\n{mcq}\n" + _reply(reason="text", choice="number, the first line is 1"))

# M9: the batch form asks for a 0-based integer.
ANSWER_BATCH = Template("Task: solve this item.\n{mcq}\n" + _reply(reason="text", choice="number, the first line is 0"))

# M8: classify a cleaned question. Code domains are fixed values.
CLASSIFY_SYSTEM = (
    "Role: cataloguer of exercise texts. Every label is a number with a short note.\n"
    "completeness: 0 = self-contained; 1 = sentence cut off; 2 = refers to a figure or table "
    "that is absent; 3 = refers to another passage; 9 = any other gap.\n"
    "type: 1 = concept; 2 = calculation; 3 = true or false; 4 = drawing; 5 = argument; 9 = rest.\n"
    "mcq: 1 = could be asked with options; 0 = could not.")
CLASSIFY = Template("Task: label this exercise.\n{question}\n" + _reply(
    completeness_reason="text", completeness_choice="number", type_reason="text", type_choice="number",
    mcq_reason="text", mcq_choice="number"))

# M1: key points of a question and its gold answer.
EXTRACT_KEYPOINTS = Template(
    "Task: take this solved exercise apart into its ideas (5 or more, no name twice).\n"
    "Exercise: {question}\nSolution: {answer}\n"
    + _reply(Analysis="text", Keypoints="array of objects with keypoint and detail, both text"))

# M2: distort the selected key point.
DISTORT_KEYPOINT = Template(
    "Task: falsify one idea of this exercise; the rest is context.\n"
    "Exercise: {question}\nSelected key point: {name}\nIts detail: {detail}\n{others}"
    + _reply(analysis_1="text", analysis_2="text", new_keypoint="text", new_keypoint_detail="text",
             old_keypoint="text", old_keypoint_detail="text"))

# M3: gold answer from all key points.
TRUE_ANSWER = Template(
    "Task: write the solution in a single paragraph.\nExercise: {question}\nIdeas to use:\n{keypoints}")

# M4: misleading answer led by the distorted key point.
MISLEAD_ANSWER = Template(
    "Task: write a solution in a single paragraph in which the first idea holds, even against the others.\n"
    "Exercise: {question}\nFirst idea:\n{new_name}: {new_detail}\nMore ideas:\n{keypoints}")

_FOUR = dict(question="text", choice="object with gold_choice, incorrect_choice_1, incorrect_choice_2 and "
                                     "incorrect_choice_3, each an object with reason and answer")

# One fully and two partly wrong choices.
DIRECT_DISTRACTORS = Template(
    "Task: invent three false solutions; number 1 false throughout, 2 and 3 false in one respect.\n"
    "Exercise: {question}\nSolution: {answer}\nBook: {textbook}\n" + _reply(**_FOUR))
TERM_DISTRACTORS = Template(
    "Task: invent three false meanings; number 1 false throughout, 2 and 3 false in one respect.\n"
    "Entry: {term}\nMeaning: {definition}\nBook: {textbook}\n" + _reply(**_FOUR))

# Three distractors, each changing one key point.
KEYPOINT_DISTRACTORS = Template(
    "Task: pick three ideas of this solved exercise; per idea, invent a false solution that gets only it wrong.\n"
    "Exercise: {question}\nSolution: {answer}\n" + _reply(Analysis="text", **_FOUR))

# Two-step structured distractors.
STRUCTURED_DISTRACTORS = Template(
    "Task: first list three ideas of this solved exercise, then per idea a false solution that keeps the rest.\n"
    "Exercise: {question}\nSolution: {answer}\n" + _reply(
        Analysis="text", question="text",
        choices="object with gold_choice (reason, answer) and incorrect_choices, an array of objects with "
                "key_point_changed, reason and answer"))

# Which unshuffled choice is best (text reply).
CHECK_CHOICE = Template("Task: name the right line and say why.\n{numbered}\n")

# Question breakdown, and the variant that rewrites one part at a time.
BREAKDOWN = Template("Task: list the sub-questions of this exercise.\nExercise: {question}\n")
BREAKDOWN_REWRITE = Template(
    "Task: list the sub-questions of this exercise; for each, write the exercise anew with only it changed.\n"
    "Exercise: {question}\n")

# The older feature flow.
EXTRACT_FEATURES = Template(
    "Task: take this solved exercise apart into its features.\n"
    "Exercise: {question}\nSolution: {answer}\n"
    + _reply(Analysis="text", Features="array of objects with feature and detail, both text"))
SWAP_FEATURE = Template(
    "Task: falsify one feature of this exercise; the rest is context.\n"
    "Exercise: {question}\nSelected feature: {name}\nIts detail: {detail}\n{others}"
    + _reply(analysis_1="text", analysis_2="text", new_feature="text", new_feature_detail="text",
             old_feature="text"))
FEATURE_ANSWER = Template(
    "Task: write a solution in a single paragraph that has these features.\n{features}"
    "Exercise: {question}\n")


# -- block slots ---------------------------------------------------------------

def pairs_block(arr, name_field: str, detail_field: str, prefix: str = "",
                sep: str = ": ") -> Column:
    """``{prefix}{name}{sep}{detail}\\n`` for each element, in array order."""
    return F.array_join(
        F.transform(as_col(arr), lambda k: F.concat(F.lit(prefix), k[name_field], F.lit(sep),
                                                     k[detail_field], F.lit("\n"))), "")


def pairs_block_sql(arr_sql: str, name_field: str, detail_field: str, prefix: str = "",
                    sep: str = ": ") -> str:
    return (f"array_to_string(list_transform({arr_sql}, lambda k: {sql_literal(prefix)} || "
            f"k.{name_field} || {sql_literal(sep)} || k.{detail_field} || chr(10)), '')")


def others_block(arr, name_field: str, detail_field: str, label: str) -> Column:
    return pairs_block(arr, name_field, detail_field, prefix=f"Other {label}: ",
                       sep="\nDetail: ")


def others_block_sql(arr_sql: str, name_field: str, detail_field: str, label: str) -> str:
    return pairs_block_sql(arr_sql, name_field, detail_field, prefix=f"Other {label}: ",
                           sep="\nDetail: ")
