"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from qbank.plans import chapters as CH
from qbank.plans import crawl as CR
from qbank.plans import evaluation as EVP
from qbank.plans import exports as EXP
from qbank.plans import feed as FD
from qbank.plans import generation as GEN
from qbank.plans import records as REC
from qbank.plans import replay as REP
from qbank.plans import robust as ROB
from qbank.plans import streams as STR
from qbank.plans import variants as VAR

QUERIES = {
    "mcq_accuracy": EVP.mcq_accuracy,
    "url_parts": FD.url_parts,
    "sections": FD.sections,
    "section_counts": FD.section_counts,
    "self_check_questions": FD.self_check_questions,
    "qa_pairs": FD.qa_pairs,
    "delivery_records": FD.delivery_records,
    "shuffled_mcqs": EVP.shuffled_mcqs,
    "rejected_choice_sets": EVP.rejected_choice_sets,
    "answer_log": EVP.answer_log_table,
    "enriched_log": EVP.enriched_log,
    "spot_check": EVP.spot_check,
    "pick_row": EVP.pick_row,
    "first_rows": EVP.first_rows,
    "classified_questions": EVP.classified_questions,
    "batch_requests": EVP.batch_request_fields,
    "batch_accuracy": EVP.batch_accuracy,
    "keypoint_sampling": GEN.keypoint_sampling,
    "generated_mcqs": GEN.generated_mcqs,
    "generated_shuffled": GEN.generated_shuffled,
    "generation_report": GEN.generation_report,
    "recorded_requests": REP.recorded_requests,
    "recorded_replies": REP.recorded_replies,
    "recorded_accuracy": REP.recorded_accuracy,
    "cached_replies": REP.cached_replies,
    "toc_links": CR.toc_links,
    "econ_key_terms": CR.econ_key_terms,
    "econ_key_terms_rows": CR.econ_key_terms_rows,
    "econ_key_concepts": CR.econ_key_concepts,
    "econ_key_concepts_rows": CR.econ_key_concepts_rows,
    "econ_self_check": CR.econ_self_check,
    "econ_self_check_rows": CR.econ_self_check_rows,
    "main_texts": CR.main_texts,
    "finance_key_terms": CR.finance_key_terms,
    "finance_summary": CR.finance_summary,
    "finance_multiple_choice": CR.finance_multiple_choice,
    "finance_review": CR.finance_review,
    "finance_problems": CR.finance_problems,
    "finance_problems_rows": CR.finance_problems_rows,
    "finance_chapters": CR.finance_chapters,
    "crawl_section_counts": CR.crawl_section_counts,
    "seeded_section_counts": ROB.seeded_section_counts,
    "crawl_quarantine": ROB.crawl_quarantine,
    "damaged_main_texts": ROB.damaged_main_texts,
    "page_stats": CR.page_stats,
    "page_article_text": CR.page_article_text,
    "econ_chapter_sections": CH.econ_chapter_sections,
    "econ_chapter_intro": CH.econ_chapter_intro,
    "econ_problem_texts": CH.econ_problem_texts,
    "econ_chapter_feed": CH.econ_chapter_feed,
    "direct_distractors": VAR.direct_distractors,
    "keypoint_distractors": VAR.keypoint_distractors,
    "structured_distractors": VAR.structured_distractors,
    "question_breakdowns": VAR.question_breakdowns,
    "feature_variant": VAR.feature_variant,
    "term_distractors": VAR.term_distractors,
    "stream_main_texts": STR.stream_main_texts,
    "stream_self_check": STR.stream_self_check,
    "stream_section_counts": STR.stream_section_counts,
    "stream_waiting_answers": STR.stream_waiting_answers,
    "stream_last_results": STR.stream_last_results,
    "stream_batch_accuracy": STR.stream_batch_accuracy,
    "feed_roundtrip": EXP.feed_roundtrip,
    "delivery_roundtrip": EXP.delivery_roundtrip,
    "answer_log_roundtrip": EXP.answer_log_roundtrip,
    "generated_roundtrip": EXP.generated_roundtrip,
    "shuffled_roundtrip": EXP.shuffled_roundtrip,
    "json_array_roundtrip": REC.json_array_roundtrip,
    "mcq_records": REC.mcq_records,
    "prompt_audit": REC.prompt_audit,
    "unshuffled_mcqs": REC.unshuffled_mcqs,
    "sampled_keypoints": REC.sampled_keypoints,
    "delivery_sentences": REC.delivery_sentences,
    "page_class_texts": REC.page_class_texts,
    "nested_boxes": REC.nested_boxes,
}
