"""Queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tessera.llm import history, language, leakage, lookalike, ocr, overlap, packing, pairs, pii, tokens

QUERIES = {"p1_found": pairs.p1_found, "p2_found": ocr.p2_found, "p2_paragraphs": ocr.p2_paragraphs, "p3_found": language.p3_found, "p3_segments": language.p3_segments, "p4_found": lookalike.p4_found, "p4_form": lookalike.p4_form, "p5_found": history.p5_found, "p6_found": overlap.p6_found, "p6_report": overlap.p6_report, "p7_budget": tokens.p7_budget, "p7_documents": tokens.p7_documents, "p8_containers": packing.p8_containers, "p8_fill": packing.p8_fill, "p9_found": leakage.p9_found, "p9_report": leakage.p9_report, "p10_found": pii.p10_found, "p10_replaced": pii.p10_replaced}
SQL: dict[str, str] = {}
