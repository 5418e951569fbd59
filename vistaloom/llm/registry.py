"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from vistaloom.llm import decontam, htmltext, langid, mixing, pii, quality, secrets, simhash, substring, warc

QUERIES = {
    "op1_substring_dedup": substring.query,
    "op2_quality_rules": quality.query,
    "op3_warc_revisits": warc.query,
    "op4_simhash": simhash.query,
    "op5_decontamination": decontam.query,
    "op6_secret_scan": secrets.query,
    "op7_html_text": htmltext.query,
    "op8_language_id": langid.query,
    "op9_pii": pii.query,
    "op10_source_mixing": mixing.query,
    "quality_ablations": quality.ablations,
}
ORACLE_SQL = {
    "op1_substring_dedup": substring.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op3_warc_revisits": warc.ORACLE,
    "op5_decontamination": decontam.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
    "quality_ablations": quality.ABLATION,
}
