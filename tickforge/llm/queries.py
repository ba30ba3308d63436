"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, fill_middle, langid, line_dedup, media, merkle, near_dedup, near_join, packing, substring_dedup, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_media_columns": media.op5_media_columns,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_warc": warc.op8_warc,
    "op9_near_join": near_join.op9_near_join,
    "op10_packing": packing.op10_packing,
    "op11_near_dedup": near_dedup.op11_near_dedup,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE_SQL = {
    "op2_line_dedup": line_dedup.SQL,
    "op7_substring_dedup": substring_dedup.SQL,
    "op11_near_dedup": near_dedup.SQL,
    "op12_fill_middle": fill_middle.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
