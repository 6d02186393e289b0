"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import byte_bpe, collocations, decontaminate, fill_in_middle, license_scan, line_dedup, near_dup, quality, quality_rules, sharding, token_count, topk, warc

_MODULES = {
    "op1_line_dedup": line_dedup,
    "op2_license_scan": license_scan,
    "op3_decontaminate": decontaminate,
    "op4_token_count": token_count,
    "op5_warc_revisits": warc,
    "op6_byte_bpe": byte_bpe,
    "op7_quality": quality,
    "op8_topk": topk,
    "op9_near_dup": near_dup,
    "op10_sharding": sharding,
    "op11_quality_rules": quality_rules,
    "op12_fill_in_middle": fill_in_middle,
    "op13_collocations": collocations,
}


def queries() -> dict:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in _MODULES.items() if hasattr(module, "SQL")}
