"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import align, bpe, chat, licenses, lines, minhash, mixing, quality, repair, repeats, simhash, topk, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_minhash": minhash.op2_minhash,
        "op3_repeats": repeats.op3_repeats,
        "op4_line_dedup": lines.op4_line_dedup,
        "op5_quality": quality.op5_quality,
        "op6_simhash": simhash.op6_simhash,
        "op7_bpe": bpe.op7_bpe,
        "op8_chat_formatting": chat.op8_chat_formatting,
        "op9_top_k": topk.op9_top_k,
        "op10_license_scan": licenses.op10_license_scan,
        "op11_repair": repair.op11_repair,
        "op12_align": align.op12_align,
        "op13_toxicity": toxicity.op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": lines.OP4_SQL,
        "op8_chat_formatting": chat.OP8_SQL,
        "op9_top_k": topk.OP9_SQL,
        "op11_repair": repair.OP11_SQL,
    }
