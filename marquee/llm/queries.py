"""Registered queries of this folder: one ``opN_<name>`` for each operator, with production parameters."""

from __future__ import annotations

from marquee.llm import bpe, chat, embedding_dedup, infilling, minhash, packing, resampling, sql, substring_dedup, suffix_array_dedup, token_counts, topk, toxicity, url_filter


def queries() -> dict:
    return {
        "op1_fm_index_dedup": substring_dedup.op1,
        "op2_transducer_bpe": bpe.op2,
        "op3_convolutional_toxicity": toxicity.op3,
        "op4_pca_tiled_links": embedding_dedup.op4,
        "op5_cost_balanced_packing": packing.op5,
        "op6_token_counts": token_counts.op6,
        "op7_suffix_array_dedup": suffix_array_dedup.op7,
        "op8_hyperminhash_dedup": minhash.op8,
        "op9_url_filter": url_filter.op9,
        "op10_norm_sorted_topk": topk.op10,
        "op11_chat_format": chat.op11,
        "op12_fill_in_middle": infilling.op12,
        "op13_importance_resampling": resampling.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_fm_index_dedup": sql.OP1,
        "op4_pca_tiled_links": sql.OP4,
        "op8_hyperminhash_dedup": sql.OP8,
        "op10_norm_sorted_topk": sql.OP10,
        "op11_chat_format": sql.OP11,
        "op12_fill_in_middle": sql.OP12,
    }
