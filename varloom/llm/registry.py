"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import best_fit_packing, chat_paths, difference_shards, exact_dedup, fragment_join, kernel_language, kneser_ney_toxicity, line_dedup, multi_index, piece_codec, turn_repair, warc_chain

QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup.op1_exact_dedup,
        chat_paths.op2_chat_paths,
        fragment_join.op3_fragment_join,
        kernel_language.op4_kernel_language,
        piece_codec.op5_piece_codec,
        multi_index.op6_multi_index,
        kneser_ney_toxicity.op7_kneser_ney_toxicity,
        difference_shards.op8_difference_shards,
        best_fit_packing.op9_best_fit_packing,
        warc_chain.op10_warc_chain,
        line_dedup.op11_line_dedup,
        turn_repair.op12_turn_repair,
    )
}
ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op2_chat_paths": chat_paths.ORACLE,
    "op10_warc_chain": warc_chain.ORACLE,
    "op11_line_dedup": line_dedup.ORACLE,
}
