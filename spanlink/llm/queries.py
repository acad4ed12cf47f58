"""Queries of this package and their SQL, by name."""

from __future__ import annotations

from spanlink.llm import collocations, decontaminate, mixing, permutation, quality, recompress, search, secrets, simhash, substrings, tokens, toxicity, warc

QUERIES = {
    "op1_warc_salvage": warc.op1_warc_salvage,
    "op2_permutation_index": permutation.op2_permutation_index,
    "op3_source_mixing": mixing.op3_source_mixing,
    "op4_quality": quality.op4_quality,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_suffix_dedup": substrings.op6_suffix_dedup,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_token_output": tokens.op8_token_output,
    "op9_simhash_dedup": simhash.op9_simhash_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": collocations.op11_collocations,
    "op12_lexical_search": search.op12_lexical_search,
    "op13_recompression_dedup": recompress.op13_recompression_dedup,
}

ORACLE_SQL = {
    "op1_warc_salvage": warc.OP1_SQL,
    "op3_source_mixing": mixing.OP3_SQL,
    "op5_decontamination": decontaminate.OP5_SQL,
    "op6_suffix_dedup": substrings.OP6_SQL,
    "op7_secret_scan": secrets.OP7_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_lexical_search": search.OP12_SQL,
    "op13_recompression_dedup": recompress.OP13_SQL,
}
