"""Registered queries of the training-data operators, and the SQL of those that have one."""

from __future__ import annotations

from vintara.llm import (
    bitplane, bottomk, bytebpe, collocations, crf, decontaminate, hilbert, jaccard, packing, pii, repetition, resampling, warc,
)

QUERIES = {
    f.__name__: f
    for f in (
        jaccard.op1_jaccard_join,
        jaccard.op1_jaccard_links,
        pii.op2_pii,
        crf.op3_crf_language,
        bitplane.op4_bitplane_ids,
        packing.op5_packing,
        bytebpe.op6_byte_bpe,
        warc.op7_warc,
        repetition.op8_suffix_array_repetition,
        bottomk.op9_bottomk_fingerprints,
        hilbert.op10_hilbert_shards,
        collocations.op11_phrase_collocations,
        decontaminate.op12_benchmark_decontamination,
        resampling.op13_importance_resampling,
    )
}

ORACLE: dict[str, str] = {
    "op1_jaccard_join": jaccard.OP1_SQL,
    "op1_jaccard_links": jaccard.OP1_LINKS_SQL,
    "op7_warc": warc.OP7_SQL,
    "op11_phrase_collocations": collocations.OP11_SQL,
    "op12_benchmark_decontamination": decontaminate.OP12_SQL,
    "op13_importance_resampling": resampling.OP13_SQL,
}
