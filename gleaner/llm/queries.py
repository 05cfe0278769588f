"""Registered queries of the training-data operators: name -> (function, SQL).

SQL is given where DuckDB can say the same rows; the other queries are tested
against brute force in ``tests/llm``."""

from __future__ import annotations

from gleaner.llm import (
    circulant_minhash,
    collocations,
    context_tree,
    decontamination,
    fill_middle,
    license_digests,
    line_dedup,
    mixing,
    pii_boosting,
    quality_divergence,
    snapshot_collapse,
    suffix_dedup,
    url_filter,
)

QUERIES = {
    "op1_quality_divergence": (quality_divergence.op1_quality_divergence, quality_divergence.OP1_SQL),
    "op2_snapshot_collapse": (snapshot_collapse.op2_snapshot_collapse, snapshot_collapse.OP2_SQL),
    "op3_redirect_equivalence": (url_filter.op3_redirect_equivalence, url_filter.OP3_SQL),
    "op4_suffix_array_dedup": (suffix_dedup.op4_suffix_array_dedup, suffix_dedup.OP4_SQL),
    "op5_candidate_boosting": (pii_boosting.op5_candidate_boosting, None),
    "op6_source_mixing": (mixing.op6_source_mixing, mixing.OP6_SQL),
    "op7_circulant_minhash": (circulant_minhash.op7_circulant_minhash, circulant_minhash.OP7_SQL),
    "op8_context_tree_weighting": (context_tree.op8_context_tree_weighting, None),
    "op9_canonical_digests": (license_digests.op9_canonical_digests, license_digests.OP9_SQL),
    "op10_benchmark_decontamination": (decontamination.op10_benchmark_decontamination, decontamination.OP10_SQL),
    "op11_phrase_collocations": (collocations.op11_phrase_collocations, collocations.OP11_SQL),
    "op12_fill_in_middle": (fill_middle.op12_fill_in_middle, fill_middle.OP12_SQL),
    "op13_line_dedup": (line_dedup.op13_line_dedup, line_dedup.OP13_SQL),
}
