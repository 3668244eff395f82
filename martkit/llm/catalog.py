"""Queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import bagminhash, digest_index, global_bpe, license_scan, line_runs, mixing, phrase_index, site_quality, term_matrix, token_count, token_store, warc_derive, whitening

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_decontamination": phrase_index.op2_decontamination,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_line_dedup": line_runs.op4_line_dedup,
    "op5_token_store": token_store.op5_token_store,
    "op6_quality": site_quality.op6_quality,
    "op7_token_count": token_count.op7_token_count,
    "op8_warc": warc_derive.op8_warc,
    "op9_exact_dedup": digest_index.op9_exact_dedup,
    "op10_near_duplicates": bagminhash.op10_near_duplicates,
    "op11_global_bpe": global_bpe.op11_global_bpe,
    "op12_filter_audit": term_matrix.op12_filter_audit,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {
    "op1_mixing": mixing.OP1_SQL,
    "op2_decontamination": phrase_index.OP2_SQL,
    "op4_line_dedup": line_runs.OP4_SQL,
    "op9_exact_dedup": digest_index.OP9_SQL,
    "op12_filter_audit": term_matrix.OP12_SQL,
}
