"""The registered queries of this package and their DuckDB texts."""

from __future__ import annotations

from presswork.llm import bpe, centroids, decontaminate, html_text, iblt, licenses, line_dedup, secrets, simhash_dedup, token_counts, toxicity, warc, whitening

QUERIES = {
    "op1_byte_bpe": bpe.query,
    "op2_line_dedup": line_dedup.query,
    "op3_edit_token_counts": token_counts.query,
    "op4_tag_path_text": html_text.query,
    "op5_noisy_channel_toxicity": toxicity.query,
    "op6_iblt_fingerprints": iblt.query,
    "op7_warc_index_first": warc.query,
    "op8_fm_decontaminate": decontaminate.query,
    "op10_secret_forest": secrets.query,
    "op9_simhash_near_dedup": simhash_dedup.query,
    "op11_license_rules": licenses.query,
    "op12_pca_centroids": centroids.query,
    "op13_spectral_whitening": whitening.query,
}

#: DuckDB texts, for the queries SQL can express in reasonable time.
SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op7_warc_index_first": warc.SQL,
    "op8_fm_decontaminate": decontaminate.SQL,
    "op12_pca_centroids": centroids.SQL,
}
