"""The operators' queries and their SQL."""

from __future__ import annotations

from webmetrics.llm import (centroids, decontaminate, html_text, langid, minhash, mixing, oracles, quality, sharding, suffix_dedup,
                            url_filter, vector_codes, warc, window_dedup)

SPARK = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_window_dedup": window_dedup.query,
    "op3_warc_packages": warc.query,
    "op4_mixing": mixing.query,
    "op5_url_filter": url_filter.query,
    "op6_minhash": minhash.query,
    "op7_decontaminate": decontaminate.query,
    "op8_quality": quality.query,
    "op9_langid": langid.query,
    "op10_html_text": html_text.query,
    "op11_sharding": sharding.query,
    "op12_vector_codes": vector_codes.query,
    "op13_centroids": centroids.query,
}
SQL = {
    "op2_window_dedup": oracles.WINDOWS,
    "op3_warc_packages": oracles.PAYLOADS,
    "op4_mixing": oracles.MIX,
    "op6_minhash": oracles.NEAR,
    "op7_decontaminate": oracles.LEAKS,
    "op11_sharding": oracles.SHARDS,
    "op12_vector_codes": oracles.CODES,
    "op13_centroids": oracles.CLUSTERS,
}
