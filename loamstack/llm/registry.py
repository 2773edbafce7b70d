"""Queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

from . import clusters, decontaminate, html_text, license_scan, media, name_join, near_dup, packing, pii, pivots, shards, token_store, toxicity

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_benchmark_decontamination": decontaminate.op2_benchmark_decontamination,
    "op3_minhash_near_dedup": near_dup.op3_minhash_near_dedup,
    "op4_personal_data": pii.op4_personal_data,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_media_columns": media.op7_media_columns,
    "op8_balanced_shards": shards.op8_balanced_shards,
    "op9_token_store": token_store.op9_token_store,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_centroid_clusters": clusters.op11_centroid_clusters,
    "op12_edit_distance_names": name_join.op12_edit_distance_names,
    "op13_pivot_near_dedup": pivots.op13_pivot_near_dedup,
}
ORACLES = {
    "op2_benchmark_decontamination": decontaminate.OP2_SQL,
    "op8_balanced_shards": shards.OP8_SQL,
    "op11_centroid_clusters": clusters.OP11_SQL,
    "op12_edit_distance_names": name_join.OP12_SQL,
    "op13_pivot_near_dedup": pivots.OP13_SQL,
}
