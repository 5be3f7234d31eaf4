"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import jaccard, langid, media, mixing, neighbours, packing, quality, secrets, token_store, toxicity

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_secret_scan": secrets.op2,
    "op3_language_id": langid.op3,
    "op4_token_store": token_store.op4,
    "op5_toxicity": toxicity.op5,
    "op6_media_chunks": media.op6,
    "op7_jaccard_join": jaccard.op7,
    "op8_best_fit_packing": packing.op8,
    "op9_nearest_neighbours": neighbours.op9,
    "op10_quality": quality.op10,
}
ORACLES = {"op1_mix_sources": mixing.ORACLE_OP1, "op2_secret_scan": secrets.ORACLE_OP2}
