"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from . import decontam, langid, license, linededup, minmax, ngramjoin, quality, ranksearch, secrets, sentencepiece, sharding, suffix, trie

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_license_scan": license.op2_license_scan,
    "op3_language_id": langid.op3_language_id,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_sentencepiece": sentencepiece.op8_sentencepiece,
    "op9_ngram_join": ngramjoin.op9_ngram_join,
    "op10_sharding": sharding.op10_sharding,
    "op11_ranked_search": ranksearch.op11_ranked_search,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_minmax_dedup": minmax.op13_minmax_dedup,
    # parts of the above that SQL can say
    "quality_ablation": quality.quality_ablation,
    "license_places": license.license_places,
    "secret_counts": secrets.secret_counts,
}
SQL = {
    "op1_quality_rules": quality.OP1_SQL,
    "op7_suffix_dedup": suffix.OP7_SQL,
    "op9_ngram_join": ngramjoin.OP9_SQL,
    "op11_ranked_search": ranksearch.OP11_SQL,
    "op12_conversation_trie": trie.OP12_SQL,
    "op13_minmax_dedup": minmax.OP13_SQL,
    "quality_ablation": quality.ABLATION_SQL,
    "license_places": license.PLACES_SQL,
    "secret_counts": secrets.COUNTS_SQL,
}
