"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from quiremill.llm import decontaminate, embedding_dedup, embedding_whitening, jaccard_join, language_id, line_dedup, ordinal_quality, sampled_pieces, source_divergence, substring_dedup, token_shards, url_filter, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_language_id": language_id.op2_language_id,
    "op3_token_shards": token_shards.op3_token_shards,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_warc": warc.op6_warc,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_ordinal_quality": ordinal_quality.op9_ordinal_quality,
    "op10_sampled_pieces": sampled_pieces.op10_sampled_pieces,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_embedding_whitening": embedding_whitening.op12_embedding_whitening,
    "op13_source_divergence": source_divergence.op13_source_divergence,
}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op4_jaccard_join": jaccard_join.SQL,
    "op5_url_filter": url_filter.SQL,
    "op6_warc": warc.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op8_embedding_dedup": embedding_dedup.SQL,
    "op11_substring_dedup": substring_dedup.SQL,
    "op13_source_divergence": source_divergence.SQL,
}
