"""The operators' queries over the fixture tables, and SQL where it can express them."""

from . import ann, bpe, conversations, decontam, html_render, line_dedup, ngram_join, quality, runs, token_counts, token_table, toxicity, warc

QUERIES = {
    f.__name__: f
    for f in (
        ann.op1_rp_forest,
        html_render.op2_html_layout,
        quality.op3_compression_quality,
        ngram_join.op4_ngram_jaccard,
        decontam.op5_spaced_seeds,
        token_counts.op6_trie_token_counts,
        warc.op7_warc_chunks,
        toxicity.op8_toxicity_cnn,
        bpe.op9_byte_bpe,
        line_dedup.op10_line_winnow,
        conversations.op11_prefix_trie,
        token_table.op12_orc_tokens,
        runs.op13_lyndon_runs,
    )
}

ORACLE: dict[str, str] = {"op4_ngram_jaccard": ngram_join.OP4_SQL, "op7_warc_chunks": warc.OP7_SQL, "op11_prefix_trie": conversations.OP11_SQL}
