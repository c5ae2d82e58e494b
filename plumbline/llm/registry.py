"""Queries of the corpus operators and the DuckDB SQL of those that SQL can express."""

from plumbline.llm import chat, collocation, decontam, html_crf, interaction, jaccard, language, mixing, spans, suffix, topk, toxicity, warc

QUERIES = {
    "op1_sentence_spans": spans.op1_sentence_spans,
    "op10_shingle_jaccard": jaccard.op10_shingle_jaccard,
    "op11_filter_interaction_audit": interaction.op11_filter_interaction_audit,
    "op12_phrase_collocations": collocation.op12_phrase_collocations,
    "op13_language_codes": language.op13_language_codes,
    "op2_toxicity_nnpu": toxicity.op2_toxicity_nnpu,
    "op3_latent_decontamination": decontam.op3_latent_decontamination,
    "op4_impact_topk": topk.op4_impact_topk,
    "op5_chat_snapshots": chat.op5_chat_snapshots,
    "op6_html_crf": html_crf.op6_html_crf,
    "op7_suffix_dedup": suffix.op7_suffix_dedup,
    "op8_pareto_mixing": mixing.op8_pareto_mixing,
    "op9_warc_capture_index": warc.op9_warc_capture_index,
}
SQL = {
    "op10_shingle_jaccard": jaccard.SQL,
    "op11_filter_interaction_audit": interaction.SQL,
    "op12_phrase_collocations": collocation.SQL,
    "op4_impact_topk": topk.SQL,
    "op5_chat_snapshots": chat.SQL,
    "op8_pareto_mixing": mixing.SQL,
    "op9_warc_capture_index": warc.SQL,
}
