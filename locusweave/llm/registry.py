"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from . import html_text, importance, jaccard_join, language_model, mixing, neighbours, packing, phrases, quality_classifier, quality_rules, secrets, url_filter, warc

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_mixing": mixing.op3_mixing,
    "op4_html_text": html_text.op4_html_text,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_warc": warc.op6_warc,
    "op7_packing": packing.op7_packing,
    "op8_quality": quality_classifier.op8_quality,
    "op9_language_model": language_model.op9_language_model,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_url_filter": url_filter.op11_url_filter,
    "op12_phrases": phrases.op12_phrases,
    "op13_importance": importance.op13_importance,
}
ORACLES = {
    "op2_jaccard_join": jaccard_join.SQL,
    "op3_mixing": mixing.SQL,
    "op5_neighbours": neighbours.SQL,
    "op6_warc": warc.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_url_filter": url_filter.SQL,
    "op12_phrases": phrases.SQL,
}
