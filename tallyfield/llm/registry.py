"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from tallyfield.llm import (
    bpe_tree,
    exact_dedup,
    hard_negatives,
    html_main,
    language_id,
    minhash,
    packing,
    periodic_runs,
    pii,
    quality,
    quality_classifier,
    token_store,
    warc_fixity,
)

QUERIES = {
    "op1_minhash": minhash.query,
    "op2_packing": packing.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_warc_fixity": warc_fixity.query,
    "op5_bpe_tree": bpe_tree.query,
    "op6_pii": pii.query,
    "op7_token_store": token_store.query,
    "op8_quality": quality.query,
    "op9_html_main": html_main.query,
    "op10_language_id": language_id.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_quality_trees": quality_classifier.query,
    "op13_hard_negatives": hard_negatives.query,
}

ORACLES = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op4_warc_fixity": warc_fixity.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
