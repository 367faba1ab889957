"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tarmac.llm.decontaminate import op2_decontamination
from tarmac.llm.filter_audit import OP13_SQL, op13_filter_audit
from tarmac.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from tarmac.llm.html import op5_html_extraction
from tarmac.llm.jaccard import OP8_SQL, op8_ngram_jaccard
from tarmac.llm.language import op9_language_id
from tarmac.llm.maxent import op6_maxent_scoring
from tarmac.llm.neighbours import OP7_SQL, op7_hilbert_neighbours
from tarmac.llm.packing import op1_best_fit_packing
from tarmac.llm.repeats import op10_suffix_dedup
from tarmac.llm.secret_scan import op11_secret_scan
from tarmac.llm.sentence_spans import op4_sentence_spans
from tarmac.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_html_extraction": op5_html_extraction,
    "op6_maxent_scoring": op6_maxent_scoring,
    "op7_hilbert_neighbours": op7_hilbert_neighbours,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_language_id": op9_language_id,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_secret_scan": op11_secret_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op7_hilbert_neighbours": OP7_SQL,
    "op8_ngram_jaccard": OP8_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
