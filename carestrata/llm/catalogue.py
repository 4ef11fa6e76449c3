"""The queries of this package and their SQL twins."""

from carestrata.llm.alignment import op13_cross_tokenizer_alignment
from carestrata.llm.decontaminate import OP7_SQL, op7_benchmark_decontamination
from carestrata.llm.hosts import OP4_SQL, op4_url_filters
from carestrata.llm.line_dedup import OP10_SQL, op10_line_dedup
from carestrata.llm.mixing import OP9_SQL, op9_mixing_sources
from carestrata.llm.pages import op11_html_extraction
from carestrata.llm.passages import op1_substring_dedup
from carestrata.llm.prefixes import OP12_SQL, op12_conversation_prefix_trie
from carestrata.llm.quality import op5_quality_classifier
from carestrata.llm.secrets import OP3_SQL, op3_secret_scans
from carestrata.llm.simhash import op8_simhash_near_dedup
from carestrata.llm.syncmers import op2_document_fingerprints
from carestrata.llm.token_counts import op6_token_counts

QUERIES = {
    q.__name__: q
    for q in (
        op1_substring_dedup,
        op2_document_fingerprints,
        op3_secret_scans,
        op4_url_filters,
        op5_quality_classifier,
        op6_token_counts,
        op7_benchmark_decontamination,
        op8_simhash_near_dedup,
        op9_mixing_sources,
        op10_line_dedup,
        op11_html_extraction,
        op12_conversation_prefix_trie,
        op13_cross_tokenizer_alignment,
    )
}
ORACLE = {
    "op3_secret_scans": OP3_SQL,
    "op4_url_filters": OP4_SQL,
    "op7_benchmark_decontamination": OP7_SQL,
    "op9_mixing_sources": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_conversation_prefix_trie": OP12_SQL,
}
