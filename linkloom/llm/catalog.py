"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from linkloom.llm.chat_format import OP2_SQL, op2_chat_formatting
from linkloom.llm.embedding_whitening import op12_embedding_whitening
from linkloom.llm.jaccard_join import op1_ngram_jaccard_join
from linkloom.llm.line_dedup import OP7_SQL, op7_line_dedup
from linkloom.llm.lm_scoring import op5_lm_scoring
from linkloom.llm.mixing import OP6_SQL, op6_mixing
from linkloom.llm.permutation_index import op10_permutation_index
from linkloom.llm.pii import op8_pii
from linkloom.llm.quality_rules import op3_quality_rules
from linkloom.llm.sentencepiece_codec import op4_sentencepiece
from linkloom.llm.source_divergence import OP11_SQL, op11_source_divergence
from linkloom.llm.suffix_dedup import op9_suffix_dedup
from linkloom.llm.token_grammar import op13_token_grammar

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_quality_rules": op3_quality_rules,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_pii": op8_pii,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_permutation_index": op10_permutation_index,
    "op11_source_divergence": op11_source_divergence,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_grammar": op13_token_grammar,
}
ORACLES: dict[str, str] = {
    "op2_chat_formatting": OP2_SQL,
    "op6_mixing": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_source_divergence": OP11_SQL,
}
