"""The queries of this subpackage, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from codalith.llm.chat import OP1_SQL, op1_preference_format
from codalith.llm.contamination import OP12_SQL, op12_decontaminate
from codalith.llm.divergence import OP13_SQL, op13_source_divergence
from codalith.llm.merge_dropout import op9_merge_dropout
from codalith.llm.merkle import OP11_SQL, op11_merkle_manifest
from codalith.llm.packing import op8_best_fit_packing
from codalith.llm.quality_ranking import op5_quality_classifier
from codalith.llm.quality_rules import op2_quality_rules
from codalith.llm.simhash import op10_simhash
from codalith.llm.substring import OP3_SQL, op3_substring_dedup
from codalith.llm.token_counts import op6_token_counts
from codalith.llm.toxicity import op7_toxicity
from codalith.llm.vector_search import OP4_SQL, op4_exact_topk

QUERIES = {
    f.__name__: f
    for f in (op1_preference_format, op2_quality_rules, op3_substring_dedup, op4_exact_topk, op5_quality_classifier, op6_token_counts, op7_toxicity, op8_best_fit_packing, op9_merge_dropout, op10_simhash, op11_merkle_manifest, op12_decontaminate, op13_source_divergence)
}
SQL = {"op1_preference_format": OP1_SQL, "op3_substring_dedup": OP3_SQL, "op4_exact_topk": OP4_SQL, "op11_merkle_manifest": OP11_SQL, "op12_decontaminate": OP12_SQL, "op13_source_divergence": OP13_SQL}
