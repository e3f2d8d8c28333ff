"""The queries of this folder and their SQL, by name, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from strata.llm.conversation_repair import op11_conversation_repair
from strata.llm.decontaminate import op10_decontamination
from strata.llm.html import op4_html
from strata.llm.jaccard import op7_jaccard
from strata.llm.maxent import op8_maxent
from strata.llm.neighbours import op9_neighbours
from strata.llm.periodic import op13_periodic_runs
from strata.llm.pieces import op1_sentencepiece
from strata.llm.quality import op3_quality
from strata.llm.secrets import op5_secrets
from strata.llm.substrings import op2_substrings
from strata.llm.token_counts import op12_token_counts
from strata.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substrings": op2_substrings,
    "op3_quality": op3_quality,
    "op4_html": op4_html,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard": op7_jaccard,
    "op8_maxent": op8_maxent,
    "op9_neighbours": op9_neighbours,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_counts": op12_token_counts,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {}
