"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from agrispark.llm.conversations import op12_conversation_repair
from agrispark.llm.decontam import op2_decontaminate
from agrispark.llm.html_extract import op1_html_extract
from agrispark.llm.licenses import op7_license_scan
from agrispark.llm.maxent import op9_lm_score
from agrispark.llm.mixing import OP10_SQL, op10_mix_sources
from agrispark.llm.ngram_join import op5_ngram_join
from agrispark.llm.packing import op13_best_fit_packing
from agrispark.llm.quality import op4_quality_classifier
from agrispark.llm.rindex import op3_suffix_dedup
from agrispark.llm.secrets import op8_secret_scan
from agrispark.llm.spotsigs import op6_spotsigs
from agrispark.llm.whitening import op11_embedding_whitening

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_html_extract": op1_html_extract,
    "op2_decontaminate": op2_decontaminate,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_join": op5_ngram_join,
    "op6_spotsigs": op6_spotsigs,
    "op7_license_scan": op7_license_scan,
    "op8_secret_scan": op8_secret_scan,
    "op9_lm_score": op9_lm_score,
    "op10_mix_sources": op10_mix_sources,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLE_SQL: dict[str, str] = {"op10_mix_sources": OP10_SQL}
