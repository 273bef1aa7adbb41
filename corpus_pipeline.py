"""The corpus pipeline: documents through five stages to a mix of sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's documents. All but the last return the columns of documents:

1. ``quality``: rows that the classifier rejects (poor or toxic) go, all others stay.
2. ``near_duplicates``: of each group linked by a Jaccard similarity of 0.8 over five-word shingles, the row of the smallest id stays.
3. ``decontaminate``: rows that leak a benchmark item go.
4. ``secrets``: reported secrets are replaced by a marker in the text, and its length is set anew; no row goes.
5. ``mix``: how many words of each document the mix of sources takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrispark.llm.common import table, written
from agrispark.llm.decontam import decontaminate_stage
from agrispark.llm.mixing import mix_stage
from agrispark.llm.ngram_join import ngram_join_stage
from agrispark.llm.quality import quality_stage
from agrispark.llm.secrets import secrets_stage

STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", ngram_join_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
]

#: The fitted classifier and the hashed sets have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
