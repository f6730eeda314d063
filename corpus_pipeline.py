"""The corpus pipeline: quality, near-duplicates, benchmark passages, mix, token files.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
stage before kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwerk.llm import decontaminate, mixing, quality, simhash, token_file
from tagwerk.llm.common import stored, table, unused
from tagwerk.llm.queries import tokenizer_path

CUT = 0.7  # documents below this quality score go


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bradley-Terry ranking learnt from ``labels``; rejected documents go.

    Each row is scored by its own text (null and empty ones too), rows that
    repeat alike; extra columns pass through whatever their names; an empty
    table stays empty.
    """
    ranking = quality.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), cut=CUT)
    name = unused(docs, "quality_score")
    return quality.score(docs, ranking, name).where(F.col(name) >= CUT).select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates; of each group the document of the smallest id stays.

    Null ids come last, of rows that share an id in a group one stays, null and
    empty texts are one group; see ``simhash.keep_first``.
    """
    return simhash.keep_first(docs, shingle=3, threshold=2)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go.

    Rows are decided by their own text; null and empty texts stay; an empty
    benchmark keeps all.
    """
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their weights; a document may come several times or not at all.

    Rows without a source form one, last in order; rows that share an id come
    equally often; see ``mixing.plan_mix``.
    """
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document.

    Null and empty texts are an end id alone; rows that repeat are documents of
    their own; rows without an id come first.
    """
    read = token_file.token_files(spark, docs, tokenizer_path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("decontaminate", decontaminate_stage),
          ("mix", mix_stage), ("token files", token_stage)]

#: SQL cannot express fitting, Golay decoding, alignment or the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), "pipeline-tokens")
