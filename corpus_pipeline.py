"""From raw documents to token ids: five stages, each on all that the one before kept.

1. quality rules: boilerplate lines go, and documents that the rules reject;
2. n-gram Jaccard join: one document of each group of near duplicates stays (five words, 0.8);
3. suffix-array deduplication: strings of 50 bytes stay in the first document that has them;
4. benchmark decontamination: documents that hold a benchmark window go;
5. byte-level BPE: token ids, and the text that they decode to.

Stages 1 to 4 return the columns of ``documents``; where a text changes, so does ``n_chars``.
Null and empty texts fail the rules of stage 1. Repeated rows pass it as documents of their own,
and one of them passes stage 2. An empty table stays empty. Extra columns are kept up to stage
4; stage 5 leaves out those that are named like its own.
"""

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import bpe, decontaminate, ngram_join, quality, suffix_dedup
from tremor.llm.common import table
from tremor.sinks import noted, remove, stored

RANKS = "byte_bpe_multi_50k.tiktoken"


#: What the last stage has stored, which its result is read from.
_LEFT: list[str] = []


def _stage(build):
    """A stage's result is written before the next stage begins, which removes what it came from."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _LEFT:
            remove(spark, path)
        with noted() as paths:
            made = build(spark, docs, sf_dir)
        _LEFT[:] = paths
        return made

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs, size=5, percent=80)


@_stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(docs)


@_stage
def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token_ids and n_tokens; ``text`` is what the ids decode to."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(docs, path, pattern)
    decoded = bpe.decode(encoded.drop("text"), path, pattern)
    return decoded.withColumns(
        {
            "text": F.col("decoded").cast("string"),
            "n_tokens": F.size("token_ids").cast("bigint"),
        }
    ).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("contamination", contamination),
    ("tokens", tokens),
]

#: SQL has no suffix arrays and no BPE; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        with noted() as written:
            docs = stored(made, name)
        # Nothing reads the stage before any more.
        for path in before:
            remove(spark, path)
        before = written
    for path in _LEFT:
        remove(spark, path)
    _LEFT.clear()
    return docs
