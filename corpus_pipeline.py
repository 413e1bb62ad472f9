"""From raw documents to token ids, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrain.llm.mixing import mixed
from pulsegrain.llm.pieces import encoded
from pulsegrain.llm.pii import masked
from pulsegrain.llm.quality import filter_quality
from pulsegrain.llm.shared import table, tuned, written
from pulsegrain.llm.similar import one_of_each_group

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text has no words and goes. Repeated rows are judged alike, each stays or goes as a row;
    null ids, languages and sources are no reason to go. An empty table gives no rows; columns beyond
    those of documents are dropped, whatever their names. The last two hold for every stage.
    """
    return filter_quality(docs).select(*COLUMNS)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: the one of the smallest id.

    Documents without words are linked with nothing and stay. Of repeated rows one stays.
    """
    return one_of_each_group(docs).select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, n_chars counted anew.

    All rows stay; a null text stays null, an empty one empty.
    """
    return masked(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, with a document as often as it is taken.

    Null and empty texts have no words and are never taken. A null source is a source of its own. Repeated
    rows stand in the queue as rows of their own.
    """
    return mixed(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix; a document that is taken again is cut in its own way.

    A null or empty text has no ids.

    The rows that are numbered together are equal in id and text, so any order of them gives the
    same result; the mix has no more than a few of each.
    """
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return encoded(docs.select("doc_id", "text", F.row_number().over(same).alias("take")), MODEL_FILE, take="take")


STAGES = [("quality", quality), ("similar", similar), ("private", private), ("mixing", mixing),
          ("tokens", tokens)]
STAGES = [(name, tuned(stage)) for name, stage in STAGES]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
