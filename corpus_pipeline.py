"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written to
the shared folder and read again. All but the last return the columns of documents, with doc_id as it came.

Defined cases are those of the operators: null and empty texts are rejected by language ID, as they have no
language; rows that repeat doc_id and text stay or go together; columns of documents beyond the five are
kept up to the last stage, but for names that begin with "__ld_" or "__mx_"; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.llm import language, line_dedup, mixing, ngram_join, topics, unigram
from flowtide.llm.common import scratch, stash, table
from flowtide.llm.queries import MODEL, TOPICS, mix_marginals

#: SQL has neither compressors nor automata, raking or sampled paths; the stages are tested against brute force.
ORACLE_SQL = None
#: Only texts about as well compressed by two languages are rejected.
MARGIN = 0.002
#: Rows that Spark hands to a Python worker at once, for texts of some kilobytes: with the default of 10,000 the copies of a batch on both sides fill hundreds of megabytes.
ARROW_ROWS = 1000
#: Share of the tokens that the mix keeps.
BUDGET = 0.9


def _small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches for this session's queries from here on; a smaller bound stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, ARROW_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents, drops documents with no clear language, and sets lang."""
    _small_batches(spark)
    found = language.identify(docs.select(F.struct("*").alias("row")), language.train(docs), text="row.text", margin=MARGIN, out="found")
    return found.where("not found.rejected").select(*(F.col("found.lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns))


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated chunks of lines, and repeats within runs of one line, out of the texts."""
    d = line_dedup.dedup_lines(docs, out="__ld_out").withColumn("n_chars", F.length("text").cast("long"))
    return d.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    _small_batches(spark)
    return ngram_join.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents towards the target mix, by the tokens that the last stage will make of them."""
    _small_batches(spark)
    about = topics.assigner(docs, topics.learn(docs, topics=TOPICS), unigram.Counter(spark, unigram.Vocabulary.read(MODEL)))
    d = docs.withColumn("__mx_about", about(F.col("text")))
    d = mixing.mix(d, mix_marginals(F.col("__mx_about.topic")), BUDGET, F.col("__mx_about.n_tokens"), out="__mx_out", without=("__mx_about",))
    return d.where("__mx_out.kept").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_ids, round_trip."""
    _small_batches(spark)
    d = unigram.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), unigram.Vocabulary.read(MODEL))
    return d.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"), (F.col("decoded") == unigram.normalised(F.col("text"))).alias("round_trip"))


STAGES = [("language_id", language_id), ("line_dedup", line_chunks), ("ngram_join", near_copies), ("mixing", mix), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's own tables are removed once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch() as keep:
            docs = keep(stash(stage(spark, docs, sf_dir), name))
    return docs
