"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame that is
written and read again as the next one's docs. All but the last return the columns of ``documents``.
The duplicate stage takes each row as a document, with or without a ``doc_id`` of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venue_analytics.llm import bpe, mixing, pii, quality, simhash
from venue_analytics.llm.common import cut, small, table


def _whole(docs: DataFrame):
    """A row as one struct, so that no column of it can meet a name that a stage uses."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A null or empty text has no words, and documents of so few are rejected. Repeated rows stay or go
    together; an empty table gives an empty one; all columns stay, whatever their names."""
    return quality.quality_filter(docs, key=F.col("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group (3-word shingles, at most three bits): the one with the smallest id (null
    last), of these with the smallest text (null as empty), of these any by a hash of all columns.

    Rows that share an id, or have none, are rows of their own; rows alike in all columns are one. Null and
    empty texts have one fingerprint and are one group. An empty table gives an empty one; all columns
    stay, whatever their names."""
    keyed = docs.select(_whole(docs).alias("row"), F.unhex(F.sha2(F.to_json(_whole(docs)), 256)).alias("key"))
    mark = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), "key")
    groups = cut(simhash.simhash_groups(keyed.select(mark.alias("mark"), F.col("row.text").alias("text")), "mark", size=3, distance=3)
                 .select(F.col("id.id").alias("id"), F.col("id.key").alias("key"),
                         F.col("component_id.id").alias("low"), F.col("component_id.key").alias("group")))
    # groups of which several rows have the smallest id: their texts decide
    first = groups.where(F.col("id").eqNullSafe(F.col("low"))).select("group", "key").distinct()
    several = first.groupBy("group").count().where("count > 1").select("group")
    tied = cut(first.join(several, "group").select("group", "key"))
    won = F.col("group")
    if not tied.isEmpty():
        chosen = (keyed.select("key", F.coalesce("row.text", F.lit("")).alias("text")).join(tied, "key")
                  .groupBy("group").agg(F.min(F.struct("text", "key")).alias("w")).select("group", F.col("w.key").alias("won")))
        groups = groups.join(small(cut(chosen), 100_000), "group", "left")
        won = F.coalesce("won", "group")
    gone = groups.where(F.col("key") != won).select("key").distinct()
    kept = keyed.join(gone, "key", "left_anti")
    twice = cut(groups.where(F.col("key") == won).groupBy("key").count().where("count > 1").select("key"))
    if not twice.isEmpty():
        once = kept.join(twice, "key", "left_semi").dropDuplicates(["key"])
        kept = kept.join(twice, "key", "left_anti").unionByName(once)
    return kept.select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by tags; ``n_chars`` follows the new text.

    A null text stays null (and so does its ``n_chars``), an empty one empty. Repeated rows are redacted
    alike; an empty table gives an empty one; all other columns stay, whatever their names."""
    model = pii.fit_model(docs, key=F.col("doc_id"))
    found = pii.find(docs.select(_whole(docs).alias("row"), "text"), model, out="spans")
    text = F.when(F.col("text").isNotNull(), pii.redacted(F.col("text"), F.col("spans")))
    found = found.select("row", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, as often as it takes them.

    A null or empty text has size 0 and stays or goes with the hash of its row; null sources are a source
    of their own. Rows alike in id and text are taken together; an empty table gives an empty one; all
    columns stay, whatever their names."""
    _, limits = mixing.mix(docs)
    return mixing.repeat(docs, limits)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents: ``doc_id, lang, source, n_tokens, ids``, one row per row; other columns, the text
    among them, end here.

    A null or empty text has no ids. An empty table gives an empty one."""
    got = bpe.encode(docs.select("doc_id", "lang", "source", "text"), bpe.word_bpe_path())
    return got.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", tokens),
]

#: SQL has no expression for fingerprints' groups, the fitted model and the tokenizer; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; stages in between are checkpointed."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
