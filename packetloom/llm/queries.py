"""The registered queries of this subpackage: thin digests over its operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from packetloom.llm import byte_convnet, conversation_repair, imatch
from packetloom.llm.decision_list import judged
from packetloom.llm.hilbert import hilbert_shards
from packetloom.llm.jaccard_join import jaccard_components
from packetloom.llm.license_scan import scan
from packetloom.llm.packing import pack
from packetloom.llm.pieces import coded
from packetloom.llm.pseudonyms import pseudonymised
from packetloom.llm.rp_forest import nearest
from packetloom.llm.substring_dedup import repeated_passages
from packetloom.llm.token_alignment import aligned

#: Folder of the public vocabulary files; None takes the installed package's.
TOKENIZERS: str | None = None
#: Key of the pseudonyms in the registered query and the pipeline; a deployment sets its own.
PSEUDONYM_KEY = b"registered-query"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_rp_forest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_substring_dedup(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op3_decision_list(spark, sf_dir):
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op4_feistel_pseudonyms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(docs, PSEUDONYM_KEY, counted="n_replaced")


@query
def op5_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))


@query
def op6_sum_of_squares_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op7_sentencepiece(spark, sf_dir):
    return coded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op8_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op9_hilbert_sharding(spark, sf_dir):
    shards = hilbert_shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"])
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op10_byte_convnet(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = byte_convnet.with_score(docs, byte_convnet.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", byte_convnet.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op11_imatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return imatch.edited_neighbours(docs, imatch.lexicon(docs))


@query
def op12_token_alignment(spark, sf_dir):
    groups = F.col("groups")
    rows = aligned(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return rows.withColumn("groups_sha256", F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))).drop("groups")


@query
def op13_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.digests(conversation_repair.repaired(conversation_repair.damaged(rows), rows))
