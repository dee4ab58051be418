"""The registered queries of this subpackage: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import conversations
from dockflow.llm.common import read_table
from dockflow.llm.contamination import leaks
from dockflow.llm.credentials import secret_scan
from dockflow.llm.licenses import license_scan
from dockflow.llm.mixing import mixed
from dockflow.llm.neighbours import nearest
from dockflow.llm.personal import personal_data
from dockflow.llm.pieces import encoded_pieces
from dockflow.llm.quality import graded_documents
from dockflow.llm.repair import repaired
from dockflow.llm.simhash import near_duplicates
from dockflow.llm.tokens import encoded
from dockflow.llm.whitening import whitened


def op1_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs", "answer", "first_word", "last_word")


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(read_table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read_table(spark, folder, "documents"), words=3, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the classifier selects, with their grades."""
    found = graded_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return found.where("keep").select("doc_id", "expected_grade", "p_fair", "p_good", "keep")


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(read_table(spark, folder, "documents"))


def op7_personal(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(read_table(spark, folder, "documents"))


def op8_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    found = encoded(read_table(spark, folder, "documents"), vocabulary="word_bpe_49k.json", end_id=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "first_frame")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixed(read_table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.chat_format(read_table(spark, folder, "conversations"))


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encoded_pieces(read_table(spark, folder, "documents"), model="piece_bpe_32k.model", end_id=2)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(read_table(spark, folder, "embeddings"), components=16)


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired(read_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_leaks": op1_leaks,
    "op2_neighbours": op2_neighbours,
    "op3_licenses": op3_licenses,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_secrets": op6_secrets,
    "op7_personal": op7_personal,
    "op8_token_ids": op8_token_ids,
    "op9_mixing": op9_mixing,
    "op10_chat": op10_chat,
    "op11_pieces": op11_pieces,
    "op12_whitening": op12_whitening,
    "op13_repair": op13_repair,
}

ORACLES: dict[str, str] = {"op10_chat": conversations.ORACLE}
