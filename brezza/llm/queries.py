"""The queries of the text problems 7 to 9."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brezza.llm import packing, residue, tokenize
from brezza.operators.checkpoints import shared_checkpoint
from brezza.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p7_ids(spark: SparkSession, directory: str) -> DataFrame:
    return tokenize.encode_texts(table(spark, directory, "documents"), "doc_id", "text", tokenize.vocabulary_path())


def p7_round_trip(spark: SparkSession, directory: str) -> DataFrame:
    """Whether each text comes back when its ids are decoded; true throughout."""
    return tokenize.round_trips(table(spark, directory, "documents"), "doc_id", "text", tokenize.vocabulary_path()).select("doc_id", "exact")


def p8_packed(spark: SparkSession, directory: str) -> DataFrame:
    sized = tokenize.count_tokens(table(spark, directory, "documents"), ["doc_id"], "text", tokenize.vocabulary_path())
    return packing.pack(sized, "doc_id", "tokens")


def p8_invariants(spark: SparkSession, directory: str) -> DataFrame:
    """What any packing must keep, of each document: all of its tokens, the capacity, and no needless cut; true throughout."""
    sized = shared_checkpoint(tokenize.count_tokens(table(spark, directory, "documents"), ["doc_id"], "text", tokenize.vocabulary_path()))
    return packing.invariants(packing.pack(sized, "doc_id", "tokens"), sized, "doc_id", "tokens")


def p9_found(spark: SparkSession, directory: str) -> DataFrame:
    return residue.find_residue(table(spark, directory, "documents"), "doc_id", "text").select("doc_id")


def p9_reasons(spark: SparkSession, directory: str) -> DataFrame:
    return residue.find_residue(table(spark, directory, "documents"), "doc_id", "text")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p7_ids, p7_round_trip, p8_packed, p8_invariants, p9_found, p9_reasons)}

ORACLES: dict[str, str] = {
    "p7_round_trip": "select doc_id, true as exact from documents",
    "p8_invariants": "select doc_id, true as kept, true as fits, true as unsplit from documents",
}
