"""Registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqtally.llm.chat_format import conversations_digest
from seqtally.llm.common import read
from seqtally.llm.embedding_dedup import near_duplicates
from seqtally.llm.html_extract import extract
from seqtally.llm.jaccard_join import jaccard_components
from seqtally.llm.language_id import identify
from seqtally.llm.license_scan import license_labels
from seqtally.llm.mixing import mixture
from seqtally.llm.oracle import SQL  # noqa: F401
from seqtally.llm.packing import pack_documents
from seqtally.llm.pair_bound_search import ranked_search
from seqtally.llm.periodic_runs import runs_digest
from seqtally.llm.repeat_removal import repeat_digest
from seqtally.llm.sharding import shard_documents
from seqtally.llm.topk_search import search


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return search(vectors.where("vec_id % 100 = 0"), vectors)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cross_polytope_dedup": lambda spark, sf_dir: near_duplicates(read(spark, sf_dir, "embeddings")),
    "op2_best_fit_packing": lambda spark, sf_dir: pack_documents(read(spark, sf_dir, "documents")),
    "op3_block_pruned_top_k": top_k,
    "op4_hierarchical_mixing": lambda spark, sf_dir: mixture(read(spark, sf_dir, "documents")),
    "op5_voronoi_jaccard_join": lambda spark, sf_dir: jaccard_components(read(spark, sf_dir, "documents")),
    "op6_suffix_array_dedup": lambda spark, sf_dir: repeat_digest(read(spark, sf_dir, "documents")),
    "op7_page_differencing": lambda spark, sf_dir: extract(read(spark, sf_dir, "pages")),
    "op8_license_scan": lambda spark, sf_dir: license_labels(read(spark, sf_dir, "documents")),
    "op9_virtual_slot_shards": lambda spark, sf_dir: shard_documents(read(spark, sf_dir, "documents")),
    "op10_language_id": lambda spark, sf_dir: identify(read(spark, sf_dir, "documents")),
    "op11_pair_bound_search": lambda spark, sf_dir: ranked_search(read(spark, sf_dir, "documents"),
                                                                  read(spark, sf_dir, "benchmark")),
    "op12_periodic_runs": lambda spark, sf_dir: runs_digest(read(spark, sf_dir, "documents")),
    "op13_chat_round_trip": lambda spark, sf_dir: conversations_digest(read(spark, sf_dir, "conversations")),
}
