"""The operators of this subpackage as named queries over the tables of a folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ladle.llm import (
    bpe, langid, lexical, license, multi_index, ngram_join, packing, prefix_trie, quality, sharding, substrings, surrogates, warc,
)
from ladle.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    def register(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark.sparkContext)
            return build(*[spark.read.parquet(f"{folder}/{t}.parquet") for t in tables])

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register


@query("op1_multi_index", "embeddings")
def op1(vectors):
    return multi_index.search(vectors)


@query("op2_warc", "pages")
def op2(pages):
    return warc.archived_pages(pages)


@query("op3_surrogates", "documents")
def op3(docs):
    return surrogates.surrogate_documents(docs, surrogates.session_key(docs.sparkSession))


@query("op4_byte_bpe", "documents")
def op4(docs):
    return bpe.encode_documents(docs)


@query("op5_quality", "documents", "labels")
def op5(docs, labels):
    return quality.quality_rules(docs, labels)


@query("op6_licenses", "documents", sql=license.oracle())
def op6(docs):
    return license.scan(docs)


@query("op7_sharding", "documents")
def op7(docs):
    return sharding.shard_documents(docs)


@query("op8_packing", "documents")
def op8(docs):
    return packing.pack_documents(docs)


@query("op9_languages", "documents")
def op9(docs):
    return langid.identify_languages(docs)


@query("op10_ngram_join", "documents")
def op10(docs):
    return ngram_join.link(docs)


@query("op11_de_bruijn_dedup", "documents", sql=substrings.oracle())
def op11(docs):
    return substrings.remove_repeats(docs)


@query("op12_fp_tree_search", "documents", "benchmark", sql=lexical.oracle())
def op12(docs, items):
    return lexical.search(docs, items)


@query("op13_prefix_trie", "conversations", sql=prefix_trie.oracle())
def op13(conversations):
    return prefix_trie.prefix_trie(conversations)
