import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ladle.llm import langid, ngram_join, packing, quality
from ladle.llm.queries import QUERIES, SQL

from .test_search_and_join import brute_groups

COLUMNS = {
    "op1": "query_id rank vec_id score", "op2": "page_id payload_bytes payload_digest record_type refers_to", "op3": "doc_id text",
    "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept score",
    "op6": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7": "doc_id size text_crc32 law shard slot grown_shard",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset", "op9": "doc_id held_out lang_pred score",
    "op10": "doc_id n_shingles component_id", "op11": "doc_id n_words n_removed kept_sha256", "op12": "item_id rank doc_id score",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(name, spark, folder):
    assert QUERIES[name](spark, folder).columns == COLUMNS[name.split("_")[0]].split()


def test_stages_against_their_parts(spark, folder):
    """Each stage keeps what its operator says of its own input, with the columns of documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality rules", "language id", "n-gram Jaccard join", "surrogates", "best-fit packing"]

    good = stages["quality rules"](spark, docs, folder).cache()
    assert ids(good) == ids(quality.quality_rules(docs, labels).filter("kept"))
    known = stages["language id"](spark, good, folder).cache()
    assert ids(known) == ids(langid.identify_languages(good).filter("lang_pred <> 'und' AND score >= 0.5"))
    single = stages["n-gram Jaccard join"](spark, known, folder).cache()
    texts = [(r.doc_id, r.text) for r in known.collect()]
    assert ids(single) == sorted(d for d, _, c in brute_groups(texts) if d == c)
    safe = stages["surrogates"](spark, single, folder).cache()
    assert ids(safe) == ids(single) and all(r.n_chars == len(r.text) for r in safe.collect())
    assert all(d.columns == columns for d in (good, known, single, safe))
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (single, safe))
    private = re.compile(r"\S+@\S+\.\w+|\b\d{13,}\b|\b\d+\.\d+\.\d+\.\d+\b|\d{3}-\d{4}\b")
    for i, text in before.items():
        assert not set(private.findall(text)) & set(private.findall(after[i]))
        assert private.search(text) or "=" in text or after[i] == text
    packed = stages["best-fit packing"](spark, safe, folder).collect()
    whole = {(r.doc_id, r.piece, r.ids_crc32) for r in packing.pieces(safe).collect()}
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in packed} == whole
    for d in (good, known, single, safe):
        d.unpersist()


def test_run(spark, folder):
    assert corpus_pipeline.ORACLE_SQL is None
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len({r.doc_id for r in rows}) > 100 and ngram_join.HUB_ROUNDS > 0
