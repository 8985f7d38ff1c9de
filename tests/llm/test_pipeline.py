import inspect
import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

import __spark_entry__ as contract
import corpus_pipeline
from riskstream.llm import queries
from riskstream.llm.common import give_back, written
from riskstream.llm.packing import cut_pieces

SF = "/root/testdata/sf0.001"


def test_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)


def test_run_is_its_stages_and_their_decisions_hold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "best-fit packing":
            assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after <= before for before, after in zip(kept, kept[1:]))
    components = {r.doc_id: r.component_id for r in queries.op7_simhash(spark, SF).collect()}
    assert kept[1] == {i for i in kept[0] if components[i] == i}
    leaks = {r.doc_id for r in queries.op10_decontamination(spark, SF).collect()}
    assert kept[2] == kept[1] - leaks and kept[4] == kept[3] == kept[2]
    whole = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in docs.collect())


def test_odd_rows(spark, odd_docs, docs_of):
    for docs in (odd_docs, docs_of([])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before, docs = docs.columns, written(stage(spark, docs, SF), "stage")
            assert docs.columns == before
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0


def test_without_languages_texts_with_letters_stay(spark, docs_of):
    docs = docs_of([(1, "some words"), (2, "12 34"), (3, None), (4, "слова")]).selectExpr(
        "doc_id", "text", "CAST(null AS string) AS lang", "source", "n_chars")
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()) == [1, 4]


def test_workers_keep_no_words_of_a_task_that_has_ended(spark, docs_of):
    docs = docs_of([(i, " ".join(f"word{i}x{k}" for k in range(2000))) for i in range(8)])
    assert cut_pieces(docs, queries.RANKS).count()

    def kept(batches):
        list(batches)
        found = [len(v) for k, v in vars(sys).get("_riskstream_kept", {}).items() if k == ("encoder", queries.RANKS)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["n"])

    found = [r.n for r in spark.range(8).mapInArrow(kept, "n long").collect()]
    assert found and set(found) == {0}


def test_freed_memory_is_given_back():
    def resident():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    held = [np.ones(100_000, np.uint8) for _ in range(1500)]
    last, held = held[-1], None                 # what lies below it can't be cut off the heap's end
    before = resident()
    give_back()
    assert last.all() and before - resident() > 75
