"""The corpus pipeline: stages in order, effective decisions, clean documents kept."""

from __future__ import annotations

import corpus_pipeline as P
from llm.fixtures import awkward, empty
from tallyroad.llm import jaccard_join as J
from tallyroad.llm import line_dedup as LD
from tallyroad.llm import mixing as M
from tallyroad.llm import toxicity as T
from tests_env import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs
        df = stage(spark, docs, SF)
        df.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k + 1 < len(P.STAGES):
            assert docs.columns == COLUMNS
        if name == "toxicity":
            scores = T.toxicity_scores(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert ids(docs) == ids(scores.where("not rejected"))
            assert docs.count() > 0.8 * before.count()
        elif name == "line_deduplication":
            want = {r["doc_id"]: r["text"] for r in LD.line_dedup(before).collect()}
            got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
            assert got == {i: (t, len(t)) for i, t in want.items()}
        elif name == "near_duplicates":
            found = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(before, 5, 80, 100).collect()}
            assert ids(docs) == sorted(set(found.values()))
        elif name == "source_mixing":
            assert ids(docs) == ids(M.mix(before).where("selected"))
        else:
            assert ids(docs) == ids(before) and docs.where("not exact").count() == 0
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_toxic_rows_go_one_by_one(spark):
    """A clean row with the same doc_id, or with none as well, doesn't save a toxic one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = T.toxicity_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    first = lambda which: docs.join(scores.where(which).orderBy("doc_id").limit(1).select("doc_id"), "doc_id").select(COLUMNS).first()
    toxic, clean = first("rejected"), first("not rejected and held_out")
    more = [(i, r["text"], r["lang"], r["source"], r["n_chars"]) for i in (None, 10**12) for r in (toxic, clean)]
    out = P.toxicity(spark, docs.unionByName(spark.createDataFrame(more, docs.schema)), SF)
    assert [tuple(r) for r in out.where(f"doc_id is null or doc_id = {10**12}").orderBy("doc_id").collect()] == [more[1], more[3]]


def test_stages_on_awkward_tables(spark):
    for make in (awkward, empty):
        docs = make(spark)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            if name != "sentencepiece":
                assert out.columns == docs.columns
            n = out.count()
            assert n <= docs.count()
            if name == "sentencepiece":
                break
            docs = spark.createDataFrame(out.collect(), out.schema)
