"""The pipeline against a plain version on whole small tables, and every stage on odd tables."""

import hashlib
from collections import Counter

import corpus_pipeline
from tests.llm import tables as T
from tests.llm.test_mix_pack import check_packed
from vocalstat.llm import mixing as M
from vocalstat.llm import quality as Q
from vocalstat.llm import simhash as S


def test_pipeline_keeps_what_plain_code_keeps(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    score = {r["doc_id"]: r["score"] for r in Q.score(docs, Q.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    rows = {r["doc_id"]: r for r in docs.collect() if score[r["doc_id"]] >= Q.LIMIT}
    last = {}
    for i in sorted(rows):
        last[hashlib.sha256(rows[i]["text"].encode()).digest()] = i
    rows = {i: rows[i] for i in last.values()}
    fps = {i: T.simhash(r["text"]) for i, r in rows.items()}
    of, first = T.classes(fps.values()), {}
    for i in sorted(rows):
        first.setdefault(of[fps[i]], i)
    rows = {i: rows[i] for i in first.values()}
    kept = spark.createDataFrame([tuple(r) for r in rows.values()], docs.schema)
    copies = {r["doc_id"]: r["copies"] for r in M.mix(kept).collect()}
    mixed = [(i, rows[i]["text"]) for i, n in copies.items() for _ in range(n)]
    out = corpus_pipeline.run(spark, sf).collect()
    check_packed(mixed, out)
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == Counter(i for i, _ in mixed)


def test_stages_on_odd_tables(spark, tmp_path):
    sf = T.written(spark, tmp_path, labels=[(1, 1, 0), (2, 0, 0)])
    for rows in (T.ROWS, [], [(None, None, None, None, None)] * 3):
        d = T.docs(spark, rows)
        columns = d.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            d = corpus_pipeline.materialize(stage(spark, d, sf), "stage")
            assert d.columns == columns, name
            assert set(map(str, (r["text"] for r in d.collect()))) <= {str(r[1]) for r in rows}
        assert corpus_pipeline.STAGES[-1][1](spark, d, sf).count() >= d.count()


def test_near_stage_follows_the_operator(spark):
    d = T.docs(spark)
    groups = S.near_groups(d).select("root").distinct().count()
    assert S.drop_near_copies(spark, d, "").count() == groups
