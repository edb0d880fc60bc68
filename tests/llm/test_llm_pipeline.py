"""The pipeline's stages on the smallest tables."""

import collections
import random

import corpus_pipeline
from tollgate.llm import mixing
from tollgate.llm.queries import ORACLES, QUERIES


def test_stages_return_documents_and_the_last_packs_them(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kinds = docs.columns, docs.dtypes
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "pack":
            assert docs.columns == columns and docs.dtypes == kinds, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] <= counts[2] and counts[4] > 0
    packed = docs.collect()
    total = sum(len(r.ids) // 4 for r in packed)
    assert {r.sequence_id for r in packed} == set(range(-(-total // 4096)))


def test_stages_of_nothing_and_of_null_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "a", 0)], docs.schema)
    for table in (docs, odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, "").count() >= 0


def test_copies_lie_where_the_mix_has_them(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randint(5, 120))), "en", "abc"[i % 7 // 3], 0) for i in range(300)]
    docs = spark.createDataFrame(rows, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema)
    _, mixed = mixing.mix(docs)
    passes, taken, size = {}, collections.Counter(), {r[0]: len(r[1].split()) for r in rows}
    for r in mixed.collect():
        at = passes.setdefault((r.doc_id, r.epoch), (r.slot, r.start))
        passes[r.doc_id, r.epoch] = min(at, (r.slot, r.start))
        taken[r.doc_id] += r.words
    want = sorted((place, doc) for (doc, epoch), place in passes.items() if epoch < int(taken[doc] / size[doc] + 0.5))
    want = [doc for _, doc in want]
    assert max(collections.Counter(want).values()) == 2
    stage = corpus_pipeline.mix_sources(spark, docs, "")
    assert [r.doc_id for r in stage.collect()] == want
    stage.write.parquet(f"{tmp_path}/mix")
    packed = corpus_pipeline.pack(spark, spark.read.parquet(f"{tmp_path}/mix"), "").collect()
    source = {r[0]: r[3] for r in rows}
    for name in "abc":
        own = sorted((r.sequence_id, r.offset, r.start, r.doc_id) for r in packed if source[r.doc_id] == name)
        begun = []
        for _, _, _, doc in own:
            begun += [doc] if not begun or begun[-1] != doc else []
        assert begun == [doc for doc in want if source[doc] == name]


def test_registry():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None
