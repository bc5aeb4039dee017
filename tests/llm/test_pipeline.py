import corpus_pipeline as P

from laborlake.llm import decontaminate, registry, simhash


def test_stages_chain(spark, documents):
    sf, docs, seen = "/root/testdata/sf0.001", documents, []
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == documents.columns
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        seen.append(len(ids))
        docs = spark.createDataFrame(out.collect(), documents.schema)
    assert seen == sorted(seen, reverse=True) and seen[0] > 0.7 * documents.count()
    final = P.STAGES[-1][1](spark, docs, sf).collect()
    assert {d for r in final for d in r["doc_ids"]} == {r["doc_id"] for r in docs.collect()}


def test_run_equals_the_stages_by_hand(spark, documents):
    sf = "/root/testdata/sf0.001"
    got = {d for r in P.run(spark, sf).collect() for d in r["doc_ids"]}
    good = P.quality_stage(spark, documents, sf)
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    prints = {d: simhash.simhash(t) for d, t in kept.items()}
    groups = {d: d for d in kept}
    for _ in kept:  # smallest id reachable, by repeated relaxation
        new = {d: min(groups[e] for e in kept if (prints[d] ^ prints[e]).bit_count() <= P.MAX_BITS) for d in kept}
        if new == groups:
            break
        groups = new
    first = {d for d in kept if groups[d] == d}
    items = [decontaminate.normalise(r["text"])[0].tobytes() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {d for d in first if not any(i in decontaminate.normalise(kept[d])[0].tobytes() for i in items)}
    assert got <= clean and len(got) > 0.5 * len(clean)
    mixed = P.mixing_stage(spark, documents.where(documents.doc_id.isin(sorted(clean))), sf)
    assert got == {r["doc_id"] for r in mixed.collect()}


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
    assert [name for name, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_output"]


def test_empty_documents(spark, empty):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
