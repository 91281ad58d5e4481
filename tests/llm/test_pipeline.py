import zlib

import corpus_pipeline
from tests.llm.test_ngram_join import brute
from wayforge.llm.common import hashed_texts
from wayforge.llm.decontamination import MATCH, PLAIN, align, normal


def leaks(docs, items):
    """Ids of documents that alignment of all pairs finds to hold an item."""
    x = list(hashed_texts(normal(items), PLAIN))
    out = set()
    for i, h in zip(docs, hashed_texts(normal(list(docs.values())), PLAIN)):
        for at in range(0, max(len(h), 1), 2000):  # pieces that overlap by more than an item's length
            piece = h[at : at + 2200]
            if len(piece) and any(s / (MATCH * len(w)) >= 0.5 for w, s in zip(x, align(x, [piece] * len(x))[0])):
                out.add(i)
    return out


def test_each_stage_equals_its_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(900001, None, "en", "src0", 0), (900002, "12 34 !!", None, None, 8), (900003, "½ ²", "en", None, 3)], docs.schema)
    docs = docs.unionByName(odd)
    columns, seen = docs.columns, []
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        after = {r.doc_id for r in out.select("doc_id").collect()}
        seen.append(name)
        assert after <= before.keys()
        if name != "shards":
            assert out.columns == columns
        if name == "language":
            assert before.keys() - after == {900001, 900002, 900003}
        if name == "near_copies":
            groups = {}
            for d, (_, c) in brute(list(before.items()), 5, 80, 100).items():
                groups.setdefault(c, []).append(d)
            assert after == {min(g) for g in groups.values()}
        if name == "decontaminate":
            assert before.keys() - after == leaks(before, items)
        if name == "mixture":
            assert 0 < len(after) < len(before)
        if name == "shards":
            rows = out.collect()
            assert after == before.keys() and all((r.size, r.text_crc32) == (len(before[r.doc_id].encode()) + 8, zlib.crc32(before[r.doc_id].encode())) for r in rows)
            slots = {}
            for r in rows:
                slots.setdefault(r.shard, []).append(r.slot)
            assert slots.keys() <= set(range(24)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
        docs = out
    assert seen == ["language", "near_copies", "decontaminate", "mixture", "shards"]


def test_run_returns_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "shard", "slot"} <= set(out.columns) and out.count() > 0


def test_bad_bytes_maps_and_variants(spark, sf_dir):
    """Texts that are not UTF-8, and columns of types that have no hash, in every stage."""
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    bad = "concat(cast(X'ff41fe' as string), ' the house of the king and the garden in the north ', cast(X'c328' as string))"
    docs = base.unionByName(spark.range(6).selectExpr("id as doc_id", f"{bad} as text", "'en' as lang", "cast(null as string) as source", "3L as n_chars"))
    docs = docs.selectExpr("*", "map('a', doc_id) as tags", "parse_json('{\"a\": 1}') as v", "array(named_struct('m', map(1, 2))) as deep")
    docs = docs.union(docs.where("doc_id < 3").selectExpr("cast(null as bigint) as doc_id", *(f"`{c}`" for c in docs.columns[1:])))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = out.selectExpr(*(c for c in ("doc_id", "shard", "slot", "text_crc32") if c in out.columns)).collect()
        assert len(rows) > (20 if name == "language" else 0)
        assert out.columns == docs.columns or name == "shards"


def test_odd_tables(spark, sf_dir):
    """Empty tables, repeated ids with other texts, rows without an id, and columns with names that the stages use."""
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = "the house of the king and the garden in the north is not far from here " * 3
    rows = [(1, text, "en", "a", 1), (1, "and that is all there is to say about the weather of this year", "en", "a", 1), (None, text, "en", None, 1), (2, text, None, "b", 1), (3, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, base.schema)
    for c in ("_id", "_tid", "_maybe", "stays", "score", "weight", "shard", "_row", "_size", "leaks", "comp", "tokens"):
        docs = docs.withColumn(c, docs["n_chars"])
    empty, columns = docs.limit(0), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        out = stage(spark, docs, sf_dir)
        if name == "shards":
            assert out.count() == docs.count()
            continue
        assert out.columns == columns
        if name == "near_copies":
            assert sorted((r.doc_id or 0, r.n_chars) for r in out.collect()) == [(0, 1), (1, 1), (1, 1), (3, 0)]
