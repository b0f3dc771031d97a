"""The pipeline's stages against brute force on one small fixture."""
from collections import Counter, defaultdict


import corpus_pipeline
from tests.llm.test_corpus import SCHEMA, SPACES, brute_near, corpus, frame, toxic_corpus


def fixture(spark, tmp_path, clash):
    toxic, labels = toxic_corpus(4, 200)
    rows = [(r[0], r[1], "en", f"src{r[0] % 5}", 0) for r in toxic]
    rows += [((r[0] if r[0] is None else r[0] + 1000),) + r[1:] for r in corpus(21, 80)]
    frame(spark, rows, clash).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows, {k for k, _, t in labels if t}


def test_stages(spark, tmp_path):
    rows, toxic = fixture(spark, tmp_path, True)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs)
        assert name == "packing" or docs.columns == columns
    texts = [[(r["doc_id"], r["text"]) for r in d.collect()] for d in seen[:4]]
    clean = [(r[0], r[1]) for r in rows if r[0] not in toxic]
    assert Counter(texts[0]) == Counter(clean)
    largest = {}
    for d, t in clean:
        largest[t or ""] = max(largest.get(t or "", (False, 0)), (d is not None, d or 0))
    assert sorted((t or "", d is not None, d or 0) for d, t in texts[1]) == sorted((t, *d) for t, d in largest.items())
    now = [(d, t, "", "", 0) for d, t in texts[1]]
    _, sizes, group = brute_near(now, 5, 80)
    want = []
    for g in group.values():
        if not sizes[g[0]]:
            want += [now[i][0] for i in g]
        else:
            want.append(min((now[i][0] for i in g), key=lambda d: (d is None, d or 0)))
    assert Counter(d for d, _ in texts[2]) == Counter(want)
    size = {t: len(SPACES.findall(t or "")) for _, t in texts[2]}
    mixed = Counter(texts[3])
    assert set(mixed) <= set(texts[2]) and max(mixed.values()) <= 2 and all(size[t] for _, t in mixed)
    total = sum(size[t] for _, t in texts[2])
    assert abs(sum(size[t] * n for (_, t), n in mixed.items()) - 1.5 * total) < 0.15 * total
    pieces = seen[4].collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p["row_id"]] += p["length"]
    assert len(tokens) == sum(mixed.values())
    assert all(tokens[p["row_id"]] == p["doc_tokens"] for p in pieces)


def test_run_and_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [f.name for f in SCHEMA.fields] == ["doc_id", "text", "lang", "source", "n_chars"]
