import corpus_pipeline as cp
from wardflow.llm import contamination, packing, simhash, toxicity


def _stages(spark, docs, sf, path):
    out = [docs]
    for name, stage in cp.STAGES:
        stage(spark, out[-1], sf).write.parquet(str(path / name))
        out.append(spark.read.parquet(str(path / name)))
    return out


def test_every_stage_against_its_operator(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    raw, calm, single, clean, masked, packed = _stages(spark, docs, sf_small, tmp_path)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert all(d.columns == docs.columns for d in (calm, single, clean, masked))
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    rows = raw.collect()
    scored = toxicity.score_texts([r["text"] for r in rows], chain)
    scores = {r["doc_id"]: s for r, (s, _, _) in zip(rows, scored, strict=True)}
    assert ids(calm) == {d for d, s in scores.items() if s < 0.5}
    classes = simhash.near_duplicates(calm).collect()
    assert ids(single) == {r["component_id"] for r in classes}
    bad = {r["doc_id"] for r in contamination.find_items(single, spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    assert bad and ids(clean) == ids(single) - bad
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    after = {r["doc_id"]: r for r in masked.collect()}
    assert set(before) == set(after)
    for d, r in after.items():
        assert r["n_chars"] == len(r["text"]) and (r["text"] == before[d] or "[SECRET]" in r["text"])
    assert ids(packed) == set(after)
    whole = packing.pack(masked, ["doc_id"]).count()
    assert packed.count() == whole


def test_odd_rows_pass_every_stage(spark, sf_small, odd_docs, no_docs, tmp_path):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    out = _stages(spark, plain, sf_small, tmp_path / "odd")
    single = out[2].collect()
    assert sum(r["doc_id"] == 1 for r in single) == 1  # repeated row and its near copy: one
    assert not any(r["doc_id"] in (2, 4, 5) for r in single)  # near copy; wordless texts form one class
    assert out[-1].count() > 0
    empty = _stages(spark, no_docs, sf_small, tmp_path / "none")
    assert [d.count() for d in empty] == [0] * 6


def test_run_equals_the_stages(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    last = _stages(spark, docs, sf_small, tmp_path)[-1]
    key = lambda df: sorted((r["doc_id"], r["doc_tokens"]) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert key(cp.run(spark, sf_small)) == key(last)


def test_every_group_keeps_a_row_whatever_its_ids(spark, sf_small):
    unlike = ["the cat sat on a warm mat all day long", "rivers run down to the cold northern sea in spring",
              "nobody counted every star above that quiet village", "seven old engines pulled coal over the mountain pass"]
    rows = [(None, t) for t in unlike] + [(None, unlike[0].upper()), (1, "bread and cheese taste best near an open fire"),
                                          (1, "our ship left harbour under grey autumn skies"),
                                          (2, "Our ship left harbour under grey autumn skies")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["text"].lower()) for r in cp.drop_near_copies(spark, docs, sf_small).collect()]
    assert sorted(got, key=str) == sorted([(None, t) for t in unlike] + [(1, t) for _, t in rows[5:7]], key=str)


def test_a_contaminated_row_takes_no_other_of_its_id(spark, sf_small):
    item = next(r["text"] for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").orderBy("item_id").collect()
                if len((r["text"] or "").split()) > 8)
    rows = [(1, f"before {item} after"), (1, "a text of the same number that holds no item"),
            (None, f"again {item}"), (None, "another one without a number"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in cp.drop_contaminated(spark, docs, sf_small).collect()]
    assert sorted(got, key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
