import random

import corpus_pipeline


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert n * 0.85 < docs.count() <= n
            n = docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "suffix_array_dedup", "pii_surrogates", "packing"]
    assert docs.select("doc_id").distinct().count() == n


def test_passages_of_short_words_go(spark):
    rng = random.Random(4)
    made = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(n))
    passage, short, other = made(51), made(30), made(30)
    tiny = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=51))
    texts = [f"{made(60)} {passage}. {made(9)}", f"{made(40)} {passage}, {made(70)}", f"{made(20)} {short} {other} {made(20)}", f"{made(20)} {short} {made(20)}", f"{made(20)} {other} {made(20)}", f"{made(9)} {tiny}", f"{tiny} {made(9)}"]
    df = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.suffix_dedup(spark, df, "").collect()}
    for k, there in [(0, passage), (1, passage), (5, tiny), (6, tiny)]:
        assert len(passage) < 256 and got[k].text == texts[k].replace(there, "") and got[k].n_chars == len(got[k].text)
    # Two short passages in a row, each repeated elsewhere, are not a long one.
    assert all(got[k].text == texts[k] for k in (2, 3, 4))


def test_templates_pass_the_join_whole(spark):
    """More texts of one template than a run may have, none near another: all stay, with all their columns."""
    rng = random.Random(3)
    made = lambda n: [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n))]
    shared = made(300)
    rows = [(k, " ".join(shared + made(100)), f"s{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, corpus_pipeline.jaccard_join(spark, df, "").collect())) == rows
