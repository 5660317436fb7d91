from cases import documents, frame, unique_ids, words
from test_duplicates import brute_components, brute_repeats
from pyspark.sql import functions as F

import corpus_pipeline
from postloom.llm import langid


def test_stages_against_brute_force(spark, tmp_path):
    rows = unique_ids(documents())
    df = frame(spark, rows).withColumns({"source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: t for i, t, _ in rows}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "best-fit packing":
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        found = {r.doc_id: r for r in got.collect()}
        before = [(i, t, None) for i, t in texts.items()]
        if name == "language ID":
            model = langid.train(docs.where(~langid.held_out()))
            keep = {i for i, t in texts.items() if (j := model.predict(t))[0] != "und" and j[1] >= corpus_pipeline.LEAST_SCORE}
            assert set(found) == keep and not {3, 4, 5} & keep
        elif name == "MinHash near-dedup":
            assert set(found) == {i for i, (_, _, kept) in brute_components(before, 80).items() if kept}
        elif name == "substring dedup":
            want = brute_repeats([(i, t or "", x) for i, t, x in before], 20)
            assert set(found) == {i for i, (n, gone, _) in want.items() if n > gone}
            for i, r in found.items():
                assert len(words(r.text)) == want[i][0] - want[i][1] and r.n_chars == len(r.text)
        else:
            assert set(found) == set(texts)
        if name != "best-fit packing":
            texts = {i: r.text for i, r in found.items()}
        docs = got


def test_run_and_empty_input(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "MinHash near-dedup", "substring dedup", "best-fit packing"]
    df = frame(spark, documents()).withColumns({"source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    df.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
