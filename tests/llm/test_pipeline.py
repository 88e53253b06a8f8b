"""The corpus pipeline stage by stage against brute force on small data."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_operators import CLASH, EDGE, SCHEMA, brute_components, brute_lines

from relayout.llm import bpe, language
from relayout.llm.common import stage

SMOKE = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}

    one = stage(corpus_pipeline.identify_language(spark, docs, SMOKE), "t1")
    rejected = {r.doc_id for r in language.classify(docs, language.learn(docs)).where("rejected").collect()}
    kept = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == columns and kept == {k: v for k, v in texts.items() if k not in rejected}

    two = stage(corpus_pipeline.dedup_lines(spark, one, SMOKE), "t2")
    want = {k: v for k, v in brute_lines(sorted(kept.items())).items() if v.strip()}
    kept = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == columns and kept == want and two.where("n_chars <> length(text)").count() == 0

    three = stage(corpus_pipeline.drop_similar(spark, two, SMOKE), "t3")
    found = brute_components(sorted(kept.items()), 5, 80, 100)
    assert three.columns == columns and {r.doc_id for r in three.collect()} == {i for i, (_, c) in found.items() if i == c}

    four = stage(corpus_pipeline.mix_sources(spark, three, SMOKE), "t4")
    times = {r.doc_id: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert four.columns == columns and set(times.values()) <= {1, 2} and four.count() > three.count()

    five = corpus_pipeline.tokenize(spark, four, SMOKE)
    coder = bpe.Encoder(bpe.read_spec())
    for r in five.collect():
        assert r.ids == coder.encode(kept[r.doc_id]) and r.decoded == coder.decode(r.ids)


def test_run_on_edge_and_empty_tables(spark, tmp_path):
    """Null, empty, letterless and very long texts, null ids, repeated rows and foreign columns; and no row at all."""
    model = [(100 + i, f"the quick brown fox number {i} jumps over a lazy dog and runs away {w}", "en", "a", 0)
             for i, w in enumerate(["home", "fast", "again", "today", "soon"])]
    rows = spark.createDataFrame(EDGE + model, SCHEMA)
    for name, df in (("edge", rows.select("*", *[F.lit(7).alias(c) for c in CLASH])), ("empty", rows.where("false"))):
        folder = str(tmp_path / name)
        df.write.parquet(f"{folder}/documents.parquet")
        out = corpus_pipeline.run(spark, folder)
        got = {r.doc_id for r in out.collect()}
        assert got <= {r.doc_id for r in df.collect()} and (name == "edge") == bool(got)
        assert {"ids", "decoded"} <= set(out.columns)
