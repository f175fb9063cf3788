import corpus_pipeline
from lodestrata.llm import sentencepiece_codec, suffix_dedup
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_minhash_dedup import brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_on_documents(spark, tmp_path):
    def stored(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    good = stored(corpus_pipeline.keep_good(spark, docs, SF), "good")
    one = stored(corpus_pipeline.keep_one_of_each(spark, good, SF), "one")
    cut = stored(corpus_pipeline.cut_repeats(spark, one, SF), "cut")
    clean = stored(corpus_pipeline.drop_leaks(spark, cut, SF), "clean")
    for stage in (good, one, cut, clean):
        assert stage.columns == docs.columns
    before = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert 0 < len(before) < docs.count()
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c[0] for c in brute_classes(before).values()})
    rest = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    spans = {r["doc_id"]: r["spans"] for r in suffix_dedup.remove_repeats(spark, one, returns=["spans"]).collect()}
    for r in one.collect():
        data, at, kept = r["text"].encode(), 0, b""
        for a, b in zip(spans[r["doc_id"]][::2], spans[r["doc_id"]][1::2]):
            kept, at = kept + data[at:a], b
        text = (kept + data[at:]).decode("utf-8", "ignore")
        assert rest[r["doc_id"]] == (text, len(text))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {key for _, key, _ in leaks([(k, t) for k, (t, _) in rest.items()], items)}
    assert {r["doc_id"] for r in clean.collect()} == set(rest) - leaked
    final = corpus_pipeline.run(spark, SF)
    assert final.count() == clean.count() and final.where("NOT parity").count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    text = "the river and the stone are in the morning light of a bright day " * 4
    rows = [(1, None, "en", "s", 0), (None, text + "1", "en", None, 1), (None, text + "1", "en", None, 1), (3, text + "1", None, "s", 1), (4, "", "xx", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, node long, kept boolean"
    for n, docs in enumerate((spark.createDataFrame([(*r, "r", 1, False) for r in rows], schema), spark.createDataFrame([], schema))):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{n}-{i}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{i}")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert corpus_pipeline.tokenize(spark, docs, SF).count() == docs.count()


def test_encoding_uses_the_model_it_is_given():
    assert sentencepiece_codec.parse_model(b"").pieces == []
