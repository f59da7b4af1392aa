import corpus_pipeline
import edge
import pytest
from tideline.llm import decontaminate, parity_join, pii_sanitise, sentencepiece_codec

ITEM = "What does a river carry to the sea each spring? It carries the melted snow of the high mountains and their dust."
COPY = "One more sentence about the old mill at the end of the long valley where water turns the wheel all day and all night. " * 3


def corpus():
    rows = [(i, f"Document {i} tells of river number {i * 7} and town number {i * 13} in its own words, with tree {i * 17} and hill {i * 19}.", "en", "s", 0) for i in range(40)]
    rows += [(100, COPY, "en", "s", 0), (101, COPY.upper(), "en", "s", 0), (102, COPY + "again", "en", "s", 0)]
    rows += [(200, rows[0][1] + " " + ITEM, "en", "s", 0), (300, "Write to jo@mail.example.com about the festival of lanterns in our town.", "en", "s", 0)]
    rows += [(400, "", "en", "s", 0), (401, None, "en", "s", 0)]
    return rows


def test_stages(spark, tmp_path):
    rows = corpus()
    edge.documents(spark, rows, clashes=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "sentencepiece"]
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # brute force, stage by stage: empty texts have no language, one of each group of copies, no leak, no address
    want = {i: t for i, t, *_ in rows if t and i not in (101, 102, 200)}
    want[300] = want[300].replace("jo@mail.example.com", "<EMAIL>")
    pieces = sentencepiece_codec.load_vocabulary(sentencepiece_codec.public_model()).pieces
    assert {i: sentencepiece_codec.decode(r.ids, pieces) for i, r in found.items()} == want
    assert all(r.n_ids == len(r.ids) and r.lang == "en" for r in found.values())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_edges_of_each_stage(spark, name, stage, tmp_path):
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edge.documents(spark, edge.ROWS * 2), edge.empty(spark)):
        out = stage(spark, docs, str(tmp_path))
        assert out.count() <= docs.count()
        if name != "sentencepiece":
            assert out.columns == docs.columns
            assert all(r[c] == c for r in out.collect() for c in edge.CLASHES)


def test_each_stage_calls_its_operator(spark, tmp_path, monkeypatch):
    called = []
    for module, f in ((parity_join, "keep_one_of_each"), (decontaminate, "decontaminate"), (pii_sanitise, "redact"), (sentencepiece_codec, "encode_documents")):
        monkeypatch.setattr(module, f, lambda docs, *a, f=f, **k: called.append(f) or docs)
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = edge.documents(spark, clashes=False)
    for _, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, docs, str(tmp_path))
    assert called == ["keep_one_of_each", "decontaminate", "redact", "encode_documents"]


def test_stricter_near_copies(spark, tmp_path):
    ws = [f"word{i}" for i in range(234)]

    def copy(*at):
        return " ".join("other" if i in at else w for i, w in enumerate(ws))

    # 5 of 234 words: 205 / 255 = 0.804 of the five-word shingles, 211 / 251 = 0.841 of the four-word ones; 6 words: 0.769
    near, far = copy(30, 70, 110, 150, 190), copy(20, 60, 100, 140, 180, 220)
    docs = edge.documents(spark, [(1, " ".join(ws), "en", "s", 0), (2, near, "en", "s", 0), (3, far, "en", "s", 0)])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()) == [1, 3]
    assert parity_join.keep_one_of_each(docs).count() == 3
