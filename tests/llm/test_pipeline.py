"""The pipeline on a small corpus with planted cases, against plain rules."""

import random

import corpus_pipeline
from careledger.llm.common import staged
from tests.llm.test_docs import prose

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"


def corpus():
    draw = random.Random(9)
    rows = {i: prose(draw, 40) for i in range(200)}
    toxic = range(0, 40)
    for i in toxic:
        rows[i] += " you rotten vile creature rotten"
    rows[100] = rows[101]
    rows[103] = rows[102].rsplit(" ", 1)[0] + " changed"
    item = prose(draw, 20)
    rows[110] = prose(draw, 10) + " " + item
    rows[120] = rows[120] + " mail x@example.org now"
    rows[121] = None
    rows[122] = ""
    return rows, toxic, item


def test_stages(spark, tmp_path):
    rows, toxic, item = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "e") for i, t in rows.items()], SCHEMA)
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(180)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, str(tmp_path)), name)
        left.append(docs)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"]
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in left]
    assert ids[0] == set(rows) - set(toxic)
    assert ids[1] == ids[0] - {101, 103}
    assert ids[2] == ids[1] - {110}
    assert ids[3] == ids[4] == ids[2]
    texts = {r["doc_id"]: r for r in left[3].collect()}
    assert texts[120]["text"] == rows[120].replace("x@example.org", "[EMAIL]")
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in texts.values() if r["text"] is not None)
    assert {i: texts[i]["text"] for i in (121, 122, 150)} == {121: None, 122: "", 150: rows[150]}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left[4].count()
