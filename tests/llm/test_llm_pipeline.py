"""The whole pipeline on small tables with planted cases."""

import random

import pytest

import corpus_pipeline
from rondel.llm import quality
from rondel.llm.shared import space_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, folder, docs, labels, items):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_empty_tables(spark, tmp_path):
    result = corpus_pipeline.run(spark, written(spark, tmp_path, [], [], []))
    assert result.collect() == []


@pytest.fixture
def planted(spark, tmp_path):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    line = lambda n: " ".join(rnd.choices(words, k=n))
    item = line(14)
    docs = [(i, "\n".join(line(12) for _ in range(6)), "en", "s", 300) for i in range(120)]
    bad = [(200 + i, " ".join(w + " $$$ !!!" for w in rnd.choices(words, k=40)), "en", "s", 300) for i in range(60)]
    special = [(300, docs[5][1], "en", "s", 300),                                  # an exact copy
               (302, line(30) + " " + item.upper() + " " + line(30), "en", "s", 300),  # a benchmark passage
               (303, line(40) + "\n" + docs[9][1].split("\n")[0], "en", "s", 300),  # repeats an earlier line
               (304, None, None, None, None), (305, "", "en", "s", 0)]
    labels = [(d[0], 1, 0) for d in docs[::2]] + [(d[0], 0, 0) for d in bad[::2]]
    return docs, bad, special, written(spark, tmp_path, docs + bad + special, labels, [(1, item), (2, None)])


def test_planted_cases(spark, planted):
    docs, bad, special, folder = planted
    found = corpus_pipeline.run(spark, folder).collect()
    left = {r["doc_id"] for r in found}
    assert {d[0] for d in docs} <= left and not {d[0] for d in bad} & left
    assert 302 not in left and 303 in left
    assert len({300, 304, 305} & left) == 1  # no lines are left in the copy, so these are equal
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_doc.values():
        assert sum(r["length"] for r in parts) == parts[0]["doc_tokens"]
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert max(r["offset"] + r["length"] for r in found) <= 4096


def test_stages_hand_on_what_they_keep(spark, planted):
    docs, bad, special, folder = planted
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, frame, folder)
    scored = quality.score(frame, quality.document_labels(spark.read.parquet(f"{folder}/labels.parquet")))
    assert {r[0] for r in good.select("doc_id").collect()} == {
        r[0] for r in scored.filter(f"good_probability >= {quality.MIN_GOOD}").select("doc_id").collect()}
    lines = corpus_pipeline.line_once(spark, frame, folder)
    assert lines.columns == frame.columns and lines.count() == frame.count()
    kept = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert docs[9][1].split("\n")[0] not in kept[303] and not space_words(kept[300])
