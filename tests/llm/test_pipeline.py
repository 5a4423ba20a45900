import random

import corpus_pipeline as C
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lines_removed string, none string"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    path = str(tmp_path_factory.mktemp("corpus"))
    texts = [_words(rng, 60) + ".\n" + _words(rng, 30) for _ in range(300)]
    bad = {i for i in range(300) if i % 5 == 0}
    texts = [" | ".join(t.split()) if i in bad else t for i, t in enumerate(texts)]
    items = [_words(rng, 25) for _ in range(4)]
    texts[1] += " " + items[0].upper()
    texts[2] = texts[3]  # an exact copy
    passage = _words(rng, 55)
    texts[6] += "\n" + passage
    texts[7] = passage + "\n" + texts[7]
    texts[9] = texts[8].title()  # other lines, but the same words
    rows = [(i, t, "en", "s", len(t), "x", "y", None) for i, t in enumerate(texts)]
    rows += [(400, None, None, None, None, None, None, None), (401, "", "en", "s", 0, None, None, None), (11, texts[11], "en", "s", 5, "x", "y", None), (None, texts[12], "en", "s", 5, None, None, "n")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in bad), 0) for i in range(0, 300) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, bad, passage


def test_each_stage(spark, corpus):
    from riskfold.llm.common import saved

    path, texts, bad, passage = corpus
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in C.STAGES:
        docs = saved(stage(spark, docs, path), name)
        seen[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == [c.strip().split()[0] for c in SCHEMA.split(",")]
    kept = {r.doc_id for r in seen["quality_classifier"]}
    assert not kept & bad and {i for i in range(300) if i not in bad} <= kept
    lines = {r.doc_id: r for r in seen["line_dedup"]}
    assert 3 not in lines and lines[2].text == texts[2]
    assert passage in lines[6].text and passage not in lines[7].text and lines[7].n_chars == len(lines[7].text)
    assert lines[6].n_chars == len(texts[6]) and lines[6].score == "x" and lines[6].lines_removed == "y"
    near = [r.doc_id for r in seen["simhash_near_dedup"]]
    assert 8 in near and 9 not in near and near.count(11) == 1
    clean = {r.doc_id for r in seen["benchmark_decontamination"]}
    assert 1 not in clean and set(near) - clean == {1}
    assert {r.doc_id for r in seen["best_fit_packing"]} == clean


def test_run_gives_the_last_stage(spark, corpus):
    out = C.run(spark, corpus[0])
    assert out.columns[:4] == ["doc_id", "piece", "start", "length"] and out.count() > 0


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_keeps_distinct_texts_with_null_or_equal_ids(spark):
    rng = random.Random(31)
    texts = [_words(rng, 40) for _ in range(8)]
    ids = [None, None, None, None, 7, 7, 8, 9]
    rows = [(i, t, "en", "s", len(t), "x", "y", None) for i, t in zip(ids, texts, strict=True)]
    rows += [(None, texts[0].title(), "en", "s", 5, "x", "y", None), rows[4], (10, texts[6].upper(), "en", "s", 5, "x", "y", None)]
    got = C.dedup_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((str(r.doc_id), r.text.lower()) for r in got) == sorted((str(i), t) for i, t in zip(ids, texts, strict=True))


def test_without_a_usable_label_all_documents_stay(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, None, "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(9, 1), (1, None)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.quality_classifier(spark, docs, str(tmp_path)).count() == 2


def test_stages_on_a_very_long_text(spark, corpus):
    """One text of half a million words among the others goes through every stage whole."""
    from riskfold.llm.common import saved

    path, texts, _, _ = corpus
    rng = random.Random(99)
    long = "\n".join(_words(rng, 50) + "." for _ in range(10_000))
    base = spark.read.parquet(f"{path}/documents.parquet")
    docs = base.filter("doc_id < 40").unionByName(spark.createDataFrame([(900, long, "en", "s", len(long), None, None, None)], SCHEMA))
    labels = [C.dedup_lines, C.dedup_near_copies, C.decontaminate_benchmark]
    for stage in labels:
        docs = saved(stage(spark, docs, path), stage.__name__)
        assert docs.filter("doc_id = 900").first().text == long
    pieces = C.pack(spark, docs.filter("doc_id = 900"), path).collect()
    assert len({p.sequence_id for p in pieces}) == len([p for p in pieces if p.offset == 0])
    assert sum(p.length for p in pieces) >= 500_000
