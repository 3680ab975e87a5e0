"""The pipeline on a small corpus, stage by stage against brute force."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from tidefold.llm.quality import fit_quality


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(11)
    folder = tmp_path_factory.mktemp("corpus")
    words = lambda n: " ".join(f"{r.choice('abcdefg')}{r.choice('hijk')}{r.randrange(60)}" for _ in range(n))
    passage = words(70)
    rows, labels = [], []
    for i in range(120):
        if i % 6 == 5:
            text = "!! ".join(words(60).upper().split())
        else:
            text = words(90) + "\n" + "a line of the site" + "\n" + words(50)
            if i % 8 == 1:
                text += "\n" + words(10) + " " + passage + " " + words(9)
            if i % 20 == 4:
                text = rows[0][1].replace("\n", " \n", 1) if i % 40 == 4 else rows[0][1].rsplit(" ", 4)[0]
        rows.append((i, text if i != 77 else None, "en", "s", len(text)))
        labels.append((i, 0 if i % 6 == 5 else 1, 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def texts(df):
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark, corpus):
    from .test_near_and_substring import near_by_force, repeats_by_force

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "substring_dedup", "best_fit_packing"]
    given = texts(docs)
    good = corpus_pipeline.quality(spark, docs, corpus)
    scores = fit_quality(docs, spark.read.parquet(f"{corpus}/labels.parquet")).scores([(t or "").encode() for t in given.values()])
    assert texts(good) == {i: t for (i, t), s in zip(given.items(), scores, strict=True) if s >= 0.5}
    assert all(i % 6 != 5 for i in texts(good)) and len(texts(good)) >= 99

    good = spark.createDataFrame(good.collect(), docs.schema)
    cleaned = corpus_pipeline.lines(spark, good, corpus)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()  # noqa: E731  the corpus is ASCII
    seen = Counter(k for t in texts(good).values() for k in {key(x) for x in (t or "").split("\n")} if k)
    wanted = {i: "\n".join(x for x in (t or "").split("\n") if seen[key(x)] < 10) for i, t in texts(good).items()}
    assert texts(cleaned) == wanted and any("site" in t for t in given.values() if t) and not any("site" in t for t in wanted.values())

    cleaned = spark.createDataFrame(cleaned.collect(), docs.schema)
    single = corpus_pipeline.near_duplicates(spark, cleaned, corpus)
    groups = near_by_force(list(texts(cleaned).items()))
    assert set(texts(single)) == {i for i, (_, c) in groups.items() if c == i} and len(texts(single)) < len(groups)

    single = spark.createDataFrame(single.collect(), docs.schema)
    unique = corpus_pipeline.repeats(spark, single, corpus)
    removed = {i: n for i, _, n, _ in repeats_by_force(list(texts(single).items()), 50)}
    left = texts(unique)
    assert {i: len(re.findall(r"\S+", texts(single)[i] or "")) - len(re.findall(r"\S+", left[i] or "")) for i in left} == removed and sum(removed.values()) >= 70
    assert all(r["n_chars"] == len(r["text"]) for r in unique.collect() if r["text"] is not None)

    unique = spark.createDataFrame(unique.collect(), docs.schema)
    packed = corpus_pipeline.packing(spark, unique, corpus)
    assert {r["doc_id"] for r in packed.collect()} == set(left)


def test_run_is_the_stages_one_by_one(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
    plain = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert plain(corpus_pipeline.run(spark, corpus)) == plain(docs)


def test_stages_on_an_empty_table(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
