import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidefold.llm.bpe import bpe_decode, bpe_digests, bpe_encode
from tidefold.llm.labelled import training_rows
from tidefold.llm.license_scan import BASE_PHRASES, automaton, evaluate, license_scan, scan_text
from tidefold.llm.packing import cut, pack, pack_classes, place
from tidefold.llm.quality import Embeddings, fit_quality, keep_good, score_texts
from tidefold.llm.queries import vocabulary
from tidefold.llm.toxicity import FactorizationMachine, fit_toxicity

DATA = "/root/testdata/sf0.01"


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("dictionary", "unit"), [(0, 1), (30, 50), (100_000, 10**6)])
def test_bpe(docs, library, dictionary, unit):
    """With all words in the dictionary, with none and with some; with units of a text, of some and of a whole partition."""
    v = vocabulary("byte_bpe_50k.tiktoken")
    encode = v.encoder().encode_ordinary
    source = rows(docs, "doc_id", "text")
    got = rows(bpe_decode(bpe_encode(docs, v, dictionary_words=dictionary, unit_words=unit), v), "doc_id", "ids", "decoded")
    want = [(i, encode(t or ""), (t or "").encode()) for i, t in source]
    assert sorted((str(a), list(b), bytes(c)) for a, b, c in got) == sorted((str(a), b, c) for a, b, c in want)
    assert all(encode(t or "") == library(t or "") for _, t in source)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    digests = rows(bpe_digests(docs, v, dictionary_words=dictionary, unit_words=unit), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(digests, key=str) == sorted(((i, len(x), sha(" ".join(map(str, x)).encode()), sha(t)) for i, x, t in want), key=str)


def test_bpe_odd_texts(spark):
    v = vocabulary("byte_bpe_50k.tiktoken")
    odd = ["\x1c\x1d\x85 ᠎  x", "I'LL i'll  \n\n", "٣४ 12a", "🙂🙂 é", "\x00\x01", "a" * 2000 + " " + "é" * 300, "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for unit in (1, 1000):
        got = {i: list(x) for i, x in rows(bpe_encode(df, v, dictionary_words=4, unit_words=unit), "doc_id", "ids")}
        assert got == {i: v.encoder().encode_ordinary(t) for i, t in enumerate(odd)}


def test_bpe_with_more_words_than_any_bound(spark):
    """Sixty thousand distinct words beside a dictionary of a hundred and units of a thousand; texts cross the units' ends."""
    v = vocabulary("byte_bpe_50k.tiktoken")
    df = spark.range(0, 600, 1, 3).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.hex(F.xxhash64("id", i))), F.lit("the end")).alias("text"))
    encode = v.encoder().encode_ordinary
    got = {i: list(x) for i, x in rows(bpe_encode(df, v, dictionary_words=100, unit_words=1000), "doc_id", "ids")}
    assert got == {i: encode(t) for i, t in rows(df, "doc_id", "text")}


def test_bpe_of_nothing(nothing):
    v = vocabulary("byte_bpe_50k.tiktoken")
    assert bpe_encode(nothing, v).count() == 0 and bpe_digests(nothing, v).count() == 0


@pytest.mark.parametrize(("choose", "docs_at_most", "cost"), [("norm", None, None), ("dot", None, None), ("norm", 4, None), ("dot", 3, 2048 * 900)])
def test_classes_pack_like_piece_by_piece(choose, docs_at_most, cost):
    r = np.random.default_rng(0)
    lengths = np.minimum(r.lognormal(5.5, 1.1, 800).astype(int) + 1, 2048 if cost is None else 1300)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    segments, total = pack_classes(counts, 2048, docs_at_most, cost, choose=choose)
    full = np.array([2048, docs_at_most or np.inf, cost or np.inf])
    scale = np.array([1 / 2048, 1 / docs_at_most if docs_at_most else 0, 1 / cost if cost else 0])
    bins = []
    for x in sorted(lengths.tolist(), reverse=True):
        need = np.array([x, 1, x * x], float)
        fit = [k for k, b in enumerate(bins) if (b >= need).all()]
        if fit:
            left = np.where(np.isinf(np.array(bins)[fit]), 0, np.array(bins)[fit])
            k = fit[np.argmin((((left - need) * scale) ** 2).sum(1))] if choose == "norm" else fit[np.argmax((left * scale * need * scale).sum(1))]
            bins[k] = bins[k] - need
        else:
            bins.append(full - need)
    assert total == len(bins)
    ranks = np.concatenate([np.arange(n) for _, n in sorted(counts.items())])
    order = np.sort(lengths)
    sequence, offset = place(segments)(order, ranks)
    used = np.bincount(sequence, weights=order)
    assert sorted(used) == sorted(2048 - b[0] for b in bins)
    for s in range(total):
        own = np.argsort(offset[sequence == s])
        assert (offset[sequence == s][own] == np.concatenate([[0], np.cumsum(order[sequence == s][own])[:-1]])).all()
    if docs_at_most:
        assert np.bincount(sequence).max() <= docs_at_most
    if cost:
        assert np.bincount(sequence, weights=order.astype(float) ** 2).max() <= cost


def test_registered_packings_use_all_components(spark, monkeypatch):
    """The query and the pipeline choose by tokens, documents and cost; by capacities that cost no sequence."""
    import corpus_pipeline
    from tidefold.llm import packing, queries

    given, real = [], packing.pack_classes
    monkeypatch.setattr(packing, "pack_classes", lambda *x: given.append(x) or real(*x))
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for df in (queries.op2_best_fit_packing(spark, folder), corpus_pipeline.packing(spark, docs, folder)):
        assert df.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()
    assert [x[2:4] for x in given] == [(2048, 2048**2)] * 2
    r = np.random.default_rng(3)
    lengths = np.minimum(r.lognormal(5.5, 1.1, 3000).astype(int) + 1, 2048)
    for counts in (given[0][0], {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}, {1: 5000}):
        assert pack_classes(counts, 2048, 2048, 2048**2)[1] <= pack_classes(counts, 2048)[1]


def test_pack_needs_room():
    with pytest.raises(ValueError):
        pack_classes({100: 1}, 2048, max_cost=50)
    assert pack_classes({}, 2048) == ([], 0)


def test_cut():
    ids = np.arange(10, dtype=np.uint32)
    assert [(p["start"], p["length"]) for p in cut(ids, 4)] == [(0, 2), (2, 4), (6, 4)]
    assert [(p["start"], p["length"]) for p in cut(ids[:8], 4)] == [(0, 4), (4, 4)]
    assert [(p["start"], p["length"]) for p in cut(ids[:1], 4)] == [(0, 1)]


def test_pack(docs, library):
    got = rows(pack(docs, vocabulary("byte_bpe_50k.json"), max_tokens=256), "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    wanted = []
    for i, t in rows(docs, "doc_id", "text"):
        ids = np.array([*library(t or ""), 0], dtype="<u4")
        wanted += [(i, p["piece"], p["start"], p["length"], zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())) for p in cut(ids, 256)]
    assert sorted((r[:5] for r in got), key=str) == sorted(wanted, key=str)
    places = {}
    for *_, length, _, sequence, offset in got:
        places.setdefault(sequence, []).append((offset, length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 256
    assert len(places) <= 1.05 * sum(r[3] for r in got) / 256 + 1


def test_pack_stores_the_pieces_only(docs, monkeypatch):
    """Each file of a scratch table can start a process that doubles an executor's memory for a moment."""
    from tidefold.llm import packing

    stored, write = [], packing.materialise
    monkeypatch.setattr(packing, "materialise", lambda df, name, **how: stored.append(name) or write(df, name, **how))
    assert pack(docs, vocabulary("byte_bpe_50k.json"), max_tokens=256).count() > docs.count()
    assert stored == ["pieces"]


def test_pack_takes_added_tokens_as_the_library_does(spark):
    """The library as the contract calls it, with nothing set."""
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y \n", "<|endoftext| >", "a  <|endoftext|>\n\n<|ENDOFTEXT|>", "no marker"]
    texts.append("one two three <|endoftext|> " * 30)
    got = rows(pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary("byte_bpe_50k.json"), max_tokens=32), "doc_id", "piece", "start", "length", "ids_crc32")
    wanted = []
    for i, t in enumerate(texts):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        wanted += [(i, *p.values()) for p in cut(ids, 32)]
    assert sorted(got) == sorted(wanted)


def test_pack_nothing(nothing):
    assert pack(nothing, vocabulary("byte_bpe_50k.json")).count() == 0


def auc(labels, scores):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    y = np.array(labels)
    return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())


@pytest.mark.parametrize(("fit", "label", "modulus", "remainder", "least"), [(fit_quality, "quality", 3, 1, 0.97), (fit_toxicity, "toxic", 4, 2, 0.8)])
def test_classifiers_on_held_out_rows(spark, fit, label, modulus, remainder, least):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = fit(docs, labels, modulus=modulus, remainder=remainder)
    got = {r["doc_id"]: r for r in score_texts(docs, model, modulus=modulus, remainder=remainder).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % modulus == remainder) for i, r in got.items())
    pairs = [(y, got[i]["score"]) for i, y in rows(labels, "doc_id", label) if got[i]["held_out"]]
    assert auc(*zip(*pairs, strict=True)) > least
    again = fit(docs, labels, modulus=modulus, remainder=remainder)
    assert again.scores([b"some text"]) == model.scores([b"some text"])


ODD_TEXTS = [b"", b"  ", "naïve naïve 漢字 élan".encode(), b"the the end of a line", b"x" * 5000, b"A-Z 09 insult group"]


def learning_set(kind, n=400):
    r = np.random.default_rng(5)
    bad = ["buy buy now", "win cash", "spam spam"] if kind == "quality" else ["insult group", "hate them", "insult them"]
    return [(f"{' '.join('w%d' % k for k in r.integers(0, 300, 20))} {bad[i % 3] if i % 2 else 'calm words'}".encode(), int((i % 2 == 0) == (kind == "quality"))) for i in range(n)]


def test_quality_score_is_the_softmax_of_a_mean_of_vectors():
    """The shipped settings; vectors, output layer and hashing written out over the model that was learnt."""
    texts, labels = zip(*learning_set("quality"), strict=True)
    kept = {}

    class Kept(Embeddings):
        def keep(self, vectors, out, bias):
            kept.update(vectors=vectors.copy(), out=out.copy(), bias=bias.copy())
            super().keep(vectors, out, bias)

    model = Kept().fit(list(texts), list(labels))
    assert (model.buckets, model.dims) == (1 << 17, 10)

    def brute(text):
        words, features = text.decode().split(), []
        for k, w in enumerate(words):
            own = f"<{w}>"
            features += [own] + [own[i : i + n] for n in (2, 3, 4) for i in range(len(own) - n + 1)]
            features += ["\x00again"] if k and w == words[k - 1] else []
        hidden = np.mean([kept["vectors"][zlib.crc32(f.encode()) % (1 << 17)] for f in features], axis=0) if features else np.zeros(10)
        z = np.exp(hidden @ kept["out"] + kept["bias"])
        return z[1] / z.sum()

    for t in [*ODD_TEXTS, *texts[:5]]:
        assert model.scores([t])[0] == pytest.approx(brute(t), abs=1e-4)


def test_toxicity_score_is_the_sum_over_pairs_of_terms():
    """The shipped settings; every pair of terms is gone through."""
    texts, labels = zip(*learning_set("toxic"), strict=True)
    model = FactorizationMachine().fit(list(texts), list(labels))
    for t in [*ODD_TEXTS, *texts[:5]]:
        ids = sorted({int(i) for i in model.terms(t, {})})
        own = [i for i in ids if model.weights[i] != 0 or model.paired[i]]
        z = model.bias + sum(float(model.weights[i]) for i in ids)
        z += sum(float(model.vectors[i] @ model.vectors[j]) for a, i in enumerate(own) for j in own[a + 1 :])
        assert model.scores([t])[0] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_training_rows_are_bounded_and_not_held_out(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(3, None, 1), (4, 1, 1), (None, 1, 1), (5, 7, 0)], "doc_id long, quality int, toxic int")
    texts, y = training_rows(docs, labels, "quality", 3, 1, 20, 100)
    assert 0 < len(texts) <= 20 and all(len(t) <= 100 for t in texts) and set(y) <= {0, 1}


def test_classifiers_without_labels_and_texts(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for fit in (fit_quality, fit_toxicity):
        got = rows(score_texts(docs, fit(docs, none)), "doc_id", "score", "predicted")
        assert len(got) == docs.count() and {s for _, s, _ in got} == {0.5}
        assert score_texts(nothing, fit(nothing, none)).count() == 0


def test_pairs_of_terms_count():
    """Neither term tells alone; only both together do.  A linear model stays at chance."""
    r = np.random.default_rng(0)
    texts, labels = [], []
    for _ in range(1200):
        a, b = r.integers(0, 2, 2)
        texts.append(f"{'insult' if a else 'praise'} {'group' if b else 'thing'} w{r.integers(9)}".encode())
        labels.append(int(a == b))
    model = FactorizationMachine(buckets=1 << 12, epochs=20, l1=0.0, factor_rate=0.1).fit(texts, labels)
    right = np.mean([(s >= 0.5) == y for s, y in zip(model.scores(texts), labels, strict=True)])
    assert right > 0.95


def test_pairs_in_a_few_texts_count_with_the_parameters_of_the_query():
    """One text in twenty holds a telling pair, among sixty words of a skewed vocabulary; the labels of the others are chance."""
    chance = 1 / np.arange(1, 3001) ** 0.9

    def corpus(n, seed):
        r = np.random.default_rng(seed)
        for _ in range(n):
            words = [f"w{k}" for k in r.choice(3000, 60, p=chance / chance.sum())]
            pair = r.random() < 0.05
            a, b = r.integers(0, 2, 2)
            if pair:
                words.insert(r.integers(60), "insult" if a else "praise")
                words.insert(r.integers(60), "group" if b else "thing")
            yield " ".join(words).encode(), int(a == b if pair else r.random() < 0.5), pair

    texts, labels, _ = zip(*corpus(8000, 0), strict=True)
    model = FactorizationMachine().fit(list(texts), list(labels))
    texts, labels = zip(*[(t, y) for t, y, pair in corpus(8000, 1) if pair], strict=True)
    assert np.mean([(s >= 0.5) == y for s, y in zip(model.scores(list(texts)), labels, strict=True)]) > 0.8


def test_quality_filter(docs):
    model = Embeddings(buckets=1 << 12).fit([b"good words here"] * 20 + [b"x!! y!! z!!"] * 20, [1] * 20 + [0] * 20)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert model.scores([b"a!! b!!"])[0] < 0.5 < model.scores([b"here good"])[0]


def test_license_scan(docs):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    got = sorted(rows(license_scan(docs), "doc_id", "n_words", "starts", "base_labels"), key=str)
    wanted = []
    for i, t in rows(docs, "doc_id", "text"):
        w = pattern.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        hits = [(k, label) for p, label in BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        wanted.append((i, len(w), sorted(k for k, _ in hits), sorted({x for _, x in hits})))
    assert sorted(((a, b, sorted(c), d) for a, b, c, d in got), key=str) == sorted(wanted, key=str)
    assert any(c for _, _, c, _ in wanted)


def test_license_expressions(spark):
    assert evaluate("MIT OR Apache-2.0 AND GPL-3.0") == (["apache-2.0", "gpl-3.0", "mit"], 1)
    assert evaluate("(MIT OR Apache-2.0) AND GPL-3.0") == (["apache-2.0", "gpl-3.0", "mit"], 3)
    assert evaluate("GPL-2.0 WITH Classpath-exception-2.0")[1] == 2
    for bad in ("", "MIT OR", "(MIT", "MIT)", "MIT GPL", "AND MIT", "a,b"):
        assert evaluate(bad) is None
    t = ["/* SPDX-License-Identifier: MIT OR GPL-2.0 */\nunder the mit license under the MIT License", "SPDX-License-Identifier: MIT OR", "cc by nc by nc; Apache License, Version 2.0", None, "under the mit licenses"]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan(df).collect()}
    assert got[0]["labels"] == ["gpl-2.0", "mit"] and len(got[0]["starts"]) == 2 and got[0]["score"] == 1.0 and got[0]["expressions"][0]["restriction"] == 1
    assert got[1]["labels"] == [] and got[1]["score"] == 0.3
    assert got[2]["base_labels"] == ["apache-2", "cc-by-nc"] and got[2]["starts"] == [0, 5]
    assert got[3]["n_words"] == 0 and got[4]["starts"] == [] and got[4]["score"] == 0.0


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("SPDX-License-Identifier: MIT, see LICENSE", ["mit"], 1.0),
        ("SPDX-License-Identifier: MIT.", ["mit"], 1.0),
        ("SPDX-License-Identifier: GPL-2.0+ SPDX-License-Identifier: MIT OR SPDX-License-Identifier: Apache-2.0", ["apache-2.0", "gpl-2.0+", "mit"], 1.0),
        ("(SPDX-License-Identifier: (MIT OR ISC) AND Zlib) and more", ["isc", "mit", "zlib"], 1.0),
        ("# SPDX-License-Identifier: MIT Permission is hereby granted # SPDX-License-Identifier: X11", ["mit", "x11"], 1.0),
        ("SPDX-License-Identifier:\r\n * MIT OR X11\n * more", ["mit", "x11"], 1.0),
        ("SPDX-License-Identifier: MIT AND (see LICENSE)", ["mit"], 1.0),
        ("SPDX-License-Identifier:\nimport os", [], 0.3),
        ("SPDX-License-Identifier: (MIT OR\nISC)", [], 0.3),
        ("SPDX-License-Identifier: MIT OR */", [], 0.3),
        ("SPDX-License-Identifier: , MIT", [], 0.3),
        ("SPDX-License-Identifier: MIT\nand prose", ["mit"], 1.0),
        ("SPDX-License-Identifier: MIT/ISC", [], 0.3),
        ("SPDX-License-Identifiers: MIT spdx license identifier", [], 0.3),
    ],
)
def test_expressions_end_where_the_grammar_ends(text, labels, score):
    _, _, _, got, _, strongest = scan_text(automaton(), text.encode())
    assert (got, strongest) == (labels, score)


def test_license_of_nothing(nothing):
    assert license_scan(nothing).count() == 0


def test_a_worker_keeps_one_pass_only(spark):
    """Data of a pass go with it, the broadcast's copy included, and come back with it."""
    from tidefold.llm import bpe

    words, ids = spark.sparkContext.broadcast(["a", "b"]), spark.sparkContext.broadcast([1, 2, 3])

    def passes(_):
        found = []
        for shared, make in ((words, list), (ids, tuple), (words, list)):
            found.append((len(bpe.loaded("x", shared, make)), hasattr(words, "_value"), hasattr(ids, "_value"), len(bpe._loaded)))
        return [found]

    assert spark.sparkContext.parallelize([0], 1).mapPartitions(passes).collect() == [[(2, False, False, 1), (3, False, False, 1), (2, False, False, 1)]]


def test_digests_of_few_ids():
    from tidefold.llm import bpe

    table = [b"a", b"bc", b"", b"\xff\x00"]
    _, strings, digits = bpe.word_ids((np.array([1], np.int32), np.array([1], np.int32), table))
    for ids in ([], [2], [2, 2], [0, 1, 3, 2], [3]):
        wanted = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(b"".join(table[i] for i in ids)).hexdigest()
        assert bpe.digest(np.array(ids, np.int32), strings, digits) == (len(ids), *wanted)
    assert bytes(bpe.strung(digits, np.array([3, 0], np.int32))) == b"3 0 "


def test_words_are_split_as_regex_does_without_it(monkeypatch):
    import random

    import public_tokenizers
    import regex

    from tidefold.llm import bpe

    wanted = regex.compile(public_tokenizers.PATTERN).findall
    r = random.Random(5)
    odd = "aZ  '\t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2028\u3000\u200b09²½Ⅷ一٣éßñ_-.\u0301ʰ\ufeff\uffff"
    texts = ["".join(r.choices(odd, k=30)) for _ in range(3000)] + ["we'll I'm 's 'S it'd've'", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)])), ""]
    texts += [f" {chr(c)}{chr(c)}a '{chr(c)}1" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    beyond = [f" a{chr(c)}b {chr(c)}1'{chr(c)}" for c in (0x10000, 0x1D400, 0x1D7CE, 0x1F600, 0x20000, 0x10FFFF)]
    asked = []

    class Counted:
        def __init__(self, pattern):
            self.findall = lambda text: asked.append(text) or wanted(text)

    bpe.split_words.cache_clear()
    with monkeypatch.context() as m:
        m.setattr(regex, "compile", Counted)
        find = bpe.split_words(public_tokenizers.PATTERN)
    bpe.split_words.cache_clear()
    assert all(find(t) == wanted(t) for t in texts + beyond)
    assert asked == beyond
    for pattern in (r"(?i:a)", r"[\S]", r"\w+", r"[[:alpha:]]", r"(?>a)", r"(?i)a"):
        assert bpe.spelt_out(pattern) is None
