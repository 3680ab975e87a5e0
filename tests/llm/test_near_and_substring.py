import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tidefold.llm.components import components
from tidefold.llm.minhash import band_keys, joining_links, mixed_buckets, multipliers, near_groups, rare_keys, signature, tiles
from tidefold.llm.shingles import run_hashes, shingle_set
from tidefold.llm.substring_dedup import cut_spans, seeds, spans, substring_dedup
from tidefold.llm.topk import threshold_search, top_k


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def near_by_force(source, percent=75):
    sets = defaultdict(set)
    for i, t in source:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets[i] |= own
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = [i for i in sets if i is not None and sets[i]]
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i) if i is not None else None) for i in sets}


@pytest.mark.parametrize("block", [512, 2])
def test_near_groups(docs, block):
    wanted = near_by_force(rows(docs, "doc_id", "text"))
    got = rows(near_groups(docs, block=block), "doc_id", "n_shingles", "component_id", "kept")
    assert len(got) == docs.count()
    for i, n, c, kept in got:
        assert (n, c) == (wanted[i] if i is not None else (1, None)) and kept == (i == c)
    assert any(c != i for i, _, c, _ in got)


def test_texts_of_one_id_are_linked(spark):
    """Rows that repeat an id are one document with the links of all its texts, also a row without words."""
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    source = [(3, a), (5, a), (5, b), (7, b), (7, ""), (9, ""), (9, None), (None, a)]
    got = rows(near_groups(spark.createDataFrame(source, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(got, key=str) == sorted([(3, 26, 3, True), (5, 26, 3, False), (5, 26, 3, False), (7, 26, 3, False), (7, 0, 3, False), (9, 0, 9, True), (9, 0, 9, True), (None, 26, None, True)], key=str)


def test_crowded_buckets_meet_on_rare_shingles(spark, monkeypatch):
    """Pages of a template share half their shingles and a band by chance; with blocks of three no bucket fits one task."""
    from tidefold.llm import minhash

    r = random.Random(2)
    frame = " ".join(f"t{i}" for i in range(40))
    source = []
    for i in range(40):
        own = " ".join(f"p{i // 4}x{k}" for k in range(12)) if i % 4 < 3 else " ".join(f"q{r.random()}" for _ in range(12))
        source.append((i, f"{frame} {own} {'end' if i % 2 else 'fin'}"))
    monkeypatch.setattr(minhash, "band_keys", lambda values, n: minhash.mix(values[:1] % 1).view("int64"))
    df = spark.createDataFrame(source, "doc_id long, text string")
    wanted = near_by_force(source, 90)
    got = {i: c for i, c in rows(near_groups(df, percent=90, block=3), "doc_id", "component_id")}
    assert got == {i: c for i, (_, c) in wanted.items()} and len(set(got.values())) > 10


def test_near_chain_whose_ends_are_far(spark):
    """Neighbours are linked, the ends aren't; the least id is at one end, so stars alone would miss links."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(8):
        texts.append(" ".join(words))
        at = r.randrange(340)
        words[at : at + 30] = [f"n{r.random()}" for _ in range(30)]
    order = [3, 0, 6, 1, 7, 4, 2, 5]
    source = [(order[i], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(source, "doc_id long, text string")
    wanted = near_by_force(source)
    assert {i: c for i, c in rows(near_groups(df, block=2), "doc_id", "component_id")} == {i: c for i, (_, c) in wanted.items()}


def test_small_sets_without_a_common_band(spark):
    """3 of 4 shingles are shared, but no band is."""
    texts = [w[: len(w) - cut] for w in ("w39 w82 w342 w791 w445 w509 w373 w240", "w496 w765 w310 w387 w384 w774 w143 w125") for cut in (0, 5)]
    bands = [set(band_keys(signature(shingle_set(t.encode().split()), multipliers(64)), 4).tolist()) for t in texts]
    assert [len(shingle_set(t.encode().split())) for t in texts] == [4, 3, 4, 3] and not bands[0] & bands[1] and not bands[2] & bands[3]
    r = random.Random(5)
    texts += [" ".join(f"w{r.randrange(3)}" for _ in range(r.randrange(5, 12))) for _ in range(150)]
    source = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(spark.createDataFrame(source, "doc_id long, text string")).collect()}
    assert got == near_by_force(source) and got[1][1] == 0 and got[3][1] == 2


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_rare_keys_miss_no_pair(spark, percent):
    r = random.Random(percent)
    sets = [sorted(r.sample(range(12), r.randrange(1, 9))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sets)), "node long, own array<long>")
    keys = defaultdict(set)
    for node, key in rows(rare_keys(df, percent), "node", "key"):
        keys[node].add(key)
    pairs = [(a, b) for a in range(120) for b in range(a) if 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})]
    assert pairs and all(keys[a] & keys[b] for a, b in pairs)


def test_tiles_find_every_joining_link():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**60, 50)
    sets = [np.unique(np.concatenate([base[: 50 - k], r.integers(0, 2**60, k)])) for k in (0, 3, 5, 30, 31, 2)] + [r.integers(0, 2**60, 9)]
    ids = np.arange(len(sets))
    links = joining_links(ids, ids.copy(), ids >= 0, ids >= 0, np.concatenate(sets), np.cumsum([len(s) for s in sets]), 75)
    touched = {x for link in links for x in link}
    assert touched == {0, 1, 2, 5} and len(links) == 3


@pytest.mark.parametrize("block", [1, 3, 100])
def test_tiles_let_every_pair_of_components_meet_once(spark, block):
    """Pairs within the largest component don't ask; a member goes once to each block of others, and another to each block of members besides."""
    r = random.Random(block)
    label = [0] * 30 + [1] * 5 + [2 + i for i in range(6)] + [0]
    state = [(key, i, label[i]) for key in (1, 2) for i in r.sample(range(42), 42 if key == 1 else 20)] + [(3, 0, 0), (3, 1, 0)]
    df = spark.createDataFrame(state, "key long, node long, component long")
    found = defaultdict(list)
    for key, i, j, node, asking, asked in rows(tiles(df, mixed_buckets(df), block), "key", "i", "j", "node", "asking", "asked"):
        found[key, i, j].append((node, asking, asked))
    met = {(key, a, b) for (key, _, _), members in found.items() for a, asks, _ in members for b, _, asked in members if asks and asked}
    wanted = {(k, a, b) for k, a, c in state for q, b, d in state if k == q and c != 0 and c != d}
    assert wanted <= met and all(label[a] != 0 for _, a, _ in met) and 3 not in {k for k, _, _ in met}
    assert all(len(members) == len({m[0] for m in members}) for members in found.values())
    if block == 100:
        assert sum(map(len, found.values())) == 62


def test_signature_has_both_ends():
    s = shingle_set([b"a", b"b", b"c", b"d", b"e", b"f"], 5)
    f = multipliers(3)
    assert signature(s, f).tolist() == [x for a in f for x in ((s * a).min(), (s * a).max())]


def test_runs_depend_on_their_words_alone():
    h = np.arange(100, dtype=np.uint64)
    a, b = run_hashes(h, 50), run_hashes(h[13:80], 50)
    assert (a[13:31] == b).all() and len(set(a.tolist())) == 51
    assert len(run_hashes(h, 101)) == 0 and (run_hashes(h, 1) != run_hashes(h, 2)[:1]).all()


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    got = dict(rows(components(spark.createDataFrame(pairs, "a long, b long")), "node", "component"))
    assert set(got) == {*range(1, 41), *range(100, 120)} and {got[i] for i in range(1, 41)} == {1} and got[119] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups_of_nothing(nothing):
    assert near_groups(nothing).count() == 0


def repeats_by_force(source, length):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in source]
    least = {}
    for i, w in words:
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    found = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and least[tuple(w[s : s + length])] < i:
                gone |= set(range(s, s + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        found.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


@pytest.mark.parametrize(("length", "seed"), [(50, 16), (8, 3)])
def test_substring_dedup(docs, length, seed):
    wanted = repeats_by_force(rows(docs, "doc_id", "text"), length)
    got = rows(substring_dedup(docs, length=length, seed=seed), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert sum(n for _, _, n, _ in got) > 0


@pytest.mark.parametrize(("bits", "hot"), [(64, 5000), (64, 2), (2, 5000), (2, 40), (0, 5000)])
def test_substring_dedup_random(spark, bits, hot):
    """Texts pasted together from few blocks, so matches begin and end everywhere; also where the anchors' hash hardly tells them apart."""
    r = random.Random(9)
    blocks = [" ".join(r.choice("abcd") for _ in range(r.randrange(3, 25))) for _ in range(12)]
    source = [(i, " ".join(r.choice(blocks) for _ in range(r.randrange(1, 9)))) for i in range(60)]
    df = spark.createDataFrame(source, "doc_id long, text string")
    got = rows(substring_dedup(df, length=12, seed=4, hash_bits=bits, hot_contexts=hot), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(got) == sorted(repeats_by_force(source, 12))


def test_substring_dedup_of_words_that_go_on_and_on(spark):
    """One word or a short cycle repeated: all windows have one anchor hash, and a run is longer than a window."""
    source = [(3, "to " * 120), (1, "x " + "to " * 90 + "y"), (2, "a b " * 60), (7, "c " + "a b " * 55 + "d"), (5, "to " * 49), (9, "b a " * 40), (4, "a b c " * 40)]
    df = spark.createDataFrame(source, "doc_id long, text string")
    got = rows(substring_dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(got) == sorted(repeats_by_force(source, 50)) and sum(n for _, _, n, _ in got) > 200


def test_spans_and_cuts():
    assert spans(5, [0, 20], [2, 1], [3, 40]) == [(0, 8), (20, 25), (40, 45)]
    assert cut_spans(b"a  b\tc d\ne", [(1, 3)]) == (b"a d e", b"a\nd\ne")
    assert cut_spans(b"a b", [(0, 2)]) == (b"", b"")
    assert all(len(x) == 0 for x in seeds([b"a"] * 9, 10, 3))


def test_substring_dedup_of_nothing(nothing):
    assert substring_dedup(nothing).count() == 0


def test_threshold_search_ties_and_small_tables():
    r = np.random.default_rng(0)
    c, q = r.integers(-3, 4, (300, 5)), r.integers(-3, 4, (20, 5))
    q[0] = 0
    ids = r.permutation(300)
    own = ids[:20]
    for k in (1, 7, 400):
        for i, (at, score) in enumerate(threshold_search(q, c, own, ids, k)):
            wanted = sorted((-int(q[i] @ c[j]), int(ids[j])) for j in range(300) if ids[j] != own[i])[:k]
            assert sorted((-int(s), int(ids[j])) for j, s in zip(at, score, strict=True)) == wanted


def test_threshold_search_scores_only_what_it_meets(monkeypatch):
    """Long lists with a few large values: the threshold falls below the kth score long before the lists end."""
    from tidefold.llm import topk

    r = np.random.default_rng(2)
    c = r.integers(-2, 3, (4000, 4))
    c[:60] *= 40
    q, ids, own = r.integers(1, 4, (30, 4)) * r.choice([-1, 1], (30, 4)), np.arange(4000), np.arange(30) + 3900
    scored, real = [], topk.random_access
    monkeypatch.setattr(topk, "random_access", lambda *given: scored.append((len(given[0]), given[3])) or real(*given))
    found = threshold_search(q, c, own, ids, 5)
    met = np.concatenate([x for _, x in scored])
    assert len(met) == len(set(met.tolist())) and sum(n * len(x) for n, x in scored) < 0.7 * 30 * 4000
    for i, (_, score) in enumerate(found):
        assert sorted(score) == sorted(np.delete(c @ q[i], own[i]))[-5:]


def test_top_k(spark):
    r = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in r.normal(size=6)], i) for i in range(90)]
    vectors += [(100, None, 0), (120, [1.0, None], 0), (140, [float("nan")] * 6, 0), (160, [float("inf")] * 6, 0), (180, [], 0), (None, [1.0] * 6, 0), (7, [0.5] * 6, 0), (200, [0.25] * 3, 0), (220, [1.0, 2.0, -1.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score int")
    got = rows(top_k(df, df["vec_id"] % 20 == 0, k=5, candidate_block=16, query_block=3), "query_id", "rank", "vec_id", "score")
    good = [(i, np.floor(64 * np.float32(v).astype(float)).astype(int)) for i, v, _ in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    wanted = []
    for i, v in good:
        if i % 20 == 0:
            near = sorted((-int(v @ w), j) for j, w in good if j != i and len(w) == len(v))[:5]
            wanted += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    assert sorted(got) == sorted(wanted)
    assert top_k(df.limit(0), df["vec_id"] % 20 == 0).count() == 0


def test_scratch_tables_have_few_files(spark):
    """No checksum files or marks, for each of which a process would start, and narrow rows in few files."""
    import os

    from tidefold.llm.common import materialise

    rows = spark.range(0, 2000, 1, 40).selectExpr("id as node", "id % 7 as component")
    for few, most in ((False, 40), (True, 4)):
        found = materialise(rows, "few", few)
        folder = found.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert len(os.listdir(folder)) <= most and all(f.startswith("part-") for f in os.listdir(folder))
        assert not found.exceptAll(rows).take(1) and found.count() == 2000
