"""The fold against an interpreter that goes through the log row by row."""

import random

import pytest
from pyspark.sql import types as T

from tidefold.operators import fold
from tidefold.operators.envelope import ENVELOPE, Shape, decode
from tidefold.plans import epochs

SHAPE = Shape("s.t", (("k", T.LongType()), ("a", T.StringType()), ("b", T.IntegerType())), ("k",))


def text(row):
    return [None if x is None else str(x) for x in row]


def random_log(seed, patches, base, size=120):
    r = random.Random(seed)
    state = {row[0]: row for row in base}
    log = []
    for i in range(size):
        k = r.randrange(12)
        row = (k, r.choice([None, f"x{i}"]), r.choice([None, i]))
        kind = r.choice("IIUUDM" + ("PPPV" if patches else "") + ("T" if r.random() < 0.1 else "I"))
        if kind == "T":
            log.append(("T", None, None, None))
            state = {}
        elif kind == "D":
            log.append(("D", text((k, None, None)), None, None))
            state.pop(k, None)
        elif kind == "M":
            new = (r.randrange(12), *row[1:])
            log.append(("U", text((k, None, None)), text(new), None))
            state.pop(k, None)
            state[new[0]] = new
        elif kind == "V":
            new = ((k + 1) % 12, None, row[2])
            log.append(("U", text((k, None, None)), text(new), [False, True, False]))
            if k in state:
                state[new[0]] = (new[0], state.pop(k)[1], row[2])
        elif kind == "P":
            held = [False, True, r.random() < 0.5]
            log.append(("U", None, text((k, None, row[2])), held))
            if k in state:
                old = state[k]
                state[k] = (k, old[1], old[2] if held[2] else row[2])
        else:
            log.append((kind, None, text(row), None))
            state[k] = row
    return log, sorted(state.values())


def events(spark, log, start=0):
    return spark.createDataFrame([("s", start + i, 0, i, None, "s.t", op, b, a, u, 0) for i, (op, b, a, u) in enumerate(log)], ENVELOPE)


@pytest.mark.parametrize(("seed", "patches"), [(0, False), (1, False), (2, True), (3, True), (4, True)])
def test_random_logs(spark, seed, patches):
    base = [(k, f"b{k}", k) for k in range(7)]
    log, wanted = random_log(seed, patches, base, 60 if patches else 120)
    frame = spark.createDataFrame(base, "k long, a string, b int")
    step = fold.replay if patches else fold.mirror
    assert sorted(map(tuple, step(frame, decode(events(spark, log), SHAPE), ["k"]).collect())) == wanted


def test_split_into_batches_gives_the_same(spark):
    log, wanted = random_log(5, True, [], 80)
    frame = spark.createDataFrame([], "k long, a string, b int")
    for start in range(0, len(log), 40):
        frame = fold.replay(frame, decode(events(spark, log[start : start + 40], start), SHAPE), ["k"])
        frame = spark.createDataFrame(frame.collect(), "k long, a string, b int")
    assert sorted(map(tuple, frame.collect())) == wanted


def test_without_key_only_grows(spark):
    log = [("I", None, ["1", "a", None], None), ("D", ["1", "a", None], None, None), ("I", None, ["1", "a", None], None)]
    frame = spark.createDataFrame([(9, "z", 1)], "k long, a string, b int")
    got = fold.mirror(frame, decode(events(spark, log), SHAPE), [])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a", None), (1, "a", None), (9, "z", 1)]


def test_segments_and_moves(spark):
    log = [("I", None, ["1", "a", "1"], None), ("I", None, ["2", "a", "1"], None), ("U", None, ["1", None, "2"], [False, True, False]),
           ("T", None, None, None), ("T", None, None, None), ("I", None, ["3", "a", "1"], None)]
    got = epochs.segments(events(spark, log)).orderBy("lsn").select("kind", "segment").collect()
    assert [tuple(r) for r in got] == [("DATA", 1), ("DATA", 1), ("PATCH", 2), ("T", 3), ("T", 4), ("DATA", 5)]
    move = [("U", ["1", None, None], ["2", None, "5"], [False, True, False]), ("U", None, ["2", None, "5"], [False, True, False])]
    changes = decode(events(spark, move), SHAPE)
    assert changes.where(epochs.must_replay(changes, ["k"])).count() == 1


def test_empty_batch(spark):
    frame = spark.createDataFrame([(1, "a", 1)], "k long, a string, b int")
    assert fold.mirror(frame, decode(events(spark, [("I", None, None, None)]).limit(0), SHAPE), ["k"]).count() == 1
