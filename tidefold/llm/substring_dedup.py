"""Substring dedup: seed and extend on winnowed anchors.

A repeat is a run of at least ``length`` words that stands in two documents; the one with the
smaller doc_id keeps it.

Seeds.  The hash of each run of ``seed`` words competes with its neighbours: in every window
of ``length`` words the least hash is the window's anchor.  Equal windows have
equal anchors, so documents that share ``length`` words share an anchor
(winnowing), while only about ``2 / (length - seed + 2)`` of the positions are kept.  Consecutive windows whose
anchors have one hash are one *seed*, also where a word repeats on and on: (anchor hash, digest of the context), where the context is all that its
windows cover, on both sides of the anchor, and the digest has 128 bits.

Join and extend.  Seeds meet on the anchor hash.  Most anchors occur in one document and
leave.  Where a document with a smaller id has the same anchor in the same context, the match
extends over the whole context, and all windows of the seed repeat.  Where contexts of an
anchor differ, one document for each distinct context (the smallest id) sends its words, and matches are extended from the anchor to the left and to the
right, word by word: two trees for each anchor, in which contexts part at the first word that differs, so words are compared
themselves and each context is gone through once, whatever the number of the others.  A window repeats if a smaller document has been at its two
ends.  So a passage that a third of all documents share costs a row per map task and context, and no pairs are formed.
An anchor with more than ``hot_contexts`` contexts isn't given to one task: its windows meet by 128-bit digests, with map-side minima.

Merge.  Windows that repeat are united to maximal spans, which are the repeats.

Defined results: a null or empty text has no words; texts shorter than ``length`` words lose
nothing; repeats inside one document, or between rows with one doc_id, stay; rows that share
doc_id and text share their result; a null doc_id neither loses words nor makes others lose any; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialise, whole_text
from .shingles import run_hashes, word_hashes

#: What becomes of a seed: all its windows repeat, its words are compared, its windows meet by digests.
WHOLE, PART, HOT = 0, 1, 2
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def anchors_of(words: list[bytes], seed: int, bits: int) -> np.ndarray:
    """The hash of each run of ``seed`` words, its last ``bits`` bits."""
    return run_hashes(word_hashes(words), seed) & np.uint64((1 << bits) - 1)


def seeds(words: list[bytes], length: int, seed: int, bits: int = 64) -> tuple:
    """(anchor hash, context digest, first window, number of windows) of each seed of a text."""
    import xxhash

    if len(words) < length:
        none = np.zeros(0, np.int64)
        return none, [], none.astype(np.int32), none.astype(np.int32)
    grams = anchors_of(words, seed, bits)
    low = np.lib.stride_tricks.sliding_window_view(grams, length - seed + 1).min(axis=1)
    first = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    number = np.diff(np.concatenate([first, [len(low)]]))
    contexts = [xxhash.xxh3_128_digest(b" ".join(words[a : a + n + length - 1])) for a, n in zip(first.tolist(), number.tolist(), strict=True)]
    return low[first].view(np.int64), contexts, first.astype(np.int32), number.astype(np.int32)


class Matches:
    """The contexts of one anchor hash, in the order of their documents: where they agree with earlier ones."""

    def __init__(self, length: int, seed: int):
        self.length, self.seed = length, seed
        self.left: dict[tuple, int] = {}
        self.right: dict[tuple, int] = {}
        self.ends: dict[tuple[int, int], int] = {}

    def add(self, doc: int, words: list[bytes], at: list[int], number: int) -> list[int]:
        """Windows (of ``number``) that a smaller document has too.  ``at``: where the anchor stands; a window belongs to its first."""
        found, before, room = [], -1, self.length - self.seed
        left, right, ends = self.left, self.right, self.ends
        for a in at:
            first, last = max(before + 1, a - room, 0), min(a, number - 1)
            before = a
            if first > last:
                continue
            root = left.setdefault((0, b" ".join(words[a : a + self.seed])), len(left) + 1)
            back, ahead = [root], [root]
            for w in reversed(words[first:a]):  # to the left, as far as the first window begins
                root = left.setdefault((root, w), len(left) + 1)
                back.append(root)
            node = ahead[0]
            for w in words[a + self.seed : last + self.length]:  # to the right, to the end of the last
                node = right.setdefault((node, w), -len(right) - 1)
                ahead.append(node)
            for t in range(first, last + 1):
                if ends.setdefault((back[a - t], ahead[room - a + t]), doc) < doc:
                    found.append(t)
        return found


def spans(length: int, first: list[int], number: list[int], starts: list[int]) -> list[tuple[int, int]]:
    """Maximal spans [start, end) of words that the repeated windows cover."""
    runs = sorted([(a, a + n - 1 + length) for a, n in zip(first, number, strict=True)] + [(s, s + length) for s in starts])
    merged: list[list[int]] = []
    for a, b in runs:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def cut_spans(text: bytes, found: list[tuple[int, int]]) -> tuple[bytes, bytes]:
    """The kept words joined by one space, and the text without the spans but with its own white space."""
    marks = [m.span() for m in WORD.finditer(text)]
    kept, parts, at = [], [], 0
    for a, b in [*found, (len(marks), len(marks))]:
        if a > at:
            kept += [text[x:y] for x, y in marks[at:a]]
            parts.append(text[marks[at][0] : marks[a - 1][1]])
        at = b
    return b" ".join(kept), b"\n".join(parts)


P1 = "doc_id long, row long, n_words long, sha string, hs array<long>, cs array<binary>, ss array<int>, ns array<int>"


def substring_dedup(docs: DataFrame, length: int = 50, seed: int = 16, id_col: str = "doc_id", text_col: str = "text", hot_contexts: int = 500, hash_bits: int = 64) -> DataFrame:
    """doc_id, row, n_words, n_removed, spans (array<struct<start,end>> of word positions),
    kept_sha256 (kept words joined by one space) and new_text (null where nothing is removed),
    one row for each row of ``docs``; ``row`` is the xxhash64 of the text.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    texts = texts.withColumn("row", F.xxhash64("text"))

    def first_pass(columns, batch):
        out = [[] for _ in range(6)]
        for t in batch:
            words = t.split()
            for column, value in zip(out, (len(words), hashlib.sha256(b" ".join(words)).hexdigest(), *seeds(words, length, seed, hash_bits)), strict=True):
                column.append(value)
        return [*columns, *out]

    known = materialise(map_texts(texts, ["doc_id", "row"], "text", first_pass, P1), "seeds")
    zipped = F.explode(F.arrays_zip("hs", "cs", "ss", "ns")).alias("z")
    occurs = known.where("doc_id is not null").select("doc_id", "row", zipped).select(
        "doc_id", "row", F.col("z.hs").alias("h"), F.col("z.cs").alias("c"), F.col("z.ss").alias("s"), F.col("z.ns").alias("n")
    )
    contexts = occurs.groupBy("h", "c").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    anchors = contexts.groupBy("h").agg(F.min("lo").alias("h_lo"), F.max("hi").alias("h_hi"), F.count(F.lit(1)).alias("n_contexts"))
    anchors = anchors.where("h_lo < h_hi").select("h", "n_contexts")
    met = materialise(contexts.join(anchors, "h").where("n_contexts > 1 or lo < hi").select("h", "c", "lo", "n_contexts"), "anchors")

    whole = F.col("lo") < F.col("doc_id")
    part = (F.col("lo") == F.col("doc_id")) & (F.col("n_contexts") > 1)
    how = F.when(whole, WHOLE).when(F.col("n_contexts") > hot_contexts, HOT).otherwise(PART)
    own = occurs.join(met, ["h", "c"]).where(whole | part).select("doc_id", "row", "h", "s", "n", how.alias("how"))
    own = own.groupBy("doc_id", "row").agg(F.collect_list(F.struct("h", "s", "n", "how")).alias("seeds"))
    touched = materialise(texts.join(own, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]), "touched")

    of = lambda kind, field: F.transform(F.filter("seeds", lambda x: x["how"] == kind), lambda x: x[field])
    split = touched.select("doc_id", "row", "text", *[of(k, f).alias(f"{f}{k}") for k in (PART, HOT) for f in "hsn"]).where(f"size(s{PART}) + size(s{HOT}) > 0")

    def second_pass(columns, batch):
        import xxhash

        parts, hot = [], []
        for t, hs, ss, ns, _, hot_s, hot_n in zip(batch, *columns[2:], strict=True):
            words = t.split()
            grams = anchors_of(words, seed, hash_bits).view(np.int64) if hs else None
            at = [np.flatnonzero(grams[s : s + n + length - seed] == h) for h, s, n in zip(hs, ss, ns, strict=True)]
            parts.append([{"h": h, "s": s, "n": n, "at": a, "words": b" ".join(words[s : s + n + length - 1])} for h, s, n, a in zip(hs, ss, ns, at, strict=True)])
            hot.append([{"s": a, "d": xxhash.xxh3_128_digest(b" ".join(words[a : a + length]))} for s, n in zip(hot_s, hot_n, strict=True) for a in range(s, s + n)])
        return [columns[0], columns[1], parts, hot]

    schema = "doc_id long, row long, parts array<struct<h:long,s:int,n:int,at:array<int>,words:binary>>, hot array<struct<s:int,d:binary>>"
    sent = map_texts(split, ["doc_id", "row", *[f"{f}{k}" for k in (PART, HOT) for f in "hsn"]], "text", second_pass, schema)
    sent = materialise(sent, "contexts")
    in_order = sent.select("doc_id", "row", F.explode("parts").alias("p")).select("doc_id", "row", "p.*").repartition("h").sortWithinPartitions("h", "doc_id")

    def extend(batches):
        import pyarrow as pa

        anchor, matches = None, None
        for b in batches:
            out = []
            for doc, row, h, s, n, at, words in zip(*(b.column(c).to_pylist() for c in ("doc_id", "row", "h", "s", "n", "at", "words")), strict=True):
                if matches is None or h != anchor:
                    anchor, matches = h, Matches(length, seed)
                found = matches.add(doc, words.split(b" "), at, n)
                if found:
                    out.append((doc, row, [s + t for t in found]))
            docs_, rows_, starts = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(rows_, pa.int64()), pa.array(starts, pa.list_(pa.int32()))], ["doc_id", "row", "starts"])

    met_words = in_order.mapInArrow(extend, "doc_id long, row long, starts array<int>")
    flat = sent.select("doc_id", "row", F.explode("hot").alias("x")).select("doc_id", "row", "x.s", "x.d")
    origin = flat.groupBy("d").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("d", "lo")
    met_hot = flat.join(origin, "d").where(F.col("lo") < F.col("doc_id")).select("doc_id", "row", F.array("s").alias("starts"))
    repeats = met_words.union(met_hot).groupBy("doc_id", "row").agg(F.flatten(F.collect_list("starts")).alias("again"))

    final = touched.join(repeats, ["doc_id", "row"], "left").select("doc_id", "row", "text", of(WHOLE, "s").alias("s"), of(WHOLE, "n").alias("n"), "again")

    def last_pass(columns, batch):
        out = [[] for _ in range(4)]
        for t, s, n, again in zip(batch, *columns[2:], strict=True):
            found = spans(length, s, n, again or [])
            kept, new = cut_spans(t, found)
            removed = sum(b - a for a, b in found)
            for column, value in zip(out, (removed, [{"start": a, "end": b} for a, b in found], hashlib.sha256(kept).hexdigest(), new.decode("utf-8", "replace") if found else None), strict=True):
                column.append(value)
        return [columns[0], columns[1], *out]

    changed = map_texts(
        final, ["doc_id", "row", "s", "n", "again"], "text", last_pass,
        "id long, r long, n_removed long, spans array<struct<start:int,end:int>>, kept string, new_text string",
    ).where("n_removed > 0")
    same = (F.col("doc_id") == F.col("id")) & (F.col("row") == F.col("r"))
    return known.select("doc_id", "row", "n_words", "sha").join(changed, same, "left").select(
        "doc_id", "row", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "spans", F.coalesce("kept", "sha").alias("kept_sha256"), "new_text"
    )
