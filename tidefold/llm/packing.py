"""Vector best-fit packing of documents into token sequences.

Each piece of a document demands a vector (tokens, 1 document, tokens**2 attention cost) and
each sequence has a capacity in every component.  All demands follow from the length, so
pieces of one length are alike, and open sequences with one residual vector are alike:
best-fit decreasing is run over *classes* (length -> number of pieces) and *groups* of like
sequences.  That is the same choice piece by piece would make, in steps bounded by the number
of lengths instead of the number of pieces:

* ``norm`` takes the feasible group with the least weighted norm of the residual after
  placing; the sequence just filled stays the best, so it takes copies until one doesn't fit;
* ``dot`` takes the feasible group with the largest weighted dot product of demand and
  residual; a sequence just filled falls behind its like, so each takes one copy in turn.

Only the histogram of lengths (at most ``max_tokens`` rows) reaches the driver.  The plan is a
list of segments (length, first rank, number, first sequence, copies per sequence, offset).
On the cluster each piece gets a gapless rank among those of its length: the rank inside a
chunk of documents plus the counts of the chunks before.  (length, chunk) spreads a length
that holds a third of all pieces over all tasks.

Defined results: a null or empty text is one piece with the end id alone; an empty table gives
an empty result; rows that repeat a doc_id are packed each for itself; a null doc_id is kept;
extra columns are ignored.  A document that exceeds ``max_tokens`` is cut into full pieces, the first one
being shorter if need be.  If even an empty sequence can't hold a piece (attention cost), ValueError.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_texts, materialise, row_chunks
from .tokens import Vocabulary

SEGMENT = ["length", "first_rank", "number", "first_sequence", "copies", "offset"]


def pack_classes(
    counts: dict[int, int],
    max_tokens: int,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    choose: str = "norm",
) -> tuple[list[tuple[int, ...]], int]:
    """Segments and the number of sequences.  Components without a capacity weigh nothing."""
    if choose not in ("norm", "dot"):
        raise ValueError(f"unknown rule {choose}")
    limit = [max_tokens, max_docs, max_cost]
    full = np.array([float("inf") if x is None else float(x) for x in limit])
    scale = np.array([0.0 if x is None else w / x for x, w in zip(limit, weights, strict=True)])
    group = np.zeros((0, 4))  # first sequence, then the residual vector
    size = np.zeros(0, dtype=np.int64)
    segments: list[tuple[int, ...]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1.0, float(length) ** 2])
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero((group[:, 1:] >= need).all(axis=1))
            if len(fits):
                residual = np.where(np.isinf(group[fits, 1:]), 0.0, group[fits, 1:])
                if choose == "norm":
                    at = fits[np.argmin((((residual - need) * scale) ** 2).sum(axis=1))]
                else:
                    at = fits[np.argmax((residual * scale * (need * scale)).sum(axis=1))]
                first, room = int(group[at, 0]), group[at, 1:].copy()
                bins = int(size[at])
            else:
                first, room, bins, at = sequences, full, None, None
            copies = int(min(r // n for r, n in zip(room, need, strict=True) if not np.isinf(r)))
            if copies < 1:
                raise ValueError(f"a piece of {length} tokens exceeds the capacities")
            if choose == "dot" and at is not None:
                copies = 1
            if bins is None:
                bins = -(-left // copies)
                sequences += bins
            take = min(left, bins * copies)
            segments.append((length, rank, take, first, copies, int(max_tokens - room[0])))
            whole, part = divmod(take, copies)
            parts = [(first, whole, room - copies * need), (first + whole, 1 if part else 0, room - part * need)]
            parts.append((first + whole + (1 if part else 0), bins - whole - (1 if part else 0), room))
            if at is not None:
                group, size = np.delete(group, at, axis=0), np.delete(size, at)
            for start, number, rest in parts:
                if number > 0 and rest[0] > 0:
                    group = np.vstack([group, [start, *rest]])
                    size = np.append(size, number)
            left -= take
            rank += take
    return segments, sequences


PIECES = "doc_id long, pieces array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


def cut(ids: np.ndarray, max_tokens: int) -> list[dict]:
    """Pieces of one document: full ones from its end, the first may be shorter."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    first = len(ids) % max_tokens
    marks = [0, *([first] if first else []), *range(first + max_tokens, len(ids) + 1, max_tokens)]
    return [
        {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[a:b].tobytes())}
        for i, (a, b) in enumerate(zip(marks, marks[1:], strict=False))
    ]


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, max_tokens: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its pieces, for every document."""
    end = np.array([end_id], dtype=np.uint32)

    def make(columns, texts):
        encode = vocabulary.encoder().encode_to_numpy
        ids = (np.concatenate([encode(t.decode("utf-8", "replace"), allowed_special="all"), end]) for t in texts)
        return [columns[0], [cut(x, max_tokens) for x in ids]]

    return map_texts(docs, [id_col], text_col, make, PIECES)


def place(segments: list[tuple[int, ...]]):
    """A function of (length, rank) arrays that gives (sequence, offset) arrays, by binary search in the plan."""
    plan = np.array(sorted(segments), dtype=np.int64).reshape(-1, len(SEGMENT))

    def at(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.searchsorted(plan[:, 0], length)
        last = np.searchsorted(plan[:, 0], length, side="right")
        while (wide := last - start > 1).any():
            mid = (start + last) // 2
            right = wide & (plan[np.minimum(mid, len(plan) - 1), 1] <= rank)
            start, last = np.where(right, mid, start), np.where(wide & ~right, mid, last)
        p = plan[start]
        i = rank - p[:, 1]
        return p[:, 3] + i // p[:, 4], p[:, 5] + i % p[:, 4] * length

    return at


def pack(
    docs: DataFrame,
    vocabulary: Vocabulary,
    max_tokens: int = 2048,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    choose: str = "norm",
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    chunks = row_chunks(spark, docs)
    pieces = token_pieces(docs, vocabulary, max_tokens, end_id, id_col, text_col)
    chunk = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)).cast("int")
    pieces = materialise(pieces.select("doc_id", F.inline("pieces")).withColumn("chunk", chunk), "pieces")

    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments, _ = pack_classes(lengths, max_tokens, max_docs, max_cost, weights, choose)
    find = place(segments)

    # counted from the stored pieces, not stored itself: a file for each of its tasks costs more than the count
    counts = pieces.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))
    own = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own).cast("long") - 1).join(before, ["length", "chunk"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sequence, offset = find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            columns = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
