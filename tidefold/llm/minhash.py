"""Near-duplicate groups by min-max hashing.

1. A text's set of word shingles becomes 64-bit hashes.  Each of ``permutations`` hash
   functions is evaluated once per shingle and yields two signature values, the minimum and
   the maximum, so 128 values cost 64 evaluations.  Bands of ``rows_per_band`` values are
   hashed.  If minimum and maximum agreed independently, two sets of similarity 0.75 would share
   none of the 32 bands with a probability of 5e-6; in small sets they don't (3 of 4 shingles:
   measured 1e-4; 18 of 24: 1.1e-5).  So pairs of which the smaller has under ``exact_below`` shingles
   are found exactly besides, by a prefix filter: each such set also goes to the buckets of its rarest shingles,
   as many as two sets of enough similarity can't miss each other in.
2. Equal sets collapse first (any number of copies is one class, combined in the map tasks).
3. In each bucket the class with the least id stands at the centre: every other class of the bucket is
   compared with it on the full sets, and components are formed from the links found.
4. In buckets whose classes are still in several components, every member outside the bucket's largest component (the *others*) is compared
   with all members, on the full sets, so no pair that shares a bucket is left undecided; pairs within the largest component aren't compared.
   Others and members are cut into blocks of ``block`` and a task compares one of each, so a member's set is sent once for each block of others:
   once at all, as long as the others fill one block, however many copies the bucket has.  Where the others fill more, the members, which
   may be no more than alike, first meet anew on their rarest shingles (the prefix filter of 1, over all their sets): whoever has the
   similarity shares one.  Only links that join components leave a task, at most one less than its members, and no pairs are materialised.
5. Texts of one doc_id are linked as well.

The sets of 3 and 4 are made again from the texts of classes that share a bucket; all other texts are
read once.

Defined results: a text without words has an empty set and is linked with nothing; with fewer
than ``shingle`` words its whole sequence is the only shingle; rows that repeat a doc_id are
one document that has the links of all its texts; a null doc_id takes no part (component null,
kept); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, map_texts, materialise, whole_text
from .components import components
from .shingles import mix, shingle_set


def multipliers(permutations: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation."""
    out = np.empty((len(factors), 2), np.uint64)
    for i, a in enumerate(factors):
        permuted = shingles * a
        out[i, 0], out[i, 1] = permuted.min(), permuted.max()
    return out.reshape(-1)


def band_keys(values: np.ndarray, rows_per_band: int) -> np.ndarray:
    bands = values.reshape(-1, rows_per_band)
    key = mix(np.arange(len(bands), dtype=np.uint64))
    for column in bands.T:
        key = mix(key * np.uint64(31) + column)
    return key.view(np.int64)


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space: exactly the characters 09-0D and 20."""
    return text.lower().split()


SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>, small array<long>"


def sketches(docs: DataFrame, shingle: int, permutations: int, rows_per_band: int, small_size: int, id_col: str, text_col: str) -> DataFrame:
    """Signatures, and the whole set where it has at most ``small_size`` shingles."""
    factors = multipliers(permutations)

    def make(columns, texts):
        import xxhash

        n, keys, bands, small = [], [], [], []
        for t in texts:
            s = shingle_set(words_of(t), shingle)
            n.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            bands.append(band_keys(signature(s, factors), rows_per_band) if len(s) else None)
            small.append(s.view(np.int64) if 0 < len(s) <= small_size else None)
        return [columns[0], n, keys, bands, small]

    return map_texts(docs, [id_col], text_col, make, SKETCH)


#: Counters that all shingles share by their hash when a common order of them is made; 8 bytes each in a task.
COUNTERS = 1 << 20


def slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64)


def list_slices(batches):
    """node, sizes and flat values of at most ``SLICE`` sets (node, own) at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            part = whole.slice(at, SLICE)
            own = part.column("own")
            yield part.column("node").to_numpy(), own.value_lengths().to_numpy(), own.flatten().to_numpy()


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each counter occur, over all sets.  Each task sends its counters once, so a shingle that
    many sets have is added up where they are; the driver gets ``COUNTERS`` numbers, whatever the sets."""

    def count(batches):
        import pyarrow as pa

        seen = np.zeros(COUNTERS, np.int64)
        for _, _, values in list_slices(batches):
            at, n = np.unique(slots(values), return_counts=True)
            seen[at] += n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at])], names=["slot", "n"])

    table = sets.select("node", "own").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return counts


def rare_keys(sets: DataFrame, percent: int) -> DataFrame:
    """node, key: the rarest shingles of each set (node, own).

    Two sets that share ``percent`` of their union share that much of the larger, so in any common order of all
    shingles the first one shared comes before the last ``percent`` of either set have begun.  The order here is by counters that
    shingles share by their hash, then by the shingle: no set is taken apart, only the keys chosen become rows.  Counters that
    collide make a bucket larger, never miss a pair.
    """
    shared = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))

    def rarest(batches):
        import pyarrow as pa

        for node, sizes, values in list_slices(batches):
            member = np.repeat(np.arange(len(node)), sizes)
            order = np.lexsort((values, shared.value[slots(values)], member))
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = order[place < np.repeat(sizes - (percent * sizes.astype(np.int64) + 99) // 100 + 1, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(node[member[kept]]), pa.array(values[kept])], names=["node", "key"])

    return sets.select("node", "own").mapInArrow(rarest, "node long, key long")


def full_sets(docs: DataFrame, nodes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """node, own: the full shingle set of each document in ``nodes``."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text")).join(nodes, F.col("id") == F.col("node"))
    make = lambda columns, texts: [columns[0], [shingle_set(words_of(t), shingle).view(np.int64) for t in texts]]
    return map_texts(picked, ["id"], "text", make, "node long, own array<long>")


def joining_links(node: np.ndarray, component: np.ndarray, asking: np.ndarray, asked: np.ndarray, values: np.ndarray, ends: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of the members ``asking`` to the members ``asked`` that are in another component, as many as join components.

    ``values[ends[i-1]:ends[i]]`` is the set of member i.  Who asks meets all others through posting lists.
    """
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    owner = np.repeat(np.arange(len(node)), sizes)
    order = np.argsort(values, kind="stable")
    ranked, posted = values[order], owner[order]
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    for i in np.flatnonzero(asking):
        own = values[starts[i] : ends[i]]
        f = np.searchsorted(ranked, own)
        n = np.searchsorted(ranked, own, side="right") - f
        at = np.repeat(f - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(posted[at], minlength=len(node))
        near = 100 * shared >= percent * (sizes + sizes[i] - shared)
        for j in np.flatnonzero(near & asked & (component != component[i])):
            a, b = root(int(component[i])), root(int(component[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(node[i]), int(node[j])))
    return links


def mixed_buckets(state: DataFrame) -> DataFrame:
    """key, main (the largest component), n (members), others (members outside it) of the buckets (key, node, component) that hold several components."""
    parts = state.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    found = parts.groupBy("key").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("n"))
    return found.select("key", F.col("top.component").alias("main"), "n", (F.col("n") - F.col("top.size")).alias("others")).where("others > 0")


def tiles(state: DataFrame, mixed: DataFrame, block: int) -> DataFrame:
    """key, i, j, node, component, asking, asked: block i of a bucket's others meets block j of its members."""
    blocks = lambda column: F.ceil(F.col(column) / block).cast("int")
    other = F.col("component") != F.col("main")
    members = (
        state.join(mixed, "key")
        .withColumn("mine", F.pmod(F.xxhash64("node"), blocks("n")).cast("int"))
        .withColumn("turn", F.when(other, F.pmod(F.xxhash64("node"), blocks("others")).cast("int")))
    )
    asked = members.withColumn("i", F.explode(F.sequence(F.lit(0), blocks("others") - 1)))
    asked = asked.select("key", "i", F.col("mine").alias("j"), "node", "component", F.coalesce(F.col("i") == F.col("turn"), F.lit(False)).alias("asking"), F.lit(True).alias("asked"))
    asking = members.where(other & (F.col("n") > block)).withColumn("j", F.explode(F.sequence(F.lit(0), blocks("n") - 1))).where("j <> mine")
    return asked.union(asking.select("key", F.col("turn").alias("i"), "j", "node", "component", F.lit(True).alias("asking"), F.lit(False).alias("asked")))


def id_links(known: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links between the classes of one doc_id, for ids that come with several texts."""
    several = known.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo < hi").select("doc_id")
    own = known.join(several, "doc_id").join(classes.select("set_key", "node"), "set_key").select("doc_id", "node")
    least = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return own.join(least, "doc_id").where("a < node").select("a", F.col("node").alias("b")).distinct()


def near_groups(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 75,
    permutations: int = 64,
    rows_per_band: int = 4,
    block: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    exact_below: int = 16,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    small_size = (exact_below - 1) * 100 // max(percent, 1)  # of the larger set of a pair
    known = materialise(sketches(docs, shingle, permutations, rows_per_band, small_size, id_col, text_col), "sketches")
    apart = F.col("set_key").isNull() | F.col("doc_id").isNull()
    classes = known.where(~apart).groupBy("set_key").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.any_value("small").alias("small"))
    classes = materialise(classes, "classes")

    rare = materialise(rare_keys(classes.where("small is not null").select("node", F.col("small").alias("own")), percent), "rare-keys", few=True)
    rows = classes.select("node", F.explode("bands").alias("key")).union(rare)
    shared = rows.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other"))
    hits = materialise(rows.join(shared.where("centre < other"), "key").select("key", "node", "centre"), "buckets", few=True)
    sets = materialise(full_sets(docs, hits.select("node").distinct(), shingle, id_col, text_col), "full-sets")

    pairs = hits.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    left, right = sets.select(F.col("node").alias("a"), F.col("own").alias("x")), sets.select(F.col("node").alias("b"), F.col("own").alias("y"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("both"))
    linked = materialise(met.where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))).select("a", "b"), "star-links", few=True)
    linked = linked.union(id_links(known.where(~apart), classes))
    found = components(linked)

    # buckets in which components still meet
    state = hits.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    state = materialise(state, "bucket-state", few=True)
    mixed = materialise(mixed_buckets(state), "mixed-buckets", few=True)
    meet = tiles(state, mixed.where(F.col("others") <= block), block)
    crowd = state.join(mixed.where(F.col("others") > block).select("key"), "key").select("node", "component").distinct()
    crowd = materialise(crowd, "crowded", few=True)
    if not crowd.isEmpty():
        members = materialise(sets.join(crowd.select("node"), "node", "left_semi"), "crowded-sets")
        again = rare_keys(members, percent).join(crowd, "node")
        again = materialise(again.select("key", "node", "component"), "crowded-keys", few=True)
        meet = meet.union(tiles(again, mixed_buckets(again), block))

    def compare(table):
        import pyarrow as pa

        own = table.column("own").combine_chunks()
        node, component, asking, asked = (table.column(c).to_numpy() for c in ("node", "component", "asking", "asked"))
        links = joining_links(node, component, asking, asked, own.flatten().to_numpy(), np.cumsum(own.value_lengths().to_numpy()), percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    more = meet.join(sets, "node").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")
    more = materialise(more, "bucket-links", few=True)
    if not more.isEmpty():
        found = components(linked.union(more))

    reach = classes.select("set_key", "node").join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    grouped = known.where(~apart).select("doc_id", "n_shingles", "set_key").join(reach, "set_key").select("doc_id", "n_shingles", "component_id")
    # a row without words shares the component that other rows of its id have
    others = grouped.join(known.where(apart).select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("other"))
    alone = known.where(apart).join(others, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("other", "doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
