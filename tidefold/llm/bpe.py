"""Byte-level BPE: encoding by a fold of ranked merges in Spark's higher-order functions, and decoding.

* A *word* is one match of the split pattern.  ``encode_words`` turns it into an array of
  single bytes and folds: each step finds the pair of neighbours with the least rank (the
  leftmost of equals), joins it, and looks up the two ranks that change.  The rank map is a
  literal of the query, an array of small maps found by CRC-32, so one look-up compares one or two keys.
* The fold is applied to distinct words.  Words are counted over the corpus with map-side
  sums; the ``dictionary_words`` most frequent of them (a histogram of the
  counts gives the least count that so many words reach) are folded first and travel to the workers, a bound that doesn't
  depend on the corpus.
* All other words are folded where they stand, once in each *unit* of a partition: a first pass over the texts replaces words by codes and sends
  along each word that the dictionary lacks and the unit hasn't had yet, the fold runs on those, a second pass, which has the unit's words so far,
  puts the ids together.  A unit ends when it has ``unit_words`` words of its own, so neither pass holds more, however many words the corpus has.
  Both passes and the fold are one stage, and texts are not shuffled.
* A word's merges cost its length squared; words of more than ``fold_bytes`` bytes are encoded by the ``tiktoken`` library itself, whose merges
  of long words don't.
* Decoding maps ids to their byte strings and concatenates them; the digests decode the ids that were put together.

Defined results: a null or empty text has no tokens; repeated rows get equal results; extra
columns are ignored; special tokens don't exist.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from array import array
from functools import lru_cache
from operator import itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE, materialise, shuffle_width, to_arrow, whole_text
from .tokens import Vocabulary

RANK_BITS = 15
#: An entry of the fold's state is rank * 2**PLACE_BITS + first byte; words are shorter than 2**PLACE_BITS bytes.
PLACE_BITS = 9
NO_PAIR = (2**31 - 1) << PLACE_BITS


def bucket_of(key: bytes) -> int:
    """The top bits of Spark's ``hash`` (Murmur3, 32 bits, seed 42) of an ASCII string."""
    mask = 0xFFFFFFFF
    h = 42
    blocks = [int.from_bytes(key[i : i + 4], "little") for i in range(0, len(key) // 4 * 4, 4)]
    for k in [*blocks, *key[len(key) // 4 * 4 :]]:
        k = k * 0xCC9E2D51 & mask
        k = ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask
        h ^= k
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= len(key)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return (h ^ h >> 16) >> (32 - RANK_BITS)


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: array of map<string, int> by hash; byte strings are written in hexadecimal."""
    buckets: list[dict[str, int]] = [{} for _ in range(1 << RANK_BITS)]
    for word, rank in ranks.items():
        key = word.hex().upper()
        buckets[bucket_of(key.encode())][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def encode_words(words: Column, ranks: Column) -> Column:
    """Token ids (array<array<int>>) of binary words, each without regard to its neighbours."""
    return let(ranks, lambda r: F.transform(words, lambda w: encode_word(w, r)))


def encode_word(word: Column, ranks: Column) -> Column:
    """Token ids of one binary word.

    The state of the fold has an entry for each part of the word and one for its end: the
    rank of the part with the one behind it, and where the part begins.  The least entry
    is the next merge, the leftmost among equal ranks.  A merge removes the entry behind it and
    renews two.
    """
    n, digits = F.octet_length(word), F.hex(word)

    def rank(first: Column, end: Column) -> Column:
        part = F.substring(digits, 2 * first + 1, 2 * (end - first))
        return let(part, lambda key: F.try_element_at(F.get(ranks, F.shiftrightunsigned(F.hash(key), 32 - RANK_BITS)), key))

    def place(entry: Column) -> Column:
        return entry.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")

    def entry(first: Column, found: Column) -> Column:
        return F.coalesce(found.cast("long") * (1 << PLACE_BITS), F.lit(NO_PAIR).cast("long")) + first

    def merged(state: Column, least: Column, p: Column) -> Column:
        at = lambda i: place(F.get(state, i))  # noqa: E731  null beyond the end, which has no rank
        left = entry(at(p - 2), rank(at(p - 2), at(p + 1)))
        own = entry(place(least), rank(place(least), at(p + 2)))
        rest = F.array_remove(state, F.get(state, p))
        return F.transform(rest, lambda x, i: F.when(x == least, own).when(i == p - 2, left).otherwise(x))

    def step(state: Column, _: Column) -> Column:
        merge = lambda least: let(F.array_position(state, least).cast("int"), lambda p: merged(state, least, p))
        return let(F.array_min(state), lambda least: F.when(least < NO_PAIR, merge(least)).otherwise(state))

    start = F.transform(F.sequence(F.lit(0), n), lambda i: entry(i, F.when(i < n - 1, rank(i, i + 2))))
    last = lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), lambda x, i: rank(place(x), place(F.get(s, i + 1))))
    folded = F.aggregate(F.sequence(F.lit(1), n - 1), start, step, last)
    whole = rank(F.lit(0), n)
    return F.when(n == 0, F.array().cast("array<int>")).when(whole.isNotNull() | (n == 1), F.array(whole)).otherwise(folded)


@lru_cache(maxsize=2)
def split_words(pattern: str):
    """A function that gives all matches in a text.  Python's own engine takes less than half of the time of ``regex``, which
    keeps the patterns that aren't spelt out and the texts with characters beyond U+FFFF."""
    import regex

    whole, spelt = regex.compile(pattern).findall, spelt_out(pattern)
    if spelt is None:
        return whole
    plain, beyond = re.compile(spelt).findall, re.compile("[\U00010000-\U0010FFFF]").search
    return lambda text: plain(text) if text.isascii() or not beyond(text) else whole(text)


def spelt_out(pattern: str) -> str | None:
    """The pattern for ``re``, its classes as the characters up to U+FFFF that ``regex`` puts there; None if it has more than that is done for."""
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|\(\?.|.", pattern, re.DOTALL):
        if part == "[" and inside or part[0] == "(" and part not in ("(", "(?:", "(?!", "(?="):
            return None
        if part in ("[", "]"):
            inside = part == "["
        if part[0] != "\\":
            out.append(part)
        elif part == r"\s" or part.startswith(r"\p"):
            out.append(members(part) if inside else f"[{members(part)}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{members(chr(92) + 's')}]")
        else:
            return None
    return "".join(out)


def members(kind: str) -> str:
    """The characters of a class up to U+FFFF, as ranges inside brackets."""
    import regex

    runs = regex.finditer(f"{kind}+", "".join(map(chr, range(0x10000))))
    return "".join(f"\\u{run.start():04x}-\\u{run.end() - 1:04x}" for run in runs)


def java_pattern(pattern: str) -> str:
    """The pattern for Java, whose ``\\s`` is ASCII only: white space is spelt out, which is faster than its Unicode mode."""
    space = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
    return pattern.replace(r"[^\s", f"[^{space}").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")


def word_table(docs: DataFrame, pattern: str, fold_bytes: int, text_col: str) -> DataFrame:
    """w, level (16 * log2 of its count): the distinct words of all documents, but for those over ``fold_bytes``."""
    found = F.explode(F.regexp_extract_all(whole_text(text_col), F.lit(java_pattern(pattern)), F.lit(0)))
    counts = docs.select(found.alias("w")).where((F.octet_length("w") > 0) & (F.octet_length("w") <= fold_bytes)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return materialise(counts.select("w", F.floor(F.log2(F.col("n")) * 16).cast("int").alias("level")), "words", few=True)


def least_level(levels: dict[int, int], words: int) -> int:
    """The least level that at most ``words`` words reach; beyond all levels if even the highest has more."""
    least = max(levels, default=0) + 1
    for level in sorted(levels, reverse=True):
        words -= levels[level]
        if words < 0:
            break
        least = level
    return least


def folded(table: DataFrame, ranks: Column) -> DataFrame:
    """w, level, ids of a word table."""
    spread = table.repartition(shuffle_width(table.sparkSession))
    return spread.select("w", "level", F.get(encode_words(F.array(F.col("w").cast("binary")), ranks), F.lit(0)).alias("ids"))


_loaded: dict = {}


def loaded(name: str, shared, make):
    """What ``make`` builds of a broadcast value, once in a worker process that stays in one of the passes; it holds only one pass's data,
    not the broadcast's own copy either, which would outlast the pass."""
    key = (name, make.__name__)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = make(shared.value)
        if getattr(shared, "_path", None):  # a worker that comes back to this pass reads the file again
            vars(shared).pop("_value", None)
    return _loaded[key]


class Index(dict):
    """Dictionary word -> code.  Words that it lacks get the codes behind its own, in the order in which the unit meets them."""

    own: dict[str, int]
    fresh: list[str]

    def new_unit(self) -> None:
        self.own, self.fresh = {}, []

    def __missing__(self, word: str) -> int:
        code = self.own.get(word)
        if code is None:
            code = self.own[word] = len(self) + len(self.own)
            self.fresh.append(word)
        return code


def pick(source, keys: list) -> tuple:
    """``source[k]`` for each key, in one call."""
    return itemgetter(*keys)(source) if len(keys) > 1 else tuple(source[k] for k in keys)


def word_index(words: list[str]) -> Index:
    return Index(zip(words, range(len(words)), strict=True))


class WordIds:
    """The ids of words by code, in flat arrays: a few bytes a word.  Words behind the dictionary's belong to a unit and are forgotten with it."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        # nothing is written below ``hot``, and what is behind it is ``room``'s
        self.flat, self.lengths, self.starts = flat, lengths, np.cumsum(lengths, dtype=np.int64) - lengths
        self.hot = self.end = (len(lengths), len(flat))

    def new_unit(self) -> None:
        self.end = self.hot

    def extend(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        (w, i), (more_w, more_i) = self.end, (len(lengths), len(flat))
        self.lengths, self.starts, self.flat = room(self.lengths, w + more_w), room(self.starts, w + more_w), room(self.flat, i + more_i)
        self.lengths[w : w + more_w] = lengths
        self.starts[w : w + more_w] = i + np.cumsum(lengths, dtype=np.int64) - lengths
        self.flat[i : i + more_i] = flat
        self.end = w + more_w, i + more_i

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The ids of the words, one word's behind the other's."""
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths, dtype=np.int64)
        shift = np.repeat(self.starts[codes] - ends + lengths, lengths)
        return self.flat[shift + np.arange(len(shift))]


def room(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size`` values; grows by half at least."""
    if size <= len(values):
        return values
    out = np.empty(max(size, len(values) * 3 // 2), values.dtype)
    out[: len(values)] = values
    return out


def word_ids(data: tuple[np.ndarray, np.ndarray, list[bytes]]) -> tuple:
    """The ids of the dictionary's words; per id its byte string, and its digits with the space behind them, as Arrow arrays."""
    import pyarrow as pa

    flat, lengths, table = data
    return WordIds(flat, lengths), pa.array(table, pa.large_binary()), pa.array([b"%d " % i for i in range(len(table))], pa.large_binary())


def strung(strings, ids: np.ndarray) -> memoryview:
    """The byte strings (an Arrow array of large binaries) of the ids, one behind the other, without a Python object for each."""
    if not len(ids):
        return memoryview(b"")
    _, ends, data = strings.take(ids).buffers()
    return memoryview(data)[: np.frombuffer(ends, np.int64, len(ids) + 1)[-1]]


def digest(ids: np.ndarray, table, digits) -> tuple:
    """Number of ids, SHA-256 of the decimal ids and of the bytes that they decode to."""
    return len(ids), hashlib.sha256(strung(digits, ids)[:-1]).hexdigest(), hashlib.sha256(strung(table, ids)).hexdigest()


def token_ids(ids: np.ndarray, table, digits) -> tuple:
    return (ids,)


def flat_lists(lists) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow column of integer lists as its values and the lists' lengths, 32 bits each."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.diff(lists.offsets.to_numpy()).astype(np.int32)


def with_long(flat: np.ndarray, lengths: np.ndarray, long: list[bytes], single) -> tuple[np.ndarray, np.ndarray]:
    """Empty lists are the places of long words, whose ids are filled in."""
    rest = iter(long)
    parts = [part if len(part) else np.asarray(single(next(rest)), np.int32) for part in np.split(flat, np.cumsum(lengths)[:-1])]
    return np.concatenate(parts), np.asarray([len(part) for part in parts], np.int32)


def encoded(docs: DataFrame, vocabulary: Vocabulary, finish, schema: str, dictionary_words: int, unit_words: int, fold_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id and what ``finish`` makes of a text's ids."""
    if fold_bytes >= 1 << PLACE_BITS:
        raise ValueError(f"words to fold have fewer than {1 << PLACE_BITS} bytes")
    spark, ranks = docs.sparkSession, dict(vocabulary.items)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for word, i in ranks.items():
        table[i] = word
    literal, name, pattern, target = rank_literal(ranks), uuid.uuid4().hex, vocabulary.pattern, to_arrow(schema)
    words = word_table(docs, pattern, fold_bytes, text_col)
    levels = {r["level"]: r["count"] for r in words.groupBy("level").count().collect()}  # at most 16 * 63 rows
    top = folded(words.where(F.col("level") >= least_level(levels, dictionary_words)), literal).select("w", "ids").toArrow()  # at most dictionary_words rows
    index_data = spark.sparkContext.broadcast(top.column("w").to_pylist())
    shared = spark.sparkContext.broadcast((*flat_lists(top.column("ids").combine_chunks()), table))
    del top

    def first_pass(batches):
        import pyarrow as pa

        find, index = split_words(pattern), loaded(name, index_data, word_index)
        index.new_unit()
        start, layout = True, pa.schema([("doc_id", pa.int64()), ("start", pa.bool_()), ("codes", pa.binary()), ("own", pa.list_(pa.binary())), ("long", pa.list_(pa.binary()))])
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("t").to_pylist(), strict=True):
                    codes = array("i", pick(index, find(text.decode("utf-8", "replace")))).tobytes()
                    raw, index.fresh = [w.encode() for w in index.fresh], []
                    # a long word leaves an empty place among the words to fold
                    rows.append((doc, start, codes, [w if len(w) <= fold_bytes else b"" for w in raw], [w for w in raw if len(w) > fold_bytes]))
                    start = len(index.own) >= unit_words
                    if start:
                        index.new_unit()
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), layout, strict=True)], schema=layout)
        index.new_unit()

    def second_pass(batches):
        import pyarrow as pa

        single = lambda word: vocabulary.encoder()._encode_single_piece(word)  # noqa: E731  most tasks see no long word
        ids_of, table, digits = loaded(name, shared, word_ids)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                part = whole.slice(at, SLICE)
                own = part.column("own")
                flat, lengths = flat_lists(own.flatten())
                words, places = np.diff(own.offsets.to_numpy()).cumsum().tolist(), [0, *np.cumsum(lengths, dtype=np.int64).tolist()]
                rows, first = [], 0
                for doc, start, codes, last, long in zip(*(part.column(c).to_pylist() for c in ("doc_id", "start", "codes")), words, part.column("long").to_pylist(), strict=True):
                    if start:
                        ids_of.new_unit()
                    if last > first:
                        found = flat[places[first] : places[last]], lengths[first:last]
                        ids_of.extend(*(with_long(*found, long, single) if long else found))
                    first = last
                    rows.append((doc, *finish(ids_of.of(np.frombuffer(codes, np.int32)), table, digits)))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).cast("binary").alias("t"))
    parts = texts.mapInArrow(first_pass, "doc_id long, start boolean, codes binary, own array<binary>, long array<binary>")
    return parts.select("doc_id", "start", "codes", encode_words(F.col("own"), literal).alias("own"), "long").mapInArrow(second_pass, schema)


def bpe_encode(docs: DataFrame, vocabulary: Vocabulary, dictionary_words: int = 800_000, unit_words: int = 200_000, fold_bytes: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array<int>) for each row of ``docs``."""
    return encoded(docs, vocabulary, token_ids, "doc_id long, ids array<int>", dictionary_words, unit_words, fold_bytes, id_col, text_col)


def bpe_digests(docs: DataFrame, vocabulary: Vocabulary, dictionary_words: int = 800_000, unit_words: int = 200_000, fold_bytes: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by spaces), decoded_sha256 (of the decoded ids)."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded(docs, vocabulary, digest, schema, dictionary_words, unit_words, fold_bytes, id_col, text_col)


def bpe_decode(tokens: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded`` (binary): the byte strings of the ids, concatenated.  An unknown id is an error."""
    table = {str(i): w.hex().upper() for w, i in vocabulary.items}
    size = max((i for _, i in vocabulary.items), default=-1) + 1
    pieces = F.from_json(F.lit(json.dumps([table.get(str(i)) for i in range(size)])), "array<string>")
    return tokens.withColumn("decoded", F.unhex(let(pieces, lambda p: F.array_join(F.transform(F.col(ids_col), lambda i: F.element_at(p, i + 1)), ""))))
