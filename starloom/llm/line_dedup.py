"""Drop lines that many documents share, found in minimal perfect hash arrays.

A line's key is the line stripped of white space, A-Z lower-cased. Keys are hashed (64 and 32
bits), counted per document with partial sums before the shuffle, and those found often enough
are put into shards. Each shard is a minimal perfect hash (levels of bit arrays; a key sits in
the first level where its bit is its own) that gives a key's place in a compact array of
fingerprints and one of counts, which are capped at the
limit that is tested. Documents probe these arrays; no line is joined.

The arrays are broadcast while the counted number of keys is at most ``max_keys``. A key takes 12
bytes of fingerprint, 1 of count (2 or more if ``min_docs`` is over 255) and some 0.7 of bits and
ranks, 55 MB at 4 million keys; the driver holds them once, a Python worker twice, as they came and
unpacked. Beyond it each shard's arrays stay with one task, or several of ``PROBES`` probes each, and
the documents' line hashes are sent to the shards that may have them and probe there.

Defined cases: a null text is one empty line, and so is an empty one. Blank lines have an empty
key and stay unless ``min_chars`` is 0. Every row counts as a document, repeated ones too.
Rows keep all their columns in ``row``, whatever their names.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, ascii_lower, text_of, written

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 1 << 18
MAX_KEYS = 4_000_000
PROBES = 2_000_000
LEVELS = 24
SLOTS_PER_KEY = 2.0
_STEP = np.uint64(0x9E3779B97F4A7C15)


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(F.split(ascii_lower(text), "\n"), lambda x: F.btrim(x, F.lit(SPACES)))


def frequent_keys(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(h1, h2, n): hashes of the keys in at least ``min_docs`` documents."""
    key = F.explode(F.array_distinct(line_keys(text_of(docs, text)))).alias("key")
    return (
        docs.select(key)
        .where(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
    )


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64(int(_STEP) * (level + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, with their fingerprints and counts.

    The few keys that no level could place, equal ones among them, are kept sorted.
    """

    def __init__(self, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray):
        self.words, self.ranks, self.sizes = [], [], []
        rest = np.arange(len(h1))
        place = np.empty(len(h1), dtype=np.int64)
        placed = 0
        for level in range(LEVELS):
            if not len(rest):
                break
            size = max(64, int(len(rest) * SLOTS_PER_KEY))
            slot = (_mixed(h1[rest], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size)[slot] == 1
            bits = np.zeros((size + 63) // 64 * 64, dtype=np.uint8)
            bits[slot[alone]] = 1
            words = np.packbits(bits, bitorder="little").view(np.uint64)
            ranks = placed + np.concatenate([[0], np.cumsum(np.bitwise_count(words))])[:-1]
            self.words.append(words)
            self.ranks.append(ranks.astype(np.uint32))
            self.sizes.append(size)
            place[rest[alone]] = self._place(slot[alone], words, self.ranks[-1])
            placed += int(alone.sum())
            rest = rest[~alone]
        last = rest[np.argsort(h1[rest], kind="stable")]
        place[last] = placed + np.arange(len(last))
        self.rest = h1[last]
        self.high = np.empty(len(h1), dtype=np.uint64)
        self.low = np.empty(len(h1), dtype=np.int32)
        self.counts = np.empty(len(h1), dtype=np.min_scalar_type(counts.max(initial=0)))
        self.high[place], self.low[place], self.counts[place] = h1, h2, counts

    @staticmethod
    def _place(slot: np.ndarray, words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (slot & 63).astype(np.uint64)) - np.uint64(1)
        return ranks[slot >> 6] + np.bitwise_count(words[slot >> 6] & below)

    def lookup(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The count of each probed key, 0 for one that isn't there."""
        found = np.zeros(len(h1), dtype=np.int64)
        todo = np.arange(len(h1))
        for level, (words, ranks, size) in enumerate(
            zip(self.words, self.ranks, self.sizes, strict=True)
        ):
            if not len(todo):
                return found
            slot = (_mixed(h1[todo], level) % np.uint64(size)).astype(np.int64)
            own = (words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
            hit, at = todo[own], self._place(slot[own], words, ranks)
            same = (self.high[at] == h1[hit]) & (self.low[at] == h2[hit])
            found[hit[same]] = self.counts[at[same]]
            todo = todo[~own]
        if len(self.rest) and len(todo):
            first = len(self.high) - len(self.rest)
            lo = np.searchsorted(self.rest, h1[todo], "left")
            hi = np.searchsorted(self.rest, h1[todo], "right")
            for i in np.flatnonzero(hi > lo):
                for at in range(first + lo[i], first + hi[i]):
                    if self.low[at] == h2[todo[i]]:
                        found[todo[i]] = self.counts[at]
        return found


_BLOB = "words ranks sizes rest high low counts".split()


def _pack(table: PerfectHash) -> bytes:
    return pickle.dumps([getattr(table, name) for name in _BLOB], protocol=5)


def _unpack(arrays: bytes) -> PerfectHash:
    table = PerfectHash.__new__(PerfectHash)
    for name, value in zip(_BLOB, pickle.loads(arrays), strict=True):
        setattr(table, name, value)
    return table


def _shard_of(h2: np.ndarray, shards: int) -> np.ndarray:
    return h2.astype(np.int64) % shards


def build_shards(frequent: DataFrame, shards: int, cap: int) -> DataFrame:
    """(shard, arrays): one row per shard, built where its keys are shuffled to.

    Counts above ``cap`` are stored as ``cap``.
    """

    def build(group: pa.Table) -> pa.Table:
        h1, h2, n = (group.column(c).to_numpy() for c in ("h1", "h2", "n"))
        arrays = _pack(PerfectHash(h1.view(np.uint64), h2, np.minimum(n, cap)))
        return pa.table(
            {
                "shard": pa.array([group["shard"][0].as_py()], pa.int64()),
                "arrays": pa.array([arrays], pa.binary()),
            }
        )

    keyed = frequent.withColumn("shard", F.pmod(F.col("h2").cast("long"), F.lit(shards)))
    return keyed.groupBy("shard").applyInArrow(build, "shard long, arrays binary")


def _probe(shards: int, shared) -> Column:
    tables: dict[int, PerfectHash] = {}

    def counts(keys: pa.Array, others: pa.Array) -> pa.Array:
        if not tables:
            tables.update({shard: _unpack(arrays) for shard, arrays in shared.value})
        h1 = keys.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        h2 = others.flatten().to_numpy(zero_copy_only=False)
        shard = _shard_of(h2, shards)
        found = np.zeros(len(h1), dtype=np.int64)
        for number, table in tables.items():
            mine = np.flatnonzero(shard == number) if shards > 1 else np.arange(len(h1))
            found[mine] = table.lookup(h1[mine], h2[mine])
        sizes = keys.value_lengths().to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    return F.arrow_udf(counts, "array<long>")


def line_verdicts(
    docs: DataFrame,
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    max_keys: int = MAX_KEYS,
) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped) for every document."""
    frequent = written(frequent_keys(docs, text, min_docs, min_chars), "frequent_lines")
    keys = frequent.limit(max_keys + 1).count()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        text_of(docs, text).alias("whole"),
    )
    hashed = line_keys(F.col("whole"))
    if keys <= max_keys:
        shards = max(1, -(-keys // SHARD_KEYS))
        arrays = [tuple(r) for r in build_shards(frequent, shards, max(min_docs, 1)).collect()]
        shared = docs.sparkSession.sparkContext.broadcast(arrays)
        rows = rows.withColumn("keys", hashed).select(
            "row",
            "whole",
            _probe(shards, shared)(
                F.transform("keys", lambda k: F.xxhash64(k)),
                F.transform("keys", lambda k: F.hash(k)),
            ).alias("counts"),
        )
        dropped = F.transform("counts", lambda n: n >= min_docs)
    else:
        rows, dropped = _sent_to_shards(rows, hashed, frequent, max(min_docs, 1))
    return (
        rows.select("row", F.split("whole", "\n").alias("lines"), dropped.alias("dropped"))
        .select(
            "row",
            F.size("lines").cast("long").alias("n_lines"),
            F.filter("lines", lambda _, i: ~F.col("dropped")[i]).alias("kept"),
        )
        .select(
            "row",
            F.array_join("kept", "\n").alias("kept_text"),
            "n_lines",
            (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        )
    )


def _sent_to_shards(
    rows: DataFrame, keys: Column, frequent: DataFrame, cap: int
) -> tuple[DataFrame, Column]:
    """Beyond the broadcast bound: each distinct text gets the set of its frequent hashes."""
    rows = rows.withColumn("digest", F.md5("whole"))
    pair = F.explode(
        F.array_distinct(
            F.transform(keys, lambda k: F.struct(F.xxhash64(k).alias("h1"), F.hash(k).alias("h2")))
        )
    )
    probes = written(
        rows.select("digest", pair.alias("k")).select("digest", "k.*").distinct(), "line_probes"
    )
    shards = max(1, -(-frequent.count() // SHARD_KEYS))
    # A line that all documents have sends a probe each to one shard: its tasks share them.
    salts = max(1, -(-probes.count() // (shards * PROBES)))
    dealt = probes.select(
        "*",
        F.pmod(F.col("h2").cast("long"), F.lit(shards)).alias("shard"),
        F.pmod(F.xxhash64("digest"), F.lit(salts)).alias("salt"),
    )
    arrays = build_shards(frequent, shards, cap).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )

    def probe(mine: pa.Table, table: pa.Table) -> pa.Table:
        mine = mine.select(["digest", "h1", "h2"])
        if not len(mine) or not len(table):
            return mine.slice(0, 0)
        h1, h2 = mine["h1"].to_numpy().view(np.uint64), mine["h2"].to_numpy()
        counts = _unpack(table["arrays"][0].as_py()).lookup(h1, h2)
        return mine.filter(pa.array(counts > 0))

    found = (
        dealt.groupBy("shard", "salt")
        .cogroup(arrays.groupBy("shard", "salt"))
        .applyInArrow(probe, "digest string, h1 long, h2 int")
        .groupBy("digest")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("hits"))
    )
    hit = F.col("hits")
    dropped = F.transform(
        keys,
        lambda k: F.coalesce(
            F.array_contains(hit, F.struct(F.xxhash64(k).alias("h1"), F.hash(k).alias("h2"))),
            F.lit(False),
        ),
    )
    return rows.join(found, "digest", "left"), dropped


def drop_frequent_lines(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """The documents with frequent lines taken out; a column ``n_chars`` follows the text."""
    verdicts = line_verdicts(docs, text, **limits)
    kept = F.when(F.col("row")[text].isNotNull(), F.col("kept_text"))
    columns = []
    for name, kind in docs.dtypes:
        value = F.col("row")[name]
        if name == text:
            value = kept.cast(kind)
        elif name == "n_chars":
            value = F.when(F.col("n_dropped") > 0, F.length(kept).cast(kind)).otherwise(value)
        columns.append(value.alias(name))
    return verdicts.select(*columns)

