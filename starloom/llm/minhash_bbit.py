"""Near copies by b-bit MinHash, confirmed on the whole sets.

A document's set holds its distinct five-word shingles; two documents link when their sets have a
similarity of at least ``PERCENT``.

1. Each distinct text gets ``HASHES`` minima of its shingles under as many hash functions. Bands of
   ``ROWS`` minima each become one key; what is kept of the minima themselves are their low
   ``BITS`` bits, packed into words. A linked pair has no band in common with a probability of at
   most (1 - 0.85 ^ ROWS) ^ BANDS, 3e-7.
2. Texts that share a band key are candidates. In every group of one key all members are compared
   with one of them, which differs from band to band. A comparison first counts equal low bits:
   with m of ``HASHES`` equal, (m / HASHES - 2 ^ -BITS) / (1 - 2 ^ -BITS) estimates the similarity,
   free of the bits that agree by chance. Pairs estimated ``MARGIN`` standard deviations below the
   threshold are dropped (a linked pair with a probability below 4e-6), the others are confirmed on
   the full sets, from the whole texts.
3. Links give connected components. In groups that still hold several, each member's packed bits
   are compared with those of the members of other components, and its likeliest partners are
   confirmed, ``ROUNDS`` times, in some of the bands, while that closes groups: similar documents
   that aren't all linked to one of them are joined by their nearest. What then is in different components of a group is
   confirmed wherever the bits allow, each pair in the first band that it shares. Groups are
   compared in blocks, each two in a task. So the members of a large group that are linked already
   aren't paired, and none is left out.

Defined cases: null and empty texts have the empty set and link with nothing; a text of fewer than
five words has the whole sequence as its one shingle; equal texts are one class from the start;
null ids are left out of a component's least id, which is null if there is no other, and are kept
only then; repeated documents get a row each, with equal results; an empty table gives no rows. Rows
keep all their columns in ``row``, whatever their names. Texts and shingles are stood for by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, text_of, written
from starloom.llm.components import components
from starloom.llm.jaccard_join import mixed, shingles_of

PERCENT = 85
ROWS = 8
BANDS = 48
HASHES = ROWS * BANDS
BITS = 4
MARGIN = 4.5
ROUNDS = 2
# A round looks at one in so many bands, and takes so many of a member's likeliest partners.
ROUND_BANDS = 4
PARTNERS = 2
# Members of one block of a large group; two blocks are compared in one task.
BLOCK = 1024
# Groups of the same members get one of so many first members.
CENTERS = 2
TILE = 32_768

_PER_WORD = 64 // BITS
_EVERY = np.uint64(sum(1 << (BITS * i) for i in range(_PER_WORD)))
_seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FLIPS = (_seeds[:HASHES] >> np.uint64(32)).astype(np.uint32)[:, None]
_FACTORS = (_seeds[HASHES:] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each hash function."""
    low = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), TILE):
        tile = low[at : at + TILE]
        # As many functions at once as stay in the cache.
        step = max(1, TILE // len(tile))
        for k in range(0, HASHES, step):
            hashed = (tile ^ _FLIPS[k : k + step]) * _FACTORS[k : k + step]
            # The multiplied high bits decide; their halves are swapped in so that low bits are mixed too.
            hashed ^= hashed >> np.uint32(15)
            np.minimum(least[k : k + step], hashed.min(axis=1), out=least[k : k + step])
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, from the whole minima."""
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key + rows[:, r])
    return key


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``64 / BITS`` of them in a word."""
    bits = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, _PER_WORD)
    shifts = np.arange(_PER_WORD, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(bits << shifts, axis=1)


def equal_minima(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many packed minima agree, along the last axis."""
    apart = a ^ b
    for shift in (1, 2, 4)[: BITS.bit_length() - 1]:
        apart = apart | apart >> np.uint64(shift)
    return HASHES - np.bitwise_count(apart & _EVERY).sum(axis=-1, dtype=np.int64)


def estimated(equal: np.ndarray) -> np.ndarray:
    """The similarity that so many equal minima stand for, corrected for chance."""
    chance = 2.0**-BITS
    return (equal / HASHES - chance) / (1 - chance)


def least_equal() -> int:
    """Equal minima that a pair at the threshold falls below only by ``MARGIN`` deviations."""
    chance = 2.0**-BITS
    share = PERCENT / 100 * (1 - chance) + chance
    return math.floor(HASHES * share - MARGIN * math.sqrt(HASHES * share * (1 - share)))


_SIGNED = "id long, n int, bits binary, keys array<long>"


def signatures(classes: DataFrame) -> DataFrame:
    """A written table (id, n, bits, keys) with a row for each distinct text (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies within a partition are signed once.
        seen: set[int] = set()
        for batch in batches:
            ids, sizes, bits, keys = [], [], [], []
            texts = batch.column("text")
            for i, key in enumerate(batch.column("id").to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                shingles = shingles_of(texts[i].as_py())
                ids.append(key)
                sizes.append(len(shingles))
                if len(shingles):
                    least = minima(shingles)
                    bits.append(packed(least).tobytes())
                    keys.append(band_keys(least).view(np.int64))
                else:
                    bits.append(b"")
                    keys.append(np.zeros(0, dtype=np.int64))
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int32()),
                    pa.array(bits, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["id", "n", "bits", "keys"],
            )

    signed = classes.select("id", "text").mapInArrow(run, _SIGNED)
    return written(
        signed.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "bits", "keys")]), "signatures"
    )


def _grouped(signed: DataFrame) -> DataFrame:
    """A written table (key, band, id, n) of the members of groups of several.

    Keys are counted before their rows meet, and rows join the counted keys: adaptive execution
    splits a key that very many have.
    """
    given = signed.select("id", "n", F.posexplode("keys").alias("band", "key"))
    several = given.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    several = written(several, "band_keys")
    return written(join_measured(given, several, ["key"], "inner"), "band_groups")


def _sizes_fit(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each group's members with one of them.

    The one is of least hash; groups of the same members, which near copies have by the dozen,
    have different ones.
    """
    place = F.xxhash64("id", F.pmod("band", F.lit(CENTERS)))
    one = F.min(F.struct(place.alias("place"), "id", "n")).alias("one")
    centers = written(members.groupBy("key").agg(one), "centers")
    return (
        join_measured(members, centers, ["key"], "inner")
        .withColumn("n_one", F.col("one.n"))
        .where("id <> one.id")
        .where(_sizes_fit("n", "n_one"))
        .select(F.least("id", "one.id").alias("a"), F.greatest("id", "one.id").alias("b"))
        .distinct()
    )


def _likely(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs whose packed minima agree as often as linked sets' do; a written table."""
    enough = least_equal()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(batch), -1)
                for c in ("s_a", "s_b")
            )
            mask = pa.array(equal_minima(one, other) >= enough) if len(batch) else pa.array([], pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    bits = signed.select("id", "bits")
    for side in "ab":
        pairs = pairs.join(bits.select(F.col("id").alias(side), F.col("bits").alias(f"s_{side}")), side)
    return written(pairs.mapInArrow(run, "a long, b long"), "likely")


def _confirmed(likely: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; a written table."""
    ids = likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()
    texts = (
        join_measured(classes, written(ids, "ids"), ["id"], "left_semi")
        .groupBy("id")
        .agg(F.first("text").alias("text"))
    )
    texts = written(texts, "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, last = np.zeros(0, dtype=np.uint64), None
        for batch in batches:
            keep, left, right = [], batch.column("t_a"), batch.column("t_b")
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    one, last = shingles_of(left[i].as_py()), a
                other = shingles_of(right[i].as_py())
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(one) + len(other) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    for side in "ba":
        likely = likely.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"t_{side}")), side)
    return written(likely.mapInArrow(run, "a long, b long"), "confirmed")


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the groups that hold several components so far, with these; a written table."""
    found = written(components(links), "components")
    members = join_measured(members.select("key", "band", "id", "n"), found, ["id"]).withColumn(
        "component", F.coalesce("component", "id")
    )
    several = (
        members.groupBy("key")
        .agg(
            F.count("*").alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        # The two of a group of two have been compared.
        .where("size > 2 and least < most")
        .select("key", "size")
    )
    return written(
        join_measured(members, written(several, "open_keys"), ["key"], "inner"), "open"
    )


def _likeliest(equal: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``most`` greatest values of each row, where these aren't negative."""
    if most < equal.shape[1]:
        columns = np.argpartition(-equal, most - 1, axis=1)[:, :most]
    else:
        columns = np.broadcast_to(np.arange(equal.shape[1]), equal.shape)
    found = np.take_along_axis(equal, columns, axis=1) >= 0
    rows, at = np.nonzero(found)
    return rows, columns[rows, at]


def _blocks(open_groups: DataFrame, signed: DataFrame, most: int | None = None) -> DataFrame:
    """Likely pairs (a, b) in different components of a group; a written table.

    A group of more than ``BLOCK`` members is dealt to blocks by their ids' hash, and every two
    blocks are compared in a task of their own. With ``most`` a member gives no more than so many
    of its likeliest pairs to every two blocks; without, all of them, from the first band of each.
    """
    enough = least_equal()
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    # Only the signatures of members are shuffled.
    ids = written(open_groups.select("id").distinct(), "open_ids")
    own = join_measured(signed.select("id", "bits", "keys"), ids, ["id"], "left_semi")
    dealt = (
        open_groups.join(own, "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            *("id", "n", "band", "component", "block", "bits", "keys"),
        )
    )

    def run(rows: pa.Table) -> pa.Table:
        ids, n, component, block = (
            rows[c].to_numpy() for c in ("id", "n", "component", "block")
        )
        low, high, band = (rows[c][0].as_py() for c in ("low", "high", "band"))
        bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint64).reshape(len(rows), -1)
        keys = np.stack(rows["keys"].to_numpy())
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        sides = [(left, right), (right, left)] if most and low < high else [(left, right)]
        out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for mine, others in sides:
            for at in range(0, len(mine), 64):
                some = mine[at : at + 64, None]
                equal = equal_minima(bits[some], bits[others])
                fits = (
                    (component[some] != component[others])
                    & (np.minimum(n[some], n[others]) * 100 >= np.maximum(n[some], n[others]) * PERCENT)
                    & (equal >= enough)
                )
                if most:
                    i, j = _likeliest(np.where(fits, equal, -1), most)
                    one, other = some[i, 0], others[j]
                else:
                    if low == high:
                        fits &= ids[some] < ids[others]
                    i, j = np.nonzero(fits)
                    one, other = some[i, 0], others[j]
                    first = ~(keys[one, :band] == keys[other, :band]).any(axis=1)
                    one, other = one[first], other[first]
                a, b = ids[one], ids[other]
                out.append((np.minimum(a, b), np.maximum(a, b)))
        a, b = (np.concatenate(side) for side in zip(*out, strict=True))
        return pa.table({"a": a, "b": b})

    found = dealt.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")
    return written(found.distinct() if most else found, "block_pairs")


def classes_of(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, n_shingles, component_id, root) as a written table: one row per distinct text."""
    whole = F.make_valid_utf8(text_of(docs, text))
    classes = docs.select(F.xxhash64(whole).alias("id"), whole.alias("text"))
    signed = signatures(classes)
    members = _grouped(signed)
    links = _confirmed(_likely(_stars(members), signed), classes)
    open_groups, left = _open(members, links), None
    for number in range(ROUNDS):
        # A round that closes no group ends the rounds; what follows leaves nothing out.
        now = open_groups.count()
        if now == 0 or now == left:
            break
        left = now
        some = open_groups.where(F.col("band") % ROUND_BANDS == number)
        links = links.union(_confirmed(_blocks(some, signed, PARTNERS), classes))
        open_groups = _open(open_groups, links)
    links = links.union(_confirmed(_blocks(open_groups, signed), classes))
    found = written(components(links), "components")
    least = (
        docs.select(F.xxhash64(whole).alias("id"), docs[doc_id].alias("doc_id"))
        .groupBy("id")
        .agg(F.min("doc_id").alias("least"))
    )
    rows = written(
        join_measured(least.join(signed.select("id", "n"), "id"), found, ["id"]).select(
            "id",
            F.col("n").cast("long").alias("n_shingles"),
            F.coalesce("component", "id").alias("root"),
            "least",
        ),
        "classes",
    )
    roots = rows.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(rows.drop("least").join(roots, "root"), "class_components")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, n_shingles, component_id, kept) for every document."""
    whole = F.make_valid_utf8(text_of(docs, text))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(whole).alias("id")
    )
    own = F.col("row")[doc_id]
    component = F.when(F.col("n_shingles") == 0, own).otherwise(F.col("component_id"))
    return (
        join_measured(rows, classes_of(docs, text, doc_id), ["id"])
        .withColumn("component_id", component)
        .select("row", "n_shingles", "component_id", own.eqNullSafe(F.col("component_id")).alias("kept"))
    )
