"""Similar documents by the Jaccard similarity of their word shingles: a parity-sketch join.

A document's set holds its distinct five-word shingles. Two documents link when their sets have a
similarity of at least ``PERCENT``; two such sets of a and b shingles differ in at most
D = (a + b) (100 - PERCENT) / (100 + PERCENT) shingles.

1. Sets are sorted into size bands. In a band, shingles are dealt to regions by their hash and
   each region's shingles XOR-ed: one shingle more or less changes one region, so D bounds the
   regions that differ. A set takes part in its own band, and in the next one if a partner can
   be there. Of its regions that aren't empty it gives D + 1, in an order all sets share
   (regions that are common in a sample of the documents come last, then by hash): by the
   pigeonhole principle two linked sets give one in common, with the same XOR.
2. Sets with a region in common are grouped by a shuffle on it. In each group some are compared
   with one of them: first their bit sketches (parity bits, whose Hamming distance is a lower
   bound of the difference), then the sets themselves, from the whole texts. The links give
   connected components.
3. In groups that hold several components, members are compared with another one, to join near
   copies whose first one was far off. What then is still in different components of a group is
   compared, all of it: sketches in blocks, and the sets of the pairs that are left. So no link
   is lost, and linked members of a large group aren't paired.

Equal texts are one class, by hash, from the start. Texts are stood for by 64-bit hashes, and
shingles too; a band's region number is such that a set with too few regions in use has a
probability below 1e-12. Defined cases: null and empty texts have the empty set and link with
nothing; a text of fewer than five words has the whole sequence as its one shingle; null ids are
left out of a component's least id, which is null if there is no other; repeated documents get
a row each, with equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, text_of, written
from starloom.llm.components import components

PERCENT = 75
WIDTH = 5
FIRST_BAND = 16
BAND_FACTOR = 4
SAMPLE_DOCS = 20_000
SAMPLE_COMMON = 3
BLOCK = 512
FIRST_KEYS = 16
MEMORY_WORDS = 400_000
MAX_SKETCH_BITS = 8192
FLUSH_ROWS = 200_000

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    x = (x ^ (x >> np.uint64(32))) * _Q
    return x ^ (x >> np.uint64(32))


class Shingler:
    """A text's set as sorted 64-bit hashes; words' hashes are kept per worker."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        n = len(words)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        try:
            codes = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        except KeyError:
            if len(self.words) > MEMORY_WORDS:
                self.words.clear()
            for word in set(words):
                if word not in self.words:
                    self.words[word] = xxhash.xxh64_intdigest(word)
            codes = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        width = min(n, WIDTH)
        folded = codes[: n - width + 1] + np.uint64(width)
        for k in range(1, width):
            folded = folded * _P + codes[k : n - width + 1 + k]
        return np.unique(mixed(folded))


_shingler = Shingler()


def shingles_of(text: str) -> np.ndarray:
    """By the worker's own shingler, whose words stay from task to task."""
    return _shingler(text)


def most_different(a: int, b: int) -> int:
    """Shingles in which linked sets of these sizes can differ."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def band_of(size: int) -> int:
    """The band's upper end; sizes are below it."""
    end = FIRST_BAND
    while size >= end:
        end *= BAND_FACTOR
    return end


def regions(shingles: np.ndarray, end: int) -> np.ndarray:
    """Keys of the regions in use: band, region and the XOR of its shingles in one hash."""
    # Half as many regions as the largest set has shingles; many more for small sets.
    bits = 16 if end <= 64 else end.bit_length() - 2
    region = shingles >> np.uint64(64 - bits)
    starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    xors = np.bitwise_xor.reduceat(mixed(shingles ^ _P), starts)
    return mixed(xors + region[starts] * _P + np.uint64(end))


def keys(shingles: np.ndarray, common: np.ndarray | None) -> np.ndarray:
    """The region keys that a set gives; all of them if ``common`` is None."""
    size, given = len(shingles), []
    end = band_of(size)
    largest = size * 100 // PERCENT
    bands = [(end, min(largest, end - 1))]
    if largest >= end:
        bands.append((end * BAND_FACTOR, largest))
    for end, partner in bands:
        found = regions(shingles, end)
        need = most_different(size, partner) + 1
        if common is not None and need < len(found):
            at = np.minimum(np.searchsorted(common, found), max(0, len(common) - 1))
            last = common[at] == found if len(common) else np.zeros(len(found), dtype=bool)
            order = (found >> np.uint64(1)) | (last.astype(np.uint64) << np.uint64(63))
            found = found[np.argpartition(order, need - 1)[:need]]
        given.append(found)
    # Equal sets have this key in common as well.
    whole = (int(shingles.sum()) + size * int(_Q)) % 2**64
    given.append(mixed(np.array([whole], dtype=np.uint64)))
    return np.concatenate(given)


def sketch(shingles: np.ndarray) -> bytes:
    """Parity bits of the set: each shingle flips one."""
    bits = 64
    while bits < min(4 * len(shingles), MAX_SKETCH_BITS):
        bits *= 2
    places = (mixed(shingles + _Q) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each) as those of fewer bits."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


_GIVEN = "key long, id long, n int, sketch binary"


def give(classes: DataFrame, common: np.ndarray | None) -> DataFrame:
    """Region rows (key, id, n) and, with the id as key, a row with the sketch of each set."""
    shared = None
    if common is not None:
        shared = classes.sparkSession.sparkContext.broadcast(common)

    def rows(ids, sizes, found) -> pa.RecordBatch:
        counts = [len(x) for x in found]
        return pa.record_batch(
            [
                pa.array(np.concatenate(found).view(np.int64)),
                pa.array(np.repeat(np.array(ids, dtype=np.int64), counts)),
                pa.array(np.repeat(np.array(sizes, dtype=np.int32), counts)),
                pa.nulls(sum(counts), pa.binary()),
            ],
            ["key", "id", "n", "sketch"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = None if shared is None else shared.value
        seen: set[int] = set()
        for batch in batches:
            ids, sizes, found, sketches, held = [], [], [], [], 0
            texts = batch.column("text")
            for i, key in enumerate(batch.column("id").to_pylist()):
                # Copies within a partition give their rows once.
                if key in seen:
                    continue
                seen.add(key)
                shingles = shingles_of(texts[i].as_py())
                ids.append(key)
                sizes.append(len(shingles))
                sketches.append(sketch(shingles))
                found.append(keys(shingles, order) if len(shingles) else shingles)
                held += len(found[-1])
                if held > FLUSH_ROWS:
                    yield from (rows(ids, sizes, found), marks(ids, sizes, sketches))
                    ids, sizes, found, sketches, held = [], [], [], [], 0
            if ids:
                yield from (rows(ids, sizes, found), marks(ids, sizes, sketches))

    def marks(ids, sizes, sketches) -> pa.RecordBatch:
        columns = [pa.array(ids, pa.int64()), pa.array(ids, pa.int64())]
        columns += [pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())]
        return pa.record_batch(columns, ["key", "id", "n", "sketch"])

    return classes.select("id", "text").mapInArrow(run, _GIVEN)


def common_keys(classes: DataFrame) -> np.ndarray:
    """Region keys of several documents of a sample; they only decide the order of regions."""
    share = max(1, classes.count() // SAMPLE_DOCS)
    sample = classes.where(F.pmod("id", F.lit(share)) == 0)
    found = (
        give(sample, None)
        .where("sketch is null")
        .groupBy("key")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= SAMPLE_COMMON)
        .select("key")
    )
    return np.sort(found.toPandas()["key"].to_numpy(dtype=np.int64).view(np.uint64))


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to groups: each member with the first of its group; single ones go."""
    schema = ["key", "id", "n", "first", "first_n", "sketch"]
    last_mark = None
    # The group still open: its key, last member, first member and whether that was given out.
    held = None
    for batch in batches:
        is_mark = batch.column("sketch").is_valid().to_numpy(zero_copy_only=False)
        key, who, n = (batch.column(c).to_numpy() for c in ("key", "id", "n"))
        if is_mark.any():
            at = np.flatnonzero(is_mark)
            fresh = np.concatenate([[who[at[0]] != last_mark], who[at[1:]] != who[at[:-1]]])
            last_mark = who[at[-1]]
            at = at[fresh]
            ids = pa.array(who[at])
            sizes = pa.array(n[at])
            found = batch.column("sketch").take(pa.array(at))
            yield pa.record_batch([ids, ids, sizes, ids, sizes, found], schema)
        key, who, n = key[~is_mark], who[~is_mark], n[~is_mark]
        if not len(key):
            continue
        before = (held[0], held[1]) if held else (None, None)
        same_key = np.concatenate([[key[0] == before[0]], key[1:] == key[:-1]])
        same_id = np.concatenate([[who[0] == before[1]], who[1:] == who[:-1]])
        fresh = ~(same_key & same_id)
        key, who, n, new = key[fresh], who[fresh], n[fresh], ~same_key[fresh]
        if not len(key):
            continue
        start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        first, first_n = who[start], n[start]
        if start[0] < 0:
            first[start < 0], first_n[start < 0] = held[2], held[3]
        member = ~new
        followed = np.concatenate([member[1:], [False]])
        give_out = member | followed
        out = [key, who, n, first, first_n]
        if held and start[0] < 0 and not held[4]:
            lead = [[held[0]], [held[2]], [held[3]], [held[2]], [held[3]]]
            out = [np.concatenate([a, b.astype(b.dtype)[give_out]]) for a, b in zip(lead, out, strict=True)]
        else:
            out = [column[give_out] for column in out]
        held = (key[-1], who[-1], first[-1], first_n[-1], bool(give_out[-1]) or start[-1] < 0)
        if len(out[0]):
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            columns = [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]
            yield pa.record_batch([*columns, pa.nulls(len(out[0]), pa.binary())], schema)


def _sizes_fit(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _near(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches differ in no more bits than linked sets may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "s_a", "s_b")]
            for n_a, n_b, one, other in zip(*columns, strict=True):
                if len(one) != len(other):
                    words = min(len(one), len(other)) // 8
                    one = folded(np.frombuffer(one, np.uint64), words).tobytes()
                    other = folded(np.frombuffer(other, np.uint64), words).tobytes()
                apart = (int.from_bytes(one, "little") ^ int.from_bytes(other, "little")).bit_count()
                keep.append(apart <= most_different(n_a, n_b))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    for side in "ab":
        its = sketches.select(
            F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")
        )
        pairs = pairs.join(its, side)
    return written(pairs.mapInArrow(run, "a long, b long"), "near")


def _linked(pairs: DataFrame, sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared whole."""
    near = _near(pairs, sketches)
    ids = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
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
        near = near.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"t_{side}")), side)
    return written(near.mapInArrow(run, "a long, b long"), "linked")


def _blocks(open_groups: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of different components in a group that their sketches don't rule out.

    A group of more than ``BLOCK`` is dealt to blocks, and every two blocks are compared.
    Near copies are together in many groups; a pair is given by the one of the least key,
    and by others only where this isn't among either's ``FIRST_KEYS`` least.
    """
    first_keys = open_groups.groupBy("id").agg(
        F.slice(F.sort_array(F.collect_set("key")), 1, FIRST_KEYS).alias("first_keys")
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        open_groups.join(first_keys.join(sketches.select("id", "sketch"), "id"), "id")
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            *("id", "n", "component", "block", "sketch", "first_keys"),
        )
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            ends = _group_ends(rows)
            # The last group may go on in the next batch.
            yield from _compared(rows, ends[:-1])
            rest = rows.slice(int(ends[-2]) if len(ends) > 1 else 0)
        if rest is not None:
            yield from _compared(rest, _group_ends(rest))

    return dealt.mapInArrow(run, "a long, b long")


def _group_ends(rows: pa.Table) -> np.ndarray:
    """Where each group of sorted rows ends; the first number is 0."""
    same = np.ones(len(rows) - 1, dtype=bool)
    for name in ("key", "low", "high"):
        values = rows[name].to_numpy()
        same &= values[1:] == values[:-1]
    return np.concatenate([[0], np.flatnonzero(~same) + 1, [len(rows)]])


def _compared(rows: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    ids, n, component, block, low, high = (
        rows[c].to_numpy() for c in ("id", "n", "component", "block", "low", "high")
    )
    sketches, keys = rows["sketch"], rows["key"].to_numpy()
    out_a, out_b = [], []
    for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        found = sketches.slice(start, end - start).to_pylist()
        words = min(map(len, found)) // 8
        bits = np.stack([folded(np.frombuffer(s, np.uint64), words) for s in found])
        first_keys = [set(k) for k in rows["first_keys"].slice(start, end - start).to_pylist()]
        key = keys[start]
        left = start + np.flatnonzero(block[start:end] == low[start])
        right = start + np.flatnonzero(block[start:end] == high[start])
        for at in range(0, len(left), 64):
            some = left[at : at + 64, None]
            apart = np.bitwise_count(bits[some[:, 0] - start][:, None] ^ bits[right - start]).sum(axis=2)
            fits = (
                (component[some] != component[right])
                & (apart <= most_different(n[some].astype(np.int64), n[right]))
                & (np.minimum(n[some], n[right]) * 100 >= np.maximum(n[some], n[right]) * PERCENT)
            )
            if low[start] == high[start]:
                fits &= some < right
            i, j = np.nonzero(fits)
            pairs = [
                (x, y)
                for x, y in zip(some[i, 0].tolist(), right[j].tolist(), strict=True)
                if not any(k < key for k in first_keys[x - start] & first_keys[y - start])
            ]
            if pairs:
                one, other = (ids[list(side)] for side in zip(*pairs, strict=True))
                out_a.append(np.minimum(one, other))
                out_b.append(np.maximum(one, other))
    if out_a:
        columns = [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))]
        yield pa.record_batch(columns, ["a", "b"])


def _open_groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members of groups that hold several components so far, with these."""
    found = written(components(links), "components")
    members = join_measured(members.select("key", "id", "n"), found, ["id"]).withColumn(
        "component", F.coalesce("component", "id")
    )
    # In a group of two, both have been compared already.
    sizes = (
        members.groupBy("key")
        .agg(
            F.count("*").alias("size"),
            F.min("component").alias("least"),
            F.max("component").alias("most"),
        )
        .where("size > 2 and least < most")
        .select("key", "size")
    )
    return written(members.join(sizes, "key"), "open")


def _more_stars(open_groups: DataFrame) -> DataFrame:
    """Pairs (a, b) of one member of each group and those that aren't in its component.

    In groups of the same members, which near copies have by the hundred, the one is
    another in every 32 groups.
    """
    place = F.xxhash64("id", F.col("key").bitwiseAND(F.lit(31)), F.lit(1))
    one = F.min(F.struct(place.alias("place"), "id", "n", "component"))
    centers = open_groups.groupBy("key").agg(one.alias("one"))
    return (
        open_groups.join(centers, "key")
        .withColumn("n_one", F.col("one.n"))
        .where("component <> one.component")
        .where(_sizes_fit("n", "n_one"))
        .select(F.least("id", "one.id").alias("a"), F.greatest("id", "one.id").alias("b"))
        .distinct()
    )


def classes_of(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, n_shingles, root, component_id): one row per distinct text."""
    whole = F.make_valid_utf8(text_of(docs, text))
    classes = docs.select(F.xxhash64(whole).alias("id"), whole.alias("text"))
    given = give(classes, common_keys(classes)).repartition("key")
    order = F.xxhash64("id", F.col("key").bitwiseAND(F.lit(3)))
    grouped = written(
        given.sortWithinPartitions("key", order, "id").mapInArrow(
            _group, "key long, id long, n int, first long, first_n int, sketch binary"
        ),
        "groups",
    )
    sketches = grouped.where("sketch is not null").select("id", "n", "sketch")
    members = grouped.where("sketch is null").drop("sketch")
    stars = (
        members.where("id <> first")
        .where(_sizes_fit("n", "first_n"))
        .select(F.least("id", "first").alias("a"), F.greatest("id", "first").alias("b"))
        .distinct()
    )
    links = _linked(stars, sketches, classes)
    open_groups = _open_groups(members, links)
    links = links.union(_linked(_more_stars(open_groups), sketches, classes))
    open_groups = _open_groups(open_groups, links)
    pairs = _blocks(open_groups, sketches).distinct()
    links = links.union(_linked(pairs, sketches, classes))
    found = written(components(links), "components")
    ids = docs.select(F.xxhash64(whole).alias("id"), docs[doc_id].alias("doc_id"))
    least = ids.groupBy("id").agg(F.min("doc_id").alias("least"))
    rows = written(
        join_measured(least.join(sketches.select("id", "n"), "id"), found, ["id"]).select(
            "id",
            F.col("n").cast("long").alias("n_shingles"),
            F.coalesce("component", "id").alias("root"),
            "least",
        ),
        "classes",
    )
    roots = rows.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(rows.drop("least").join(roots, "root"), "class_components")


def link_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, n_shingles, root, component_id) for every document."""
    whole = F.make_valid_utf8(text_of(docs, text))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(whole).alias("id")
    )
    # The empty set links with nothing, not even with another empty one.
    alone = F.when(F.col("n_shingles") == 0, F.col("row")[doc_id]).otherwise(F.col("component_id"))
    return (
        join_measured(rows, classes_of(docs, text, doc_id), ["id"])
        .withColumn("component_id", alone)
        .drop("id")
    )


def keep_one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without those that are similar to one of a lesser id."""
    linked = link_documents(docs, text, doc_id)
    empty = F.col("n_shingles") == 0
    first = linked.where(empty | F.col("row")[doc_id].eqNullSafe(F.col("component_id")))
    # Repeated or null ids leave several first documents; only then one has to be picked.
    several = first.where(~empty).groupBy("root").count().where("count > 1")
    if several.isEmpty():
        return first.select("row.*")
    picked = first.where(~empty).dropDuplicates(["root"])
    return first.where(empty).union(picked).select("row.*")
