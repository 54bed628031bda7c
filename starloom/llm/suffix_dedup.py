"""Remove repeated byte strings: whatever a string of ``LENGTH`` bytes covers that occurs twice.

1. Texts are read as UTF-8. In every window of ``LENGTH`` bytes the ``GRAM``-byte string of least
   hash is the window's anchor (ties: the first), so equal windows have equal anchors at equal
   places. Anchors come together by hash, and those found once are dropped.
2. An anchor that is left gives its context, the bytes of all windows it is the anchor of. Equal
   contexts are counted (summed before the shuffle); contexts of one anchor come together.
3. Contexts of anchors with several of them are put into batches. A batch's Burrows-Wheeler
   transform is extended backward, breadth first: a border between suffixes that differ after l
   bytes gives, for each byte ahead of it, a border of suffixes that differ after l + 1. Borders
   come up by increasing common prefix, and the search stops at ``LENGTH``: suffixes with no
   border between them share that much, and their windows are repeats.
4. An anchor with more than ``MAX_CONTEXTS`` contexts is split until its groups are small. A window
   has some p bytes ahead of the anchor and the rest behind: either more than half of what it can
   have ahead, and then its context goes to those with the same bytes there, or as much behind,
   and then to those with the same bytes there. A context goes both ways, contexts that share a
   window meet in one of them, and the next split halves the choice of p again. A group for one p
   only is one window, which is repeated if several contexts have it.

A context that occurs in two places is a repeat as it stands, as is a text that occurs twice.
Texts are stood for by 64-bit hashes, contexts too (with the anchor's). Defined cases: null and
empty texts, and those shorter than ``LENGTH``, lose nothing; overlapping occurrences count, in
one text as well; repeated documents lose all from ``LENGTH`` bytes on. Rows keep all their
columns in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, text_of, written

LENGTH = 200
GRAM = 32
MAX_CONTEXTS = 500
BATCH_BYTES = 1 << 17
CHUNK = 1 << 22
FLUSH_ROWS = 50_000
HELD_ROWS = 1_000_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_PLACE = np.uint64((1 << 24) - 1)


def _gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    x = words[:n] * _ODD[0]
    for k in range(1, GRAM // 8):
        x += words[8 * k : 8 * k + n] * _ODD[k]
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(hash, first window, last window, place) of each anchor, in order.

    Very long texts are read in chunks that overlap, so that a place fits into 24 bits.
    """
    parts = [_anchors(data[at : at + CHUNK + length - 1], length, at) for at in range(0, max(1, len(data) - length + 1), CHUNK)]
    return tuple(np.concatenate(columns) for columns in zip(*parts, strict=True))


def _anchors(data: bytes, length: int, at: int) -> tuple[np.ndarray, ...]:
    if len(data) < length:
        return (np.zeros(0, dtype=np.uint64), *(np.zeros(0, dtype=np.int64),) * 3)
    hashes = _gram_hashes(data)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, length - GRAM + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & _PLACE).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    ends = np.concatenate([starts[1:], [len(place)]]) - 1
    return hashes[place[starts]], starts + at, ends + at, place[starts] + at


def _bytes_of(batch: pa.RecordBatch, seen: set[int]) -> Iterator[tuple[int, int, bytes]]:
    """(row, id, bytes) of each text that this task hasn't met yet."""
    texts = batch.column("text")
    for i, key in enumerate(batch.column("id").to_pylist()):
        if key not in seen:
            seen.add(key)
            yield i, key, texts[i].as_py().encode()


def anchor_rows(classes: DataFrame, length: int) -> DataFrame:
    """(anchor, id, place, met) of every anchor of every text; the place is its first window's.

    ``met`` is 0 for an anchor that the task found once among ``HELD_ROWS`` or so, else 1 for the
    first of its places and 2 for the others.
    """

    def record(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        found, ids, places = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(found, kind="stable")
        again = found[order[1:]] == found[order[:-1]]
        met = np.zeros(len(found), dtype=np.int8)
        met[order[:-1][again]] = 1
        met[order[1:][again]] = 2
        columns = [pa.array(c) for c in (found, ids, places.astype(np.int32), met)]
        return pa.record_batch(columns, ["anchor", "id", "place", "met"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, key, data in _bytes_of(batch, seen):
                hashes, first, _, _ = anchors(data, length)
                held.append((hashes.view(np.int64), np.full(len(first), key, dtype=np.int64), first))
                size += len(first)
                if size > HELD_ROWS:
                    yield record(held)
                    held, size = [], 0
        if held:
            yield record(held)

    return classes.mapInArrow(run, "anchor long, id long, place int, met byte")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """Of (anchor, id, place, met) the places of anchors in several of them.

    The places of an anchor come together in one shuffle; of those that a task knows to be
    repeated only one a task goes there, so that an anchor of very many texts is no large group.
    """
    known = F.col("met") == 2
    together = Window.partitionBy("key")

    def differ(column: str) -> Column:
        return F.min(column).over(together) != F.max(column).over(together)

    # A copy of a text that another task met has the same id and place.
    several = known | (F.max("met").over(together) > 0) | differ("id") | differ("place")
    return (
        rows.select(F.when(known, F.col("id")).otherwise(F.col("anchor")).alias("key"), "id", "place", "met")
        .select("id", "place", several.alias("several"))
        .where("several")
        .select("id", "place")
    )


def contexts(classes: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(anchor, code, id, start, context, ahead) of each repeated anchor.

    ``code`` is the context's hash and ``ahead`` the number of its bytes ahead of the anchor.
    """
    per_text = written(
        places.groupBy("id").agg(F.sort_array(F.collect_set("place")).alias("places")), "places"
    )
    texts = join_measured(classes, per_text, ["id"], "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            wanted = batch.column("places")
            out: list[list] = [[], [], [], [], [], []]
            for i, key, data in _bytes_of(batch, seen):
                hashes, first, last, place = anchors(data, length)
                at = np.flatnonzero(np.isin(first, wanted[i].values.to_numpy()))
                cut = [data[a : b + length] for a, b in zip(first[at].tolist(), last[at].tolist(), strict=True)]
                out[0] += hashes[at].view(np.int64).tolist()
                out[1] += [xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in cut]
                out[2] += [key] * len(cut)
                out[3] += first[at].tolist()
                out[4] += cut
                out[5] += (place - first)[at].tolist()
                if len(cut) and len(out[0]) > FLUSH_ROWS:
                    yield _record(out)
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _record(out)

    def _record(out: list[list]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in out[:4]]
        columns += [pa.array(out[4], pa.binary()), pa.array(out[5], pa.int32())]
        return pa.record_batch(columns, ["anchor", "code", "id", "start", "context", "ahead"])

    return texts.select("id", "text", "places").mapInArrow(
        run, "anchor long, code long, id long, start long, context binary, ahead int"
    )


def suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """The places in the order of the ``length`` (or more) bytes from each on.

    Sorted by 8 bytes first, then by twice as many, and so on; places that are alone in
    their order stay where they are.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).tobytes()
    words = np.ndarray((n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(words, kind="stable")
    in_order = words[order]
    # The rank of a place is where its equals begin; the slots of those that have any.
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
    width = 8
    while width < length:
        alone = new & np.concatenate([new[1:], [True]])
        slots, new = slots[~alone], new[~alone]
        if not len(slots):
            break
        places = order[slots]
        after = places + width
        key = rank[places] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[slots], key = places[by], key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        width *= 2
    return order


def prefix_borders(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of each suffix and the one before it is under ``length``.

    By breadth-first backward extension on the Burrows-Wheeler transform, value by value. Of a
    border only the block ahead of it is read, the suffixes that share what lies before the border:
    each letter of their transform gives a block again, and its end is a border if it wasn't one.
    """
    n = len(text)
    last = text[order - 1]
    by = np.argsort(last, kind="stable").astype(np.int32)
    slots = np.arange(n, dtype=np.int32)
    extended = np.empty(n, dtype=np.int32)
    extended[by] = slots
    # The places of the same letter before and after each of the transform.
    same = last[by[1:]] == last[by[:-1]]
    before, after = np.full(n, -1, dtype=np.int32), np.full(n, n, dtype=np.int32)
    before[by[1:][same]] = by[:-1][same]
    after[by[:-1][same]] = by[1:][same]
    # Suffixes with different first letters have nothing in common.
    ends = np.append(np.flatnonzero(~same) + 1, n).astype(np.int32)
    begins = np.append(0, ends[:-1]).astype(np.int32)
    border = np.zeros(n + 1, dtype=bool)
    border[begins] = border[n] = True
    for _ in range(1, length):
        if not len(ends):
            break
        sizes = ends - begins
        past = np.cumsum(sizes, dtype=np.int32)
        block = slots[: past[-1]] + np.repeat(begins - past + sizes, sizes)
        first = extended[block[before[block] < np.repeat(begins, sizes)]]
        end = extended[block[after[block] >= np.repeat(ends, sizes)]] + 1
        # The blocks have no suffix in common, so that their order puts firsts and ends in pairs.
        first.sort()
        end.sort()
        new = ~border[end]
        begins, ends = first[new], end[new]
        border[ends] = True
    return border[:n]


def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """The starts in each string of windows that occur more than once in all of them."""
    # 0xFF is no byte of UTF-8 text and ends every string.
    whole = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8)
    order = suffixes(whole, length)
    border = prefix_borders(whole, order, length)
    ends = np.cumsum([len(s) + 1 for s in strings])
    starts = ends - [len(s) + 1 for s in strings]
    # Suffixes share their window if there is no border between them; only whole windows count.
    owner = np.repeat(np.arange(len(strings)), ends - starts)
    fits = np.arange(len(whole)) + length < ends[owner]
    block = np.cumsum(border)
    valid = fits[order]
    many = np.bincount(block[valid], minlength=block[-1] + 1)[block] > 1
    hit = np.sort(order[valid & many])
    return [
        hit[lo:hi] - start
        for lo, hi, start in zip(
            np.searchsorted(hit, starts), np.searchsorted(hit, ends), starts, strict=True
        )
    ]


_SPAN = "anchor long, code long, lo int, hi int"


def expand(groups: DataFrame, length: int) -> DataFrame:
    """(anchor, code, lo, hi): repeated spans of each context found once that its group shows.

    Reads (key, anchor, code, context, n) sorted by key, the group.
    """
    names = ["anchor", "code", "lo", "hi"]

    def spans(group: list[tuple], hits: list[np.ndarray], out: list[list]) -> None:
        for (_, anchor, code, _, n), hit in zip(group, hits, strict=True):
            if n == 1 and len(hit):
                gaps = np.flatnonzero(np.diff(hit) > length) + 1
                for part in np.split(hit, gaps):
                    out.append([anchor, code, int(part[0]), int(part[-1]) + length])

    def record(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.record_batch(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        held: set[tuple] = set()
        size = 0
        out: list[list] = []

        def close(group: list[tuple]) -> None:
            nonlocal waiting, size
            own = {row[1:3] for row in group}
            # A context may be in several groups, and must not be compared with itself.
            if not held.isdisjoint(own):
                settle()
            # One context: no other text has this anchor in other surroundings.
            if len(group) > 1:
                waiting += group
                held.update(own)
                size += sum(len(row[3]) for row in group)
                if size >= BATCH_BYTES:
                    settle()

        def settle() -> None:
            nonlocal waiting, size
            if waiting:
                hits = repeated_windows([row[3] for row in waiting], length)
                spans(waiting, hits, out)
            waiting, size = [], 0
            held.clear()

        group: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "anchor", "code", "context", "n")]
            for row in zip(*columns, strict=True):
                if group and row[0] != group[0][0]:
                    close(group)
                    group = []
                group.append(row)
                if len(out) > FLUSH_ROWS:
                    yield record(out)
                    out.clear()
        if group:
            close(group)
        settle()
        if out:
            yield record(out)

    return groups.mapInArrow(run, _SPAN)


def _in_halves(groups: DataFrame, length: int) -> DataFrame:
    """Each row of a group once for every half of the places its window may have.

    ``least`` and ``most`` are the bytes that a shared window may have ahead of the anchor. All
    rows of a group agree in the ``least`` bytes ahead, and in what is behind of a window with
    ``most`` ahead.
    """
    middle = F.floor((F.col("least") + F.col("most")) / 2).cast("int")
    room = length - GRAM
    ahead, behind = middle + 1, room - middle
    context, at = F.col("context"), F.col("ahead")
    of_ahead = F.substring(context, at - ahead + 1, ahead)
    of_behind = F.substring(context, at + GRAM + 1, behind)

    def half(side: int, fits: Column, shared: Column, least: Column, most: Column) -> Column:
        key = F.xxhash64("key", F.lit(side), shared)
        return F.when(fits, F.struct(key.alias("key"), least.alias("least"), most.alias("most")))

    halves = F.array_compact(
        F.array(
            half(0, at >= ahead, of_ahead, ahead, F.col("most")),
            half(1, F.octet_length(context) - at - GRAM >= behind, of_behind, F.col("least"), middle),
        )
    )
    rest = [c for c in groups.columns if c not in ("key", "least", "most")]
    return groups.select(*rest, F.explode(halves).alias("half")).select(*rest, "half.*")


def shared_spans(counted: DataFrame, length: int) -> DataFrame:
    """(anchor, code, lo, hi) of each context, from (anchor, code, context, ahead, n)."""
    zero, room = F.lit(0), F.lit(length - GRAM)
    groups = counted.withColumns({"key": F.col("anchor"), "least": zero, "most": room})
    whole = counted.where("n > 1").select("anchor", "code", zero.alias("lo"), F.octet_length("context").alias("hi"))
    found = [written(whole, "whole")]
    while True:
        sizes = groups.groupBy("key").agg(F.count("*").alias("size"))
        large = written(sizes.where(F.col("size") > MAX_CONTEXTS).select("key"), "large")
        none = large.isEmpty()
        small = groups if none else join_measured(groups, large, ["key"], "left_anti")
        dealt = small.select("key", "anchor", "code", "context", "n").repartition("key")
        found.append(written(expand(dealt.sortWithinPartitions("key"), length), "found"))
        if none:
            break
        halved = _in_halves(join_measured(groups, large, ["key"], "left_semi"), length)
        one = F.col("least") == F.col("most")
        # One place is left: the rows of a key have the same window.
        alone = halved.where(one)
        twice = alone.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
        start = F.col("ahead") - F.col("least")
        found.append(
            written(
                join_measured(alone, written(twice, "twice"), ["key"], "left_semi").select(
                    "anchor", "code", start.alias("lo"), (start + length).alias("hi")
                ),
                "windows",
            )
        )
        groups = written(halved.where(~one), "halves")
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    return spans


def repeated_spans(docs: DataFrame, text: str, length: int = LENGTH) -> DataFrame:
    """(id, spans) of each distinct text with repeats; its spans may overlap."""
    whole = F.make_valid_utf8(text_of(docs, text))
    long = docs.where(F.octet_length(whole) >= length)
    classes = long.select(F.xxhash64(whole).alias("id"), whole.alias("text"))
    places = repeated_anchors(anchor_rows(classes, length))
    cut = written(contexts(classes, places, length), "contexts")
    # A context is in several places if its least and its largest place differ. (A copy of a
    # text that another task met has given the same rows again, so they can't be counted.)
    several = (F.col("id_low") != F.col("id_high")) | (F.col("low") != F.col("high"))
    counted = (
        cut.groupBy("anchor", "code", "context")
        .agg(
            F.min("id").alias("id_low"),
            F.max("id").alias("id_high"),
            F.min("start").alias("low"),
            F.max("start").alias("high"),
            F.first("ahead").alias("ahead"),
        )
        .select("anchor", "code", "context", "ahead", F.when(several, 2).otherwise(1).alias("n"))
    )
    spans = shared_spans(written(counted, "counted"), length)
    placed = cut.select("anchor", "code", "id", "start").join(spans, ["anchor", "code"])
    span = F.struct(
        (F.col("start") + F.col("lo")).alias("from"), (F.col("start") + F.col("hi")).alias("to")
    )
    return placed.groupBy("id").agg(F.collect_set(span).alias("spans"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that meet or overlap as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[new], ends[np.concatenate([new[1:] - 1, [len(starts) - 1]])]


_RUNS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _runs(spans: pa.Array) -> pa.Array:
    """The maximal runs of each text's spans."""
    out = []
    for found in spans:
        ends = merged(*(found.values.field(c).to_numpy() for c in ("from", "to")))
        out.append([{"from": a, "to": b} for a, b in zip(*(e.tolist() for e in ends), strict=True)])
    return pa.array(out, _RUNS)


def _without(texts: pa.Array, runs: pa.Array) -> pa.Array:
    """Each text's bytes without its runs."""
    out = []
    for whole, removed in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
        data, kept, at = whole.encode(), [], 0
        for run in removed or []:
            kept.append(data[at : run["from"]])
            at = run["to"]
        out.append(b"".join([*kept, data[at:]]))
    return pa.array(out, pa.binary())


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(row, n_bytes, spans, kept) for every document; ``spans`` are maximal removed runs."""
    whole = F.make_valid_utf8(text_of(docs, text))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.xxhash64(whole).alias("id"),
        whole.alias("text"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
    )
    copies = (
        rows.where(F.col("n_bytes") >= length)
        .groupBy("id")
        .agg(F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes"))
        .where("n > 1")
    )
    entire = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n_bytes").alias("to")))
    spans = repeated_spans(docs, text, length).union(copies.select("id", entire.alias("spans")))
    kind = "array<struct<from:bigint,to:bigint>>"
    # Runs are few where spans are many: the documents meet as little as possible.
    removed = written(
        spans.groupBy("id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
        .select("id", F.arrow_udf(_runs, kind)("spans").alias("spans")),
        "removed",
    )
    joined = join_measured(rows, removed, ["id"])
    return joined.select(
        "row",
        "n_bytes",
        F.coalesce("spans", F.array().cast(kind)).alias("spans"),
        F.arrow_udf(_without, "binary")("text", "spans").alias("kept"),
    )
