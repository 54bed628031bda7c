"""Pack tokenised documents into sequences of bounded length.

Documents are cut into pieces of at most ``capacity`` tokens. Only the histogram of piece lengths
(at most ``capacity`` numbers) goes to the driver, which plans how many sequences of which lengths
there are: going from the longest, a gap is filled exactly by one length, a pair or a triple that
is still available, as often as the counts allow; where none fits exactly, the longest piece that
fits goes in (best fit) and the smaller gap is tried again. The plan is a list of runs (length,
first rank, sequences); a piece finds its place from its rank among the pieces of its length. Ranks
are numbered in buckets, with the buckets' counts summed up, so a common length isn't one task.

Defined cases: a null or empty text is one piece, the end id alone. Repeated documents are packed
as often as they occur; pieces that are equal in every column may change places. An empty table
gives no pieces. Ids are whole numbers, or text that is one; other text raises, as a cast does, and
a null id stays null. Other columns aren't read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import encoders
from starloom.llm.common import text_of, written

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The pieces of every document: (doc_id, piece, start, length, ids_crc32)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoders.counter(tokenizer)
        for batch in batches:
            keys, numbers, starts, lengths, sums = [], [], [], [], []
            ids_of = encoder.encode_all(batch.column("text").to_pylist())
            for key, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    piece = ids[start : start + capacity]
                    keys.append(key)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
            yield pa.record_batch(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    *(pa.array(values, pa.int64()) for values in (starts, lengths, sums)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    key = docs[doc_id].cast("long").alias("doc_id")
    whole = F.make_valid_utf8(text_of(docs, text)).alias("text")
    return docs.select(key, whole).mapInArrow(pieces, PIECES)


def _pair(free: np.ndarray, total: int) -> tuple[int, ...] | None:
    """Two available lengths with this sum, the longest first."""
    if total < 2:
        return None
    both = free[1:total] & free[total - 1 : 0 : -1]
    for high in np.flatnonzero(both)[::-1][:1] + 1:
        return int(high), total - int(high)
    return None


def _exact(counts: np.ndarray, gap: int) -> tuple[tuple[int, ...], int] | None:
    """One to three lengths that fill the gap, and how often their counts allow it."""
    free = counts[: gap + 1] > 0
    left = np.flatnonzero(free)
    if not len(left) or 3 * left[-1] < gap:
        return None

    def often(lengths: tuple[int, ...]) -> int:
        return min(int(counts[x]) // lengths.count(x) for x in lengths)

    if free[gap]:
        return (gap,), int(counts[gap])
    # A length that is left once can't be used twice.
    found = _pair(free, gap)
    if found and not often(found):
        single = free.copy()
        single[found[0]] = False
        found = _pair(single, gap)
    if found:
        return found, often(found)
    for first in np.flatnonzero(free[: gap - 1])[::-1]:
        rest = _pair(free, gap - int(first))
        if rest and often((int(first), *rest)):
            lengths = (int(first), *rest)
            return lengths, often(lengths)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(lengths with their numbers, sequences of this kind), using up the histogram."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    kinds = []
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            # No more sequences are opened at once than this length needs by itself, so that
            # the rest of it is there to fill gaps with.
            n = max(1, int(counts[longest]) // (capacity // longest))
            counts[longest] -= n
            open_kinds = [({longest: 1}, capacity - longest, n)]
            while open_kinds:
                _fill(*open_kinds.pop(), counts, open_kinds, kinds)
    return kinds


def _fill(lengths, gap, n, counts, open_kinds, kinds) -> None:
    """Fill the gap of ``n`` open sequences exactly where counts allow, the rest by best fit."""
    while n:
        found = _exact(counts, gap) if gap else ((), n)
        if not found:
            break
        add, times = found[0], min(found[1], n)
        for x in add:
            counts[x] -= times
        kinds.append((_with(lengths, add), times))
        n -= times
    if not n:
        return
    fits = np.flatnonzero(counts[: gap + 1])
    if not len(fits):
        kinds.append((lengths, n))
        return
    x = int(fits[-1])
    times = min(n, int(counts[x]))
    counts[x] -= times
    if n > times:
        open_kinds.append((lengths, gap, n - times))
    open_kinds.append((_with(lengths, (x,)), gap - x, times))


def _with(lengths: dict[int, int], add: tuple[int, ...]) -> dict[int, int]:
    out = dict(lengths)
    for x in add:
        out[x] = out.get(x, 0) + 1
    return out


def _runs(kinds: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """(length, first rank, first sequence, pieces per sequence, offset), sorted."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for lengths, n in kinds:
        offset = 0
        for length, each in lengths.items():
            first = used.get(length, 0)
            runs.append((length, first, sequence, each, offset))
            used[length] = first + n * each
            offset += length * each
        sequence += n
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, largest: int) -> DataFrame:
    """The pieces with ``rank``, from 0, among those of their length."""
    buckets = max(1, -(-largest // BUCKET_ROWS))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    dealt = pieces.withColumn("bucket", spread)
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "bucket")
        .count()
        .select(
            "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
        )
    )
    order = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    return (
        dealt.withColumn("number", F.row_number().over(order))
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", (F.col("before") + F.col("number") - 1).cast("long"))
        .drop("bucket", "before", "number")
    )


def place(pieces: DataFrame, runs: np.ndarray) -> DataFrame:
    """Ranked pieces with ``sequence_id`` and ``offset``."""
    shared = pieces.sparkSession.sparkContext.broadcast(runs)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, each, offset = shared.value.T
        keys = (length << 40) + first
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (size << 40) + rank, "right") - 1
            turn, slot = np.divmod(rank - first[at], each[at])
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(sequence[at] + turn),
                    pa.array(offset[at] + slot * size),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return pieces.mapInArrow(look_up, f"{PIECES}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    pieces = written(cut(docs, tokenizer, capacity, text, doc_id), "pieces")
    # At most ``capacity`` rows, whatever the number of documents.
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    runs = _runs(plan(histogram, capacity))
    return place(ranked(pieces, max(histogram.values(), default=0)), runs)
