"""Collocations: phrases of two to four words that occur together more than their parts suggest.

1. Texts are cut into pieces at punctuation and line ends, and pieces into words. Each task puts
   the words of its documents, as numbers, into shards of some ``SHARD_WORDS`` words; a shard
   becomes an FM-index: the Burrows-Wheeler transform of its word numbers, sorted by the
   ``LONGEST`` words that a phrase has at most, and the number of each word's occurrences. Shards
   are a written table.
2. Phrases are counted by extending the transform's intervals one word at a time. The interval of
   a phrase w holds all its occurrences; the words before them, one map of the interval's rows, are
   the intervals of all c w (left extensions). An extension also lies in the interval of the words
   it begins with, whose right extension it is. Only phrases whose two parts of one word less are
   extended too are kept. Words and pairs are counted when a shard is made, then triples of frequent
   pairs, then phrases of four of frequent triples: a shard gives their 64-bit hashes and counts,
   sorted and packed, a piece to each range of hashes; the counts of a range are summed over all
   shards, and each shard gets back a bit for every hash, set if it is frequent in the whole corpus.
   One shard of those that have a frequent phrase gets its sum, too, and at last spells it out.
3. The frequent phrases, at least ``MIN_COUNT`` occurrences each, are scored: for each cut into a
   first part and the rest, with l and r occurrences, floor(SCALE a / (l + r)); the lowest cut
   counts. Phrases inside a longer one that has 80 percent of their occurrences are dropped. The
   first ``TOP`` of each language are returned.

All counts are over whole texts and all documents. A phrase has one count a shard, so none has a
great share of what is shuffled, and there are as many ranges of hashes as keep one small; a shard
gets back a bit a phrase. Defined cases: null and empty texts have no words; a null language is ``und``, like
a language of that name; ids aren't read, so every row counts, repeated ones too; an empty table
gives no rows. Ties of score and count are ranked by the phrase's bytes. A document longer than a
shard makes a larger shard. Other columns aren't read, whatever their names. Among 10^10 different
phrases two or three pairs may share a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, text_of, written
from starloom.llm.jaccard_join import mixed

LONGEST = 4
MIN_COUNT = 30
SCALE = 2_000_000
COVER_PERCENT = 80
TOP = 2000
SHARD_WORDS = 2_000_000
# Rows of one Arrow batch that a shard's counts are returned in.
ROWS = 200_000
BUCKETS = 64
# Bytes of text for one range of hashes: some hundred thousand phrases.
RANGE_BYTES = 6 << 20

_CODEC = "zstd"
_BREAK = b"\n"
# Ends of pieces become one mark, tabs blanks, capitals small letters.
_PLAIN = bytes.maketrans(
    b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz",
)


class Numbers(dict):
    """Words to numbers in the order they are met; 0 is the end of a piece, -1 nothing."""

    def __init__(self):
        super().__init__({b"": -1, _BREAK: 0})
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = len(self.words)
        return len(self.words)


def numbered(text: bytes, numbers: Numbers) -> np.ndarray:
    """Numbers of a text's words, with 0 before each piece."""
    found = text.translate(_PLAIN).replace(_BREAK, b" \n ").split(b" ")
    out = np.empty(len(found) + 1, dtype=np.int32)
    out[0] = 0
    out[1:] = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
    return out[out >= 0]


def transform(words: np.ndarray) -> np.ndarray:
    """The word before each suffix, suffixes sorted by their first ``LONGEST`` words."""
    n = len(words)
    rank, width = words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < LONGEST:
        # Rank of the words from width on; what is beyond the end comes first.
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        pair = rank * (int(rank.max()) + 2) + after
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        width *= 2
    return words[order - 1]


def squeezed(values: np.ndarray) -> bytes:
    """Small numbers in few bytes: their high bytes, which are mostly 0, lie side by side."""
    planes = values.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return packed(np.ascontiguousarray(planes).tobytes())


def restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpacked(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec=_CODEC, asbytes=True)


class Index:
    """An FM-index: ``bwt`` in the order of the suffixes, ``starts`` of each word's interval."""

    def __init__(self, bwt: np.ndarray, words: int):
        self.bwt = bwt
        counts = np.bincount(bwt, minlength=words + 1)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        # Where each row's suffix, with the word before it, is in the order.
        order = np.argsort(bwt, kind="stable")
        self.before = np.empty(len(bwt), dtype=np.int32)
        self.before[order] = np.arange(len(bwt), dtype=np.int32)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, counts, words): the intervals of single words; without the ends of pieces."""
        counts = np.diff(self.starts)[1:]
        there = np.flatnonzero(counts)
        return self.starts[1:-1][there], counts[there], (there + 1)[:, None]

    def extended(
        self, starts: np.ndarray, counts: np.ndarray, words: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of one word more, of which both parts are among those given."""
        inside = np.full(len(self.bwt), -1, dtype=np.int32)
        rows = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        rows = rows + np.arange(len(rows))
        inside[rows] = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
        # Left: the rows of each interval go to the intervals of the words before them.
        rest = np.full(len(self.bwt), -1, dtype=np.int32)
        rest[self.before[rows]] = inside[rows]
        rest[: self.starts[1]] = -1
        # Right: they lie in the interval of the words that they begin with.
        rest[inside < 0] = -1
        there = np.flatnonzero(rest >= 0)
        if not len(there):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, words.shape[1] + 1), np.int64)
        rests, firsts = rest[there], inside[there]
        new = (rests[1:] != rests[:-1]) | (firsts[1:] != firsts[:-1]) | (there[1:] != there[:-1] + 1)
        at = np.concatenate([[0], np.flatnonzero(new) + 1])
        counted = np.diff(np.concatenate([at, [len(there)]]))
        grown = np.column_stack([words[firsts[at], 0], words[rests[at]]])
        return there[at], counted, grown


def packed_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as their differences, and counts; both are mostly small numbers."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return packed(np.ascontiguousarray(steps).tobytes()), squeezed(counts)


def unpacked_counts(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(unpacked(keys), np.uint8).reshape(8, -1)
    steps = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), restored(counts)


def hashes(found: tuple, lang: str, words: list[bytes], of_words: dict[int, int]) -> np.ndarray:
    """64-bit hashes of phrases; ``of_words`` keeps those of the shard's words."""
    prefix, used = lang.encode() + b"\n", np.unique(found[2])
    for number in used.tolist():
        if number not in of_words:
            of_words[number] = xxhash.xxh64_intdigest(prefix + words[number - 1])
    table = np.zeros(len(words) + 1, dtype=np.uint64)
    table[used] = np.fromiter(map(of_words.__getitem__, used.tolist()), np.uint64, len(used))
    keys = np.zeros(len(found[0]), dtype=np.uint64)
    for column in found[2].T:
        keys = mixed(keys + table[column])
    return keys


_PIECE = ["shard", "lang", "n", "words", "bwt", "range", "keys", "counts"]
_PIECE_KINDS = dict(
    zip(
        _PIECE,
        [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()],
        strict=True,
    )
)
_PIECE_DDL = (
    "shard long, lang string, n long, words binary, bwt binary, range int, keys binary, counts binary"
)


def _record(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([row.get(c) for row in rows], kind) for c, kind in _PIECE_KINDS.items()]
    return pa.record_batch(columns, _PIECE)


def pieces(shard: int, keys: np.ndarray, counts: np.ndarray, ranges: int) -> list[dict]:
    """A row of packed keys and counts for each range of hashes."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    of = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    starts = np.flatnonzero(np.diff(of, prepend=of[:1] + np.uint64(1))) if len(of) else []
    out = []
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        own_keys, own_counts = packed_counts(keys[a:b], counts[a:b])
        out.append({"shard": shard, "range": int(of[a]), "keys": own_keys, "counts": own_counts})
    return out


def indexed(docs: DataFrame, text: str, lang: str, ranges: int) -> DataFrame:
    """A written table of shards (words, transform) and, in rows with a range, of their counts."""

    def shard_rows(shard: int, lang: str, numbers: Numbers, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(held)
        # The most frequent words get the least numbers.
        counts = np.bincount(found, minlength=len(numbers.words) + 1)
        order = np.argsort(-counts[1:], kind="stable")
        renumbered = np.zeros(len(counts), dtype=np.int32)
        renumbered[order + 1] = np.arange(1, len(counts), dtype=np.int32)
        bwt = transform(renumbered[found])
        words = [numbers.words[i] for i in order.tolist()]
        # Words hold neither blanks nor line ends.
        row = {"shard": shard, "lang": lang, "n": int(counts[1:].sum())}
        yield _record([row | {"words": packed(b"\n".join(words)), "bwt": squeezed(bwt)}])
        index = Index(bwt, len(words))
        keys, counts = _short(index, lang, words)[:2]
        if len(keys):
            yield _record(pieces(shard, keys, counts, ranges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shards are numbered by task, so a task that runs again gives the same ones.
        shard = TaskContext.get().partitionId() << 32
        open_shards: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(
                batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                numbers, words = open_shards.setdefault(lang, (Numbers(), []))
                words.append(numbered(text, numbers))
                held += len(words[-1])
                if held >= SHARD_WORDS:
                    for name, (numbers, words) in open_shards.items():
                        yield from shard_rows(shard, name, numbers, words)
                        shard += 1
                    open_shards, held = {}, 0
        for name, (numbers, words) in open_shards.items():
            yield from shard_rows(shard, name, numbers, words)
            shard += 1

    rows = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"),
        F.make_valid_utf8(text_of(docs, text)).cast("binary").alias("text"),
    )
    return written(rows.mapInArrow(run, _PIECE_DDL), "shards")


def _short(index: Index, lang: str, words: list[bytes]):
    """(hashes, counts, words and pairs, hashes of words) of a shard, words before pairs."""
    of_words: dict[int, int] = {}
    one = index.words()
    two = index.extended(*one)
    keys = [hashes(found, lang, words, of_words) for found in (one, two)]
    return np.concatenate(keys), np.concatenate([one[1], two[1]]), (one, two), of_words


def _opened(batch: pa.RecordBatch, i: int) -> tuple[int, list[bytes], Index, str]:
    words = unpacked(batch.column("words")[i].as_py()).split(b"\n")
    index = Index(restored(batch.column("bwt")[i].as_py()), len(words))
    return batch.column("shard")[i].as_py(), words, index, batch.column("lang")[i].as_py()


def _told(batch: pa.RecordBatch, i: int, name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of a shard's phrases are frequent, and the sums of those it is to spell out, else 0."""
    found = sorted(batch.column(name)[i].as_py() or [], key=lambda row: row["range"])
    order = np.argsort(keys, kind="stable")
    often, sums = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    at = 0
    for row in found:
        mine = order[at : at + row["n"]]
        often[mine] = np.unpackbits(np.frombuffer(row["often"], np.uint8), count=row["n"])
        own = np.unpackbits(np.frombuffer(row["own"], np.uint8), count=row["n"]).astype(bool)
        sums[mine[own]] = np.frombuffer(unpacked(row["sums"]), "<i8")
        at += row["n"]
    return often, sums


def _grown(batch: pa.RecordBatch, i: int, names: list[str]):
    """A shard's frequent phrases with their sums, as far as told, and the next ones with hashes."""
    shard, words, index, lang = _opened(batch, i)
    keys, _, (one, two), of_words = _short(index, lang, words)
    often, sums = _told(batch, i, names[0], keys)
    cut = len(one[0])
    levels = []
    for found, keep, total in ((one, often[:cut], sums[:cut]), (two, often[cut:], sums[cut:])):
        levels.append((tuple(c[keep] for c in found), total[keep]))
    for name in names[1:]:
        found = index.extended(*levels[-1][0])
        keep, total = _told(batch, i, name, hashes(found, lang, words, of_words))
        levels.append((tuple(c[keep] for c in found), total[keep]))
    return shard, words, index, lang, levels, of_words


def with_bits(shards: DataFrame, counted: DataFrame, name: str, min_count: int) -> DataFrame:
    """The shards with ``name``: the bits of their hashes, from the counts of all shards."""

    def run(rows: pa.Table) -> pa.Table:
        held = [
            unpacked_counts(*pair)
            for pair in zip(rows["keys"].to_pylist(), rows["counts"].to_pylist(), strict=True)
        ]
        keys = np.concatenate([k for k, _ in held])
        counts = np.concatenate([c for _, c in held]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sums = np.add.reduceat(counts[order], starts)
        often = np.empty(len(keys), dtype=bool)
        often[order] = np.repeat(sums >= min_count, np.diff(np.append(starts, len(keys))))
        own, totals = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        own[order[starts]] = sums >= min_count
        totals[order[starts]] = sums
        sizes = [len(k) for k, _ in held]
        parts = [slice(b - n, b) for n, b in zip(sizes, np.cumsum(sizes).tolist(), strict=True)]
        told = {
            "often": [np.packbits(often[p]).tobytes() for p in parts],
            "own": [np.packbits(own[p]).tobytes() for p in parts],
            "sums": [packed(totals[p][own[p]].astype("<i8").tobytes()) for p in parts],
        }
        return pa.table(
            {
                "shard": rows["shard"],
                "range": rows["range"],
                "n": pa.array(sizes, pa.int32()),
                **{name: pa.array(values, pa.binary()) for name, values in told.items()},
            }
        )

    found = counted.select("shard", "range", "keys", "counts").groupBy("range")
    told = (
        found.applyInArrow(run, "shard long, range int, n int, often binary, own binary, sums binary")
        .groupBy("shard")
        .agg(F.collect_list(F.struct("range", "n", "often", "own", "sums")).alias(name))
    )
    return join_measured(shards, written(told, name), ["shard"])


def longer(shards: DataFrame, names: list[str], ranges: int) -> DataFrame:
    """Rows of packed counts of each shard's phrases of one word more than told of in ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                shard, words, index, lang, levels, of_words = _grown(batch, i, names)
                found = index.extended(*levels[-1][0])
                if len(found[0]):
                    keys = hashes(found, lang, words, of_words)
                    yield _record(pieces(shard, keys, found[1], ranges))

    return written(shards.mapInArrow(run, _PIECE_DDL), "longer")


_COUNTED = "lang string, words int, phrase string, f long"


def spelled(shards: DataFrame, names: list[str]) -> DataFrame:
    """(lang, words, phrase, f): every frequent phrase, from the shard that was given its sum."""

    def rows(lang: str, numbers: np.ndarray, sums: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(sums), ROWS):
            some = slice(at, at + ROWS)
            columns = [words.take(pa.array(c)) for c in numbers[some].T]
            phrase = columns[0]
            if len(columns) > 1:
                phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))
            size = len(phrase)
            yield pa.record_batch(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array(np.full(size, len(columns), dtype=np.int32)),
                    phrase.cast(pa.string()),
                    pa.array(sums[some], pa.int64()),
                ],
                ["lang", "words", "phrase", "f"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                _, words, _, lang, levels, _ = _grown(batch, i, names)
                spelling = pa.array([b"", *words], pa.binary())
                for found, sums in levels:
                    own = sums > 0
                    yield from rows(lang, found[2][own], sums[own], spelling)

    return shards.mapInArrow(run, _COUNTED)


def frequent_phrases(
    docs: DataFrame, text: str, lang: str, min_count: int = MIN_COUNT
) -> tuple[DataFrame, DataFrame]:
    """Written tables (lang, words, phrase, f) of frequent phrases and (lang, n) of all words."""
    size = docs.agg(F.sum(F.octet_length(text_of(docs, text)))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    table = indexed(docs, text, lang, ranges)
    shards = table.where("range is null").drop("range", "keys", "counts")
    totals = written(shards.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    names = ["up_to_2"]
    shards = with_bits(shards, table.where("range is not null"), names[0], min_count)
    for length in range(3, LONGEST + 1):
        more = longer(shards, names, ranges)
        names = [*names, f"of_{length}"]
        shards = with_bits(shards, more, names[-1], min_count)
    return written(spelled(shards, names), "frequent"), totals


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("list", first, size), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, list, a, l, r, score): every candidate with its lowest cut."""
    candidates = frequent.where("words > 1").select(
        "lang", "phrase", F.split("phrase", " ").alias("list"), F.col("f").alias("a")
    )
    cut, size = F.col("cut"), F.size("list")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select(
        "*", _part(F.lit(1), cut).alias("first"), _part(cut + 1, size - cut).alias("rest")
    )
    for part, count in (("first", "l"), ("rest", "r")):
        its = frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
        # The frequent phrases grow with the corpus; they are joined by shuffle at every size.
        cuts = cuts.join(its.hint("merge"), ["lang", part])
    # The product may pass 64 bits.
    score = F.expr(f"{SCALE} * cast(a as decimal(28,0)) div (cast(l as decimal(28,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase").agg(F.first("list").alias("list"), F.first("a").alias("a"), lowest).select(
        "lang", "phrase", "list", "a", "low.l", "low.r", "low.score"
    )


def uncovered(candidates: DataFrame) -> DataFrame:
    """The candidates that no longer one with most of their occurrences holds."""
    size = F.size("list")
    inner = (
        candidates.where(size > 2)
        .select("lang", "list", F.col("a").alias("longer"), F.explode(F.sequence(F.lit(2), size - 1)).alias("k"))
        .select("*", F.explode(F.sequence(F.lit(1), F.size("list") - F.col("k") + 1)).alias("i"))
        .groupBy("lang", _part(F.col("i"), F.col("k")).alias("phrase"))
        .agg(F.max("longer").alias("longer"))
    )
    covered = F.expr(
        f"100 * cast(longer as decimal(28,0)) >= {COVER_PERCENT} * cast(a as decimal(28,0))"
    )
    return join_measured(candidates, written(inner, "inner"), ["lang", "phrase"]).where(
        ~F.coalesce(covered, F.lit(False))
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    frequent, totals = frequent_phrases(docs, text, lang, min_count)
    candidates = written(scored(frequent), "candidates")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's best are among the best of its buckets, so no task gets a whole language.
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    some = uncovered(candidates).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", bucket).orderBy(*order))
    )
    ranked = some.where(F.col("place") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    )
    return join_measured(ranked.where(F.col("rank") <= top), totals, ["lang"], "inner").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
