"""How filters of documents act together, whatever the order they are applied in.

Each document's failing filters are one row of a mask matrix: 0 where a filter fails the document,
infinity where it doesn't. Each order of the filters is one row of a position matrix, the inverse
of the permutation: at which step a filter is applied. The min-plus product of the two, the least
mask + position over the filters, is the step at which an order removes a document. Documents of
one part (a language, say) with equal masks are removed alike, so they are counted first, before
the shuffle; what one task gets of a part is at most 2 ^ filters rows, weighted by their numbers.
Scattering the weights to (order, step) gives what is removed, and with it all else: kept,
redundant and lost documents, and the sum over all orders (Shapley value times their number).

The five filters of ``FAILURES``: A under ``MIN_WORDS`` words; B fewer than ``DISTINCT_PERCENT``
percent distinct words; C more than ``CAPITAL_PERCENT`` percent of capitals A-Z; D a symbol of
``SYMBOLS``; E a text that a row of a smaller id has too, removed or not.

Defined cases: null text is empty, has no words and no characters, fails A, and E if another null or
empty text has a smaller id. A null id neither fails E nor is a smaller id than another. Rows of one
id and text don't make each other copies. A null part is the part "". A label row counts for every
document of its id; of several labels of one id the greatest value counts, and null ones none. Every
row of a repeated document counts. An empty table gives no rows. Other columns aren't read, whatever
their names. Texts are compared by 128-bit digests of their bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import join_measured, text_of, written

FAILURES = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Added to the positions of filters that don't fail; more than any number of steps.
NEVER = 1 << 20


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails by itself."""
    words = text.split()
    # Bytes that continue a character are no code points of their own.
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def failures(docs: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """A written table (id, part, mask) with a row per document; bit i is filter i's."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            masks = pa.array([own_failures(t) for t in texts], pa.int32())
            digests = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
            yield pa.record_batch(
                [batch.column("id"), batch.column("part"), masks, digests],
                ["id", "part", "own", "digest"],
            )

    rows = docs.select(
        docs[doc_id].alias("id"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
        F.make_valid_utf8(text_of(docs, text)).cast("binary").alias("text"),
    ).mapInArrow(run, f"id {kind}, part string, own int, digest binary")
    rows = written(rows, "audit_rows")
    # Counted where they lie first, so a text that a third of all rows share is a row a task.
    copies = (
        rows.groupBy("digest")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most")
        .select("digest", "least")
    )
    copied = F.coalesce(F.col("id") > F.col("least"), F.lit(False)).cast("int")
    joined = join_measured(rows, written(copies, "audit_copies"), ["digest"])
    mask = F.col("own").bitwiseOR(F.shiftleft(copied, 4))
    return joined.select("id", "part", mask.alias("mask"))


def weighed(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, and those labelled so."""
    known = (
        labels.select(labels[doc_id].alias("id"), labels["quality"], labels["toxic"])
        .where("id is not null")
        .groupBy("id")
        .agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    )
    return (
        join_measured(rows, written(known, "audit_labels"), ["id"])
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic"),
        )
    )


def positions(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders (a row each, of filter numbers) and, inverse to them, each filter's step from 1."""
    orders = np.array(list(itertools.permutations(range(filters))), dtype=np.int64)
    return orders, np.argsort(orders, axis=1) + 1


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The step at which each order removes each mask; over ``NEVER`` if none does."""
    cost = np.where(fails, 0, NEVER)
    return (cost[:, None, :] + places[None, :, :]).min(axis=2)


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def effects(masks: np.ndarray, weights: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Counts by (order, step) from masks (n) and weights (n, 3: all, good, toxic)."""
    orders, places = positions(filters)
    fails = (masks[:, None] >> np.arange(filters) & 1).astype(bool)
    steps = removal_steps(fails, places)
    gone, at = np.nonzero(steps <= filters)
    scattered = np.zeros((len(orders), filters, weights.shape[1]), dtype=np.int64)
    np.add.at(scattered, (at, steps[gone, at] - 1), weights[gone])
    removed, good, toxic = np.moveaxis(scattered, 2, 0)
    n = weights[:, 0]
    # Of those that fail a step's filter, who has been removed before it.
    before = steps[:, :, None] < np.arange(1, filters + 1)
    redundant = np.einsum("m,mos->os", n, before & fails[:, orders])
    alone = fails & (fails.sum(axis=1, keepdims=True) == 1)
    every_order = np.zeros(filters, dtype=np.int64)
    np.add.at(every_order, orders, removed)
    return {
        "kept": n.sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": (n @ alone)[orders],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": every_order[orders],
    }


def audit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
    names: Sequence[str] = FAILURES,
) -> DataFrame:
    """(part, filter_order, step, counts) for every part and order of the filters."""
    orders, _ = positions(len(names))
    spelled = ["".join(names[i] for i in order) for order in orders]
    filters = len(names)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        weights = np.column_stack([rows[c].to_numpy() for c in ("n", "good", "toxic")])
        found = effects(rows["mask"].to_numpy().astype(np.int64), weights, filters)
        size = len(spelled) * filters
        columns = {
            "part": pa.array([key[0].as_py()] * size, pa.string()),
            "filter_order": pa.array(np.repeat(spelled, filters)),
            "step": pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), len(spelled))),
        }
        columns |= {c: pa.array(found[c].ravel().astype(np.int64)) for c in _COUNTS}
        return pa.table(columns)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    masks = weighed(failures(docs, text, doc_id, part), labels, doc_id)
    return masks.groupBy("part").applyInArrow(run, f"part string, filter_order string, step int, {counts}")
