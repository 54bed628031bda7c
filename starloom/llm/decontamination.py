"""Find benchmark passages in documents by their word n-grams.

Benchmark texts give windows of ``WINDOW`` words; an item of fewer words is one window. The
distinct windows are held as a hash table under one word each, their longest (ties: the least),
so a document is scanned once, word by word. Words shorter than any anchor aren't looked up, and
whole windows are compared only where the word beside the anchor is right, too. The table is
broadcast if its bytes are measured within ``BROADCAST_BYTES``; beyond that the documents' words are
joined to it by shuffle, each with the words around it that a window can reach and no more, so what
is shuffled grows with the text's length only. All of it is DataFrame functions.

Words are runs of letters, digits and other non-ASCII characters of the text with A-Z
lower-cased. Defined cases: null or empty text has no words, is never contaminated, and as an
item has no window. Items with equal windows are all reported; the windows of a null item id count
as hits, but the item isn't in the list. Repeated documents get equal results. Rows keep all their columns
in ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    BROADCAST_BYTES,
    ascii_lower,
    fits,
    join_measured,
    let,
    text_of,
    written,
)

WINDOW = 10
# What is between words; several times faster to split at than words are to extract.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same in a text with its capitals.
BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BETWEEN), lambda word: word != "")


def word_count(text: Column) -> Column:
    """The number of ``words``: only the first and the last string of the split can be empty."""
    return let(
        F.split(text, BETWEEN_ANY),
        lambda s: F.size(s)
        - (s[0] == "").cast("int")
        - ((F.size(s) > 1) & (F.element_at(s, -1) == "")).cast("int"),
    )


def anchored_windows(
    items: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW
) -> DataFrame:
    """(anchor, before, side, beside, window, items): each distinct window under its anchor word.

    ``before`` is the number of the window's words ahead of the anchor, ``beside`` the word after
    it (``side`` 1) or, if there is none, before it (-1), ``items`` the ids as text, sorted and
    without nulls.
    """
    size = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - size + 1)
    windows = (
        items.select(items[item_id].cast("string").alias("item"), words(text_of(items, text)).alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window"))
        .groupBy("window")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    ranked = F.transform(
        "window", lambda w, i: F.struct((-F.length(w)).alias("n"), w.alias("w"), i.alias("i"))
    )
    anchored = windows.withColumn("first", F.array_min(ranked))
    before = F.col("first.i")
    side = F.when(before + 1 < F.size("window"), F.lit(1)).otherwise(F.lit(-1))
    return anchored.select(
        F.col("first.w").alias("anchor"),
        before.alias("before"),
        side.alias("side"),
        F.get("window", before + side).alias("beside"),
        "window",
        "items",
    )


def hits(
    docs: DataFrame, windows: DataFrame, small: bool, window: int = WINDOW, shortest: int = 1
) -> DataFrame:
    """(digest, n_hit, items) of each distinct text with a window, from (digest, words).

    ``window`` is the number of words of the longest window, ``shortest`` the length of the
    shortest anchor.
    """
    scanned = docs.select("digest", "words", F.posexplode("words").alias("at", "anchor")).where(
        F.length("anchor") >= shortest
    )
    first = F.lit(0)
    if not small:
        first = F.greatest(F.col("at") - (window - 1), F.lit(0))
        scanned = scanned.select(
            "digest", "at", "anchor", F.slice("words", first + 1, F.lit(2 * window - 1)).alias("words")
        )
    table = F.broadcast(windows) if small else windows
    start = F.col("at") - F.col("before")
    # The cheap comparison comes first; a window of one word has nothing beside it.
    beside = F.coalesce(F.get("words", F.col("at") - first + F.col("side")) == F.col("beside"), F.lit(False))
    found = scanned.join(table, "anchor").where(
        (F.col("beside").isNull() | beside)
        & (start >= 0)
        & (start - first + F.size("window") <= F.size("words"))
        & (F.slice("words", F.greatest(start - first, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    )
    span = F.struct(start.alias("from"), (start + F.size("window")).alias("to"))
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["to"] - F.greatest(s["from"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(s["to"], acc["end"]).alias("end"),
        ),
    )["n"]
    return (
        found.select("digest", span.alias("span"), "items")
        .groupBy("digest")
        .agg(F.collect_set("span").alias("spans"), F.collect_set("items").alias("items"))
        .select(
            "digest",
            covered.cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        )
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(row, n_words, n_hit, items) for every document."""
    windows = written(anchored_windows(benchmark, item_text, item_id, window), "windows")
    small = fits(windows, max_bytes)
    shortest = windows.agg(F.coalesce(F.min(F.length("anchor")), F.lit(1))).first()[0]
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.md5(text_of(docs, text)).alias("digest"),
        word_count(text_of(docs, text)).cast("long").alias("n_words"),
    )
    texts = docs.select(
        F.md5(text_of(docs, text)).alias("digest"), words(text_of(docs, text)).alias("words")
    )
    found = written(hits(texts, windows, small, window, shortest), "hits")
    return join_measured(rows, found, ["digest"]).select(
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with their columns."""
    return contamination(docs, benchmark, **options).where("n_hit = 0").select("row.*")

