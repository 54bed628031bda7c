"""Quality rules with cutoffs whose false rejections are bounded on labelled holdouts.

A rule rejects a document whose value is above the rule's cutoff. Cutoffs are chosen per stratum,
so that at most ``alpha`` of its good documents are rejected by all rules together, with an error
chance ``delta`` over all strata (Bonferroni). Bad holdout documents that pass the base rule and one
in ``SELECT_ONE_IN`` of the good ones put the candidate cutoffs of a stratum in an order, least harm
first; the other good ones then prove, by the exact binomial tail, how far in that order the union
of the cutoffs may go. The unions are nested and their order doesn't depend on the documents that
prove them, so ``delta`` is divided by the number of strata only, and
ln(delta / strata) / ln(1 - alpha) proving documents are enough for a first cutoff. Of the proven
unions the one with the most bad rejections, less ``GOOD_WEIGHT`` times the good ones, over all
labels is used, and none if that gains nothing.

Texts are measured once: what is measured comes out of a generator, which the optimizer neither
repeats nor moves filters through, and labels are joined to documents before these are measured.

Defined cases: null text has no words and fails the base rule. A null stratum is a stratum of
its own; a stratum without enough holdout rows gets no cutoffs. Labels with null ids or null
values are left out, a document labelled both ways counts as bad, and every row of a repeated
document counts. Rows keep all their columns in ``row``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, join_measured, let, text_of, written

# Rules in order, with their candidate cutoffs, most strict first.
GRIDS: dict[str, list[float]] = {
    "symbols": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5],
    "dup_lines": [0.002, 0.005, 0.01, 0.02, 0.04, 0.08],
    "repeats": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4],
    "long_words": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
    "short_words": [-4.5, -4.0, -3.5, -3.0, -2.5, -2.0],
}
ALPHA = 0.02
DELTA = 0.05
GOOD_WEIGHT = 10
SELECT_ONE_IN = 4
BETWEEN = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    """Runs of anything but blanks; splitting is several times faster than extracting."""
    return F.filter(F.split(text, BETWEEN), lambda word: word != "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first included."""
    count = F.greatest(F.size(words) - 2, F.lit(0))
    windows = F.transform(
        F.slice(words, 1, count),
        lambda word, i: F.concat_ws(" ", word, words[i + 1], words[i + 2]),
    )

    def covered(found: Column) -> Column:
        placed = F.sort_array(
            F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        )
        starts = let(
            placed,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda e, j: (
                            (j > 0) & (F.get(s, j - 1)["w"] == e["w"])
                            | (j < F.size(s) - 1) & (F.get(s, j + 1)["w"] == e["w"])
                        ),
                    ),
                    lambda e: e["i"],
                )
            ),
        )
        step = F.aggregate(
            starts,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, i: F.struct(
                (acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end")
            ),
        )
        return step["n"]

    return let(
        windows,
        lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            covered(found)
        ),
    )


def base_metrics(text: Column) -> Column:
    """The five counts of a text as one struct of longs."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    dup_lines = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    of_words = let(
        words(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        ),
    )
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    return let(
        of_words,
        lambda w: F.struct(
            w["n_words"].alias("n_words"),
            w["word_chars"].alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            dup_lines.cast("long").alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def rule_values() -> dict[str, Column]:
    """Each rule's value from the metrics' columns; larger is worse."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines") / words,
        "repeats": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
        "short_words": -(F.col("word_chars") / words),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def stratum_key(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p); exact up to rounding, for k at most n * p."""
    first = n * math.log1p(-p)
    more = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<long>")
    )
    walked = F.aggregate(
        more,
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda acc, i: let(
            acc["log"] + F.log((n - i + 1) / i) + math.log(p / (1 - p)),
            lambda log: F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum")),
        ),
    )
    return walked["sum"]


def _reached(candidates: Column) -> Column:
    """Place of the first candidate, from 1, that rejects a document; 0 if none does."""
    values = rule_values()

    def above(c: Column) -> Column:
        value = F.lit(None).cast("double")
        for rule in GRIDS:
            value = F.when(c["rule"] == rule, values[rule]).otherwise(value)
        return value > c["cutoff"]

    return F.array_position(F.transform(candidates, above), True)


def cutoffs(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoffs: map of rule to value) from a written table (label_id, stratum, good, metrics)."""
    values = rule_values()
    # One part of the good documents orders the candidates, the other proves them.
    digit = F.conv(F.substring(F.md5(F.col("label_id").cast("string")), 1, 1), 16, 10).cast("int")
    ordering = F.col("good") & (digit % SELECT_ONE_IN == 0)
    proving = F.col("good") & ~ordering
    bad = ~F.col("good") & ~base_failed()
    parted = holdout.select(
        "stratum", *METRICS, "good", ordering.alias("orders"), proving.alias("proves"), bad.alias("bad")
    )
    counts, of_rules = [], []
    for rule, grid in GRIDS.items():
        tried = []
        for j, cutoff in enumerate(grid):
            above = values[rule] > cutoff
            counts += [
                F.count_if(F.col("orders") & above).alias(f"good_{rule}_{j}"),
                F.count_if(F.col("bad") & above).alias(f"bad_{rule}_{j}"),
            ]
            harm, use = F.col(f"good_{rule}_{j}"), F.col(f"bad_{rule}_{j}")
            tried.append(
                F.struct(
                    (use - GOOD_WEIGHT * SELECT_ONE_IN * harm).alias("gain"),
                    F.lit(float(cutoff)).alias("cutoff"),
                    harm.alias("harm"),
                    (-use).alias("use"),
                    F.lit(rule).alias("rule"),
                )
            )
        # The rule's best cutoff and the more lenient ones.
        of_rules.append(
            let(
                F.array(*tried),
                lambda cs: F.filter(
                    cs,
                    lambda c: (F.array_max(cs)["gain"] > 0)
                    & (c["cutoff"] >= F.array_max(cs)["cutoff"])
                    & (c["use"] < 0),
                ),
            )
        )
    in_order = F.array_sort(
        F.transform(
            F.concat(*of_rules),
            lambda c: F.struct(
                c["harm"].alias("harm"),
                c["use"].alias("use"),
                (-c["cutoff"]).alias("least"),
                c["rule"].alias("rule"),
                c["cutoff"].alias("cutoff"),
            ),
        )
    )
    ordered = written(
        parted.groupBy("stratum").agg(*counts).select("stratum", in_order.alias("candidates")),
        "quality_candidates",
    )
    tests = max(1, ordered.count())
    reached = written(
        join_measured(parted, ordered, ["stratum"])
        .withColumn("at", _reached(F.col("candidates")))
        .groupBy("stratum", "at")
        .agg(*[F.count_if(c).alias(c) for c in ("good", "proves", "bad")]),
        "quality_reached",
    )
    # Rows of one stratum are at most as many as candidates, and one.
    steps = reached.groupBy("stratum").agg(
        F.sum("proves").alias("n"), F.collect_list(F.struct("at", "good", "proves", "bad")).alias("rows")
    )

    def up_to(j: Column, name: str) -> Column:
        met = F.filter("rows", lambda r: (r["at"] > 0) & (r["at"] <= j))
        return F.aggregate(met, F.lit(0).cast("long"), lambda n, r: n + r[name])

    unions = (
        ordered.where(F.size("candidates") > 0)
        .join(steps, "stratum")
        .select("stratum", "n", "rows", "candidates", F.explode(F.sequence(F.lit(1), F.size("candidates"))).alias("j"))
        .select(
            "stratum",
            "n",
            "j",
            F.slice("candidates", F.lit(1), F.col("j")).alias("used"),
            up_to(F.col("j"), "proves").alias("wrong"),
            (up_to(F.col("j"), "bad") - GOOD_WEIGHT * up_to(F.col("j"), "good")).alias("gain"),
        )
    )
    few = F.col("wrong") <= F.col("n") * alpha
    tail = F.when(few, binomial_tail(F.col("wrong"), F.col("n"), alpha))
    best = (
        unions.where(few & (tail <= delta / tests) & (F.col("gain") > 0))
        .groupBy("stratum")
        .agg(F.max(F.struct(F.col("gain"), (-F.col("j")).alias("fewest"), F.col("used"))).alias("best"))
    )
    return (
        best.select("stratum", F.explode("best.used").alias("c"))
        .groupBy("stratum", "c.rule")
        .agg(F.min("c.cutoff").alias("cutoff"))
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )


def known_quality(labels: DataFrame) -> DataFrame:
    """(label_id, good): one row per labelled document."""
    rows = labels.select(labels["doc_id"].alias("label_id"), labels["quality"].alias("quality"))
    return rows.dropna().groupBy("label_id").agg((F.min("quality") > 0).alias("good"))


def measured(docs: DataFrame, text: str, doc_id: str, stratum: str) -> DataFrame:
    """(row, label_id, stratum, the metrics) for every document."""
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[doc_id].alias("label_id"),
        stratum_key(docs[stratum]).alias("stratum"),
        F.inline(F.array(base_metrics(text_of(docs, text)))),
    )


def learn(labelled: DataFrame) -> DataFrame:
    """The cutoffs as a written table, from (label_id, stratum, the metrics, good)."""
    return written(cutoffs(written(labelled, "quality_holdout")), "quality_cutoffs")


def verdicts(rows: DataFrame, learned: DataFrame) -> DataFrame:
    """Measured rows with ``base_failed`` and ``kept``."""
    values = rule_values()
    # Without a cutoff the comparison is null, and the rule doesn't reject.
    rejected = F.lit(False)
    for rule in GRIDS:
        rejected |= F.coalesce(values[rule] > F.col("cutoffs")[rule], F.lit(False))
    return (
        join_measured(rows, learned, ["stratum"])
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .drop("cutoffs")
    )


def keep_good_documents(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    stratum: str = "lang",
) -> DataFrame:
    """The documents that pass the base rule and the learned cutoffs, with their columns."""
    known = written(known_quality(labels), "quality_labels")
    own = docs.select(docs[doc_id].alias("label_id"), docs[stratum].alias("part"), docs[text].alias("text"))
    holdout = join_measured(own, known, ["label_id"], "inner")
    labelled = measured(holdout, "text", "label_id", "part").select(
        "label_id", "stratum", *METRICS, F.col("row.good").alias("good")
    )
    rows = measured(docs, text, doc_id, stratum)
    return verdicts(rows, learn(labelled)).where("kept").select("row.*")
