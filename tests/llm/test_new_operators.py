"""Filter audit, b-bit MinHash and collocations against plain versions, on awkward small tables."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm import collocations, filter_audit, minhash_bbit
from starloom.llm.common import show_library
from tests.llm.test_operators import awkward as awkward_rows
from tests.llm.test_operators import by_row, prose, table

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = (
    "doc_id long, text string, lang string, id string, part string, mask string, own string, row string,"
    " n string, keys string, bits string, band string, component string, shard string, phrase string, f string"
)


def awkward(extra=()):
    return [(*r, *[None] * (3 - len(r))) for r in awkward_rows(extra)]


@pytest.fixture(autouse=True)
def library(spark):
    show_library(spark)


# Filter audit


def plain_audit(rows, labels):
    known = {
        key: (any(q == 1 for k, q, _ in labels if k == key), any(t == 1 for k, _, t in labels if k == key))
        for key, *_ in labels
        if key is not None
    }
    docs = []
    for key, text, lang, *_ in rows:
        text = text or ""
        words = SPACED.findall(text)
        smaller = any(k is not None and key is not None and k < key and (t or "") == text for k, t, *_ in rows)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": smaller,
        }
        docs.append((lang or "", fails, *known.get(key, (False, False))))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        found = {}
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [d for d in left if d[1][name]]
                left = [d for d in left if not d[1][name]]
                shapley[name] += len(gone)
                found["".join(order), step] = (
                    len(left),
                    len(gone),
                    sum(d[1][name] for d in mine) - len(gone),
                    sum(d[1][name] and sum(d[1].values()) == 1 for d in mine),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                )
        out += [(part, o, s, *v, shapley[o[s - 1]]) for (o, s), v in found.items()]
    return sorted(out)


AUDIT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_filter_audit(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = awkward([(20, long, "de"), (21, long, "en"), (22, long + " $", "de"), (20, long, "de"), (23, long.upper(), None)])
    rows += [(30 + i, f"copy {i % 2} of Ü%", ["de", "en", None, ""][i % 4]) for i in range(40)]
    labels = [(20, 1, 0), (20, 0, 1), (22, 1, None), (30, 0, 1), (31, 1, 1), (None, 1, 1), (99, 1, 1), (7, None, None)]
    docs = table(spark, rows, CLASHING)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = by_row(filter_audit.audit(docs, known), "part", "filter_order", "step", *AUDIT)
    assert got == sorted(plain_audit(rows, labels), key=repr)
    assert len(got) == 3 * 600


def test_filter_audit_of_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = table(spark, [(1, None, None)], CLASHING)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels).count() == 600


def test_audit_takes_text_ids(spark):
    docs = spark.createDataFrame([("b", "x", "en"), ("a", "x", "en"), (None, "x", "en")], "doc_id string, text string, lang string")
    labels = spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")
    row = filter_audit.audit(docs, labels).where("filter_order = 'EABCD' and step = 1").first()
    assert (row["removed"], row["kept"], row["good_lost"]) == (1, 2, 1)


def test_removal_steps_are_what_applying_the_filters_gives():
    orders, places = filter_audit.positions(4)
    masks = np.arange(16)
    fails = (masks[:, None] >> np.arange(4) & 1).astype(bool)
    steps = filter_audit.removal_steps(fails, places)
    for m, o in itertools.product(range(16), range(len(orders))):
        met = [s for s, f in enumerate(orders[o], 1) if fails[m, f]]
        assert steps[m, o] == met[0] if met else steps[m, o] > 4


# b-bit MinHash


def plain_sets(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = SPACED.findall((text or "").translate(lower))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(rows, percent):
    sets = [plain_sets(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    out = []
    for i, row in enumerate(rows):
        component = least.get(find(i)) if sets[i] else row[0]
        out.append((row[0], len(sets[i]), component, component == row[0]))
    return sorted(out, key=repr)


def varied(words, pick, changes):
    words = list(words)
    for at in pick.sample(range(len(words)), changes):
        words[at] = f"x{pick.random()}"
    return " ".join(words)


def near_rows():
    pick = random.Random(3)
    rows = awkward()
    base = prose(50, 300).split()
    # At and about the threshold: 300 words have 296 shingles, each change takes five.
    rows += [(100 + i, varied(base, pick, i % 12)) for i in range(60)]
    rows += [(200, "ONE two"), (201, "one  TWO"), (202, "a b c d e"), (203, "a b c d e f")]
    rows += [(300 + i, " ".join(base[i : 280 + i])) for i in range(0, 20, 2)]
    return rows


@pytest.mark.parametrize("rounds, block", [(3, 1024), (0, 1024), (0, 7)])
def test_near_copies(spark, monkeypatch, rounds, block):
    # Without further rounds all that is open after the first goes through the blocks.
    monkeypatch.setattr(minhash_bbit, "ROUNDS", rounds)
    monkeypatch.setattr(minhash_bbit, "BLOCK", block)
    rows = near_rows()
    found = minhash_bbit.near_copies(table(spark, rows, CLASHING))
    got = by_row(found, "row.doc_id", "n_shingles", "component_id", "kept")
    assert got == plain_near(rows, minhash_bbit.PERCENT)


def test_near_copies_of_empty_tables(spark):
    assert minhash_bbit.near_copies(table(spark, [], CLASHING)).count() == 0
    only = minhash_bbit.near_copies(table(spark, [(1, None), (2, "")], CLASHING))
    assert by_row(only, "row.doc_id", "component_id", "kept") == [(1, 1, True), (2, 2, True)]


def test_packed_minima_estimate_the_similarity():
    pick = np.random.default_rng(1)
    for n, shared in [(400, 340), (50, 45), (3000, 2000), (30_000 + minhash_bbit.TILE, 30_000)]:
        pool = np.unique(pick.integers(0, 2**64, 3 * n, dtype=np.uint64))[: 2 * n - shared]
        pick.shuffle(pool)
        least = [minhash_bbit.minima(np.sort(s)) for s in (pool[:n], pool[n - shared :])]
        true = np.mean(least[0] == least[1])
        equal = minhash_bbit.equal_minima(*[minhash_bbit.packed(x) for x in least])
        low = [x & np.uint32(2**minhash_bbit.BITS - 1) for x in least]
        assert equal == (low[0] == low[1]).sum()
        jaccard = shared / (2 * n - shared)
        assert abs(true - jaccard) < 0.11
        assert abs(minhash_bbit.estimated(equal) - jaccard) < 0.12


def test_minima_are_those_of_every_function():
    shingles = np.unique(np.random.default_rng(2).integers(0, 2**64, 700, dtype=np.uint64))
    one = minhash_bbit.minima(shingles)
    parts = [minhash_bbit.minima(shingles[a : a + 100]) for a in range(0, 700, 100)]
    assert (one == np.min(parts, axis=0)).all()


# Collocations


def plain_collocations(rows, least, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        candidates = {g: a for g, a in found.items() if len(g) > 1 and a >= least}
        held = set()
        for g, longer in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    if 100 * longer >= 80 * found[g[i : i + k]]:
                        held.add(g[i : i + k])
        scored = []
        for g, a in candidates.items():
            cuts = [(2_000_000 * a // (found[g[:k]] + found[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if g not in held:
                scored.append((-score, -a, " ".join(g).encode(), found[g[:k]], found[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


def phrase_rows():
    pick = random.Random(9)
    few = "to be or not that is the Question über 漢字 x-y ı".split()
    rows = [(i, " ".join(pick.choice(few) + pick.choice(["", "", "", ",", ".\n", "\t", "\r", ";;"]) for _ in range(60)), pick.choice(["en", "de", None, "und"])) for i in range(60)]
    rows += [(100 + i, "New York City Hall! new york", "en") for i in range(40)]
    rows += [(200, None, None), (201, "", "en"), (202, "a a a a a a " * 2000, "de"), (None, "... , ;", None), (203, "x" * 40000, "fr")]
    return rows


@pytest.mark.parametrize("least, words, top", [(5, 4_000_000, 2000), (3, 300, 2000), (30, 50, 7)])
def test_collocations(spark, monkeypatch, least, words, top):
    monkeypatch.setattr(collocations, "SHARD_WORDS", words)
    monkeypatch.setattr(collocations, "RANGE_BYTES", 10_000)
    rows = phrase_rows()
    docs = table(spark, rows, CLASHING).repartition(3)
    found = collocations.collocations(docs, min_count=least, top=top)
    got = by_row(found, "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert got == plain_collocations(rows, least, top)


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(table(spark, [], CLASHING)).count() == 0
    assert collocations.collocations(table(spark, [(1, None, None)], CLASHING)).count() == 0


def test_words_count_in_shards_without_a_frequent_pair(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_WORDS", 1)
    rows = [(i, "new york", "en") for i in range(5)] + [(10 + i, "york. new, x", "en") for i in range(7)]
    rows += [(20, "rare", "de"), (21, None, "fr")]
    docs = table(spark, rows, CLASHING).repartition(4)
    got = by_row(collocations.collocations(docs, min_count=5), "lang", "phrase", "a", "l", "r", "n")
    assert got == [("en", "new york", 5, 12, 12, 31)]


def test_index_extends_to_all_phrases_of_both_frequent_parts():
    pick = random.Random(4)
    numbers = np.array([0 if pick.random() < 0.1 else pick.randint(1, 6) for _ in range(3000)], dtype=np.int32)
    numbers[0] = 0
    index = collocations.Index(collocations.transform(numbers), 6)
    found = index.words()
    for k in range(1, 5):
        counts = Counter(
            tuple(map(int, numbers[i : i + k])) for i in range(len(numbers) - k + 1) if 0 not in numbers[i : i + k]
        )
        assert {tuple(map(int, w)): int(c) for w, c in zip(found[2], found[1], strict=True)} == counts
        found = index.extended(*found)


def test_packed_numbers_are_restored():
    values = np.array([0, 5, 1 << 30, 7], dtype=np.int32)
    assert (collocations.restored(collocations.squeezed(values)) == values).all()
    keys = np.array([3, 3, 90, (1 << 64) - 1], dtype=np.uint64)
    found = collocations.unpacked_counts(*collocations.packed_counts(keys, values))
    assert (found[0] == keys).all() and (found[1] == values).all()
    counts = np.arange(4)
    rows = collocations.pieces(7, keys[::-1].copy(), counts, 5)
    assert [r["range"] for r in rows] == [0, 4]
    assert sum(len(collocations.unpacked_counts(r["keys"], r["counts"])[0]) for r in rows) == 4
