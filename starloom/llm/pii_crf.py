"""Personal data: fixed patterns, and a linear-chain conditional random field beside them.

The patterns (email, ip, card, phone) give the base spans. The random field reads word shapes: a
text's tokens (runs of letters, runs of digits, single marks) near a digit or ``@`` form
sequences, a token's features are the shapes of itself and its neighbours and what groups of digits
it stands in (how many digits, in how many groups), and its states are outside, or begin / inside
of a kind. It is trained here, by maximum likelihood, from a small
labelled table: ``EXAMPLES`` below, and ``TRAIN_LINES`` lines of the documents (those with the
least hash, of all lines up to ``TRAIN_LINE_CHARS`` with a digit or ``@``) labelled by the patterns,
but for lines in which the patterns leave a long number over. Training reads the first
``TRAIN_TOKENS`` tokens of a sequence; decoding reads all. Decoding is Viterbi over numpy
batches of whole texts. Its spans are added where they overlap no base span and hold what
their kind must: 9 to 15 digits for a phone, a valid check digit for a card, and so on.

Defined cases: null and empty texts have no spans; a repeated document gets a row each; an empty
table trains on the examples alone. Numbers of any length are read, very long ones fail the checks.
Columns other than the id and the text aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_of

KINDS = ["email", "ip", "card", "phone"]
STATES = ["O", *(f"{part}-{kind}" for kind in KINDS for part in "BI")]
TRAIN_LINES = 1000
TRAIN_LINE_CHARS = 2000
TRAIN_STEPS = 60
TRAIN_TOKENS = 120
EXAMPLE_WEIGHT = 10
REACH = 48
BATCH = 2048
BUCKETS = 1 << 12
FEATURES = 10

# The fixed part of the labelled table: (text, the span in it, kind or "" for none).
EXAMPLES: list[tuple[str, str, str]] = [
    ("please call 555-201-3344 today", "555-201-3344", "phone"),
    ("call me at (523) 555-1055 after six", "(523) 555-1055", "phone"),
    ("phone (310) 555-4510, ask for", "(310) 555-4510", "phone"),
    ("tel 0044 20 7946 0958 or write", "0044 20 7946 0958", "phone"),
    ("mobile 212.555.0187 at noon", "212.555.0187", "phone"),
    ("her number is 415-555-2671.", "415-555-2671", "phone"),
    ("ring 0044 207 946 0958 first", "0044 207 946 0958", "phone"),
    ("office 0033 1 70 18 99 00 or", "0033 1 70 18 99 00", "phone"),
    ("or 01-70-18-99-00 at home", "01-70-18-99-00", "phone"),
    ("fax (0221) 5550 199 for orders", "(0221) 5550 199", "phone"),
    ("desk 0221/5550199, first floor", "0221/5550199", "phone"),
    ("reach us under 0211 / 555 0123.", "0211 / 555 0123", "phone"),
    ("his cell 303 5550142 is off", "303 5550142", "phone"),
    ("whatsapp 49 171 5550 123 only", "49 171 5550 123", "phone"),
    ("mail anna [at] example [dot] org please", "anna [at] example [dot] org", "email"),
    ("contact bob(at)example(dot)net or", "bob(at)example(dot)net", "email"),
    ("write to ann at example dot org today", "ann at example dot org", "email"),
    ("mail sam dot lee at mail dot example dot net or", "sam dot lee at mail dot example dot net", "email"),
    ("mail bob [at] mail.example.net now", "bob [at] mail.example.net", "email"),
    ("or ask tom (at) example.com if", "tom (at) example.com", "email"),
    ("then eva [at] shop.example.org, she", "eva [at] shop.example.org", "email"),
    ("write to p dot doe at example dot net please", "p dot doe at example dot net", "email"),
    ("reach max at example dot com before", "max at example dot com", "email"),
    ("looked at example dot in the text", "", ""),
    ("meet at noon, dot the line", "", ""),
    ("user.7@mail3.example.com wrote", "user.7@mail3.example.com", "email"),
    ("host 10.0.13.7 was down", "10.0.13.7", "ip"),
    ("from 192.168.4.20, port open", "192.168.4.20", "ip"),
    ("card 4111.1111.1111.1111 was used", "4111.1111.1111.1111", "card"),
    ("paid with 4111 1111 1111 1111 on", "4111 1111 1111 1111", "card"),
    ("number 4012888888881881 in the form", "4012888888881881", "card"),
    ("in 1984 there were 365 days", "", ""),
    ("version 2.0 of the licence", "", ""),
    ("CC BY-NC 4.0 and others", "", ""),
    ("chapter 12, page 345-350", "", ""),
    ("it cost 1,299.99 in 2021", "", ""),
    ("order 2021-03-14 at 10:45", "", ""),
    ('token = "24be64439e3e49cf46b2d7c9"', "", ""),
    ("room 101 @ the end of hall 7", "", ""),
    ("a 3 x 4 table with 12 cells", "", ""),
    ("ISBN 978-3-16-148410-0, paperback", "", ""),
    ("about 7 800 000 000 people", "", ""),
    ("from 12.03.2021 to 14.03.2021", "", ""),
    ("at 52.520008, 13.404954 on the map", "", ""),
    ("pi is 3.14159265358979 or so", "", ""),
    ("rows 10, 20, 30, 40, 50, 60", "", ""),
    ("scores 3-2, 1-0, 4-4, 2-1, 0-0", "", ""),
    ("in 1914-1918 and 1939-1945", "", ""),
    ("2021-03-14 10:45:30 started", "", ""),
    ("on 2019-12-31 23:59:59 it ended", "", ""),
    ("sum 2.450.300,00 EUR and 12.300,50 EUR", "", ""),
    ("call 05.55 12 34 56 in the morning", "05.55 12 34 56", "phone"),
    ("ring 04 78.12.34.56 or", "04 78.12.34.56", "phone"),
    ("mobile 0176 5550123 and", "0176 5550123", "phone"),
    ("serial 0012345678901234567", "", ""),
    ("price 1.299.000,00 per unit", "", ""),
]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LONG_NUMBER = re.compile(r"[0-9](?:[ ().-]{0,3}[0-9]){8}")
_TRIGGER = re.compile(r"[0-9@]+|[\[(]at[\])]| dot ")
_SURE = re.compile(r"[0-9@]|[\[(]at[\])]| dot ")
# Groups of digits with little between them.
_GROUPS = re.compile(r"[(+]?[0-9]+(?:[ ()./-]{1,3}[0-9]+)*")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    if not 13 <= len(digits) <= 19:
        return False
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [part.lstrip("0") for part in text.split(".")]
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in parts)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> list[Span]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """The patterns' spans by kind; each pattern's matches that fail its check are dropped."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    found["email"] = _emails(text)
    if re.search("[0-9]", text):
        found["ip"] = [m.span() for m in _IP.finditer(text) if _is_ip(m[0])]
        found["card"] = [m.span() for m in _CARD.finditer(text) if _luhn(_digits(m[0]))]
        if "+" in text:
            phones = _PHONE.finditer(text)
            found["phone"] = [m.span() for m in phones if 9 <= len(_digits(m[0])) <= 15]
    return found


def windows(text: str) -> list[Span]:
    """Stretches of a line within ``REACH`` characters of a digit or ``@``, cut at blanks."""
    found: list[list[int]] = []
    if not _SURE.search(text):
        return []
    for hit in _TRIGGER.finditer(text):
        start, end = max(0, hit.start() - REACH), min(len(text), hit.end() + REACH)
        start = max(start, text.rfind("\n", start, hit.start()) + 1)
        line = text.find("\n", hit.end(), end)
        end = line if line >= 0 else end
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return [(start, end) for start, end in found if _SURE.search(text, start, end)]


def _shape(token: str) -> str:
    if token[0].isdigit() and token.isascii():
        n = len(token)
        return f"9{n if n <= 4 else 5 if n < 13 else 13 if n < 20 else 20}"
    if token.isalpha():
        case = "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
        # The words that stand for marks keep their form; of others only the shape is read.
        return token if token in ("at", "dot", "com", "org", "net") else case + str(min(len(token), 4))
    return token


def _code(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % BUCKETS


def _groups_of(text: str, span: Span, tokens: list[Span]) -> list[str]:
    """What groups of digits each token is in: the class of their digits, and how many groups."""
    found = [""] * len(tokens)
    at = 0
    for m in _GROUPS.finditer(text, *span):
        n, groups = len(_digits(m[0])), len(re.findall("[0-9]+", m[0]))
        size = "s" if n < 7 else "d" if n < 9 else "p" if n < 13 else "c" if n < 20 else "l"
        while at < len(tokens) and tokens[at][0] < m.start():
            at += 1
        first = True
        while at < len(tokens) and tokens[at][1] <= m.end():
            found[at] = f"{size}{min(groups, 6)}{'^' if first else ''}"
            first, at = False, at + 1
    return found


class Shapes:
    """Tokens and feature codes of stretches of text; codes are kept per worker."""

    def __init__(self):
        self.codes: dict[tuple[str, ...], list[int]] = {}

    def read(self, text: str, span: Span) -> tuple[list[Span], list[list[int]]]:
        tokens = [m.span() for m in _TOKEN.finditer(text, *span)]
        shapes = []
        for i, (start, end) in enumerate(tokens):
            blank = i == 0 or tokens[i - 1][1] < start
            shapes.append((" " if blank else "") + _shape(text[start:end]))
        padded = ["<", "<", *shapes, ">", ">"]
        groups = _groups_of(text, span, tokens)
        return tokens, [self._of((*padded[i : i + 5], groups[i])) for i in range(len(tokens))]

    def _of(self, near: tuple[str, ...]) -> list[int]:
        codes = self.codes.get(near)
        if codes is None:
            if len(self.codes) > 100_000:
                self.codes.clear()
            b, a, x, y, z, groups = near
            names = [f"g{groups}", f"g{groups}|{x[-1:]}", f"0{x}", f"-{a}", f"+{y}", f"-0{a}|{x}", f"0+{x}|{y}", f"-+{a}|{x}|{y}", f"--{b}|{a}|{x}", f"++{x}|{y}|{z}"]
            codes = self.codes[near] = [_code(name) for name in names]
        return codes


class Field:
    """The random field: weights of features by state, and of state pairs."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def _padded(self, sequences: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) for s in sequences])
        features = np.zeros((len(sequences), sizes.max(), FEATURES), dtype=np.int64)
        for i, s in enumerate(sequences):
            features[i, : len(s)] = s
        return features, sizes

    def decode(self, sequences: list[list[list[int]]]) -> list[np.ndarray]:
        """The likeliest states of each sequence, by Viterbi over batches of similar length."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if s), key=lambda i: len(sequences[i]))
        place = 0
        while place < len(order):
            some = order[place : place + BATCH]
            # Long sequences go in smaller batches, so that a batch stays within memory.
            while len(some) > 1 and len(some) * len(sequences[some[-1]]) > 1 << 18:
                some = some[: len(some) // 2]
            place += len(some)
            for i, states in zip(some, self._viterbi([sequences[i] for i in some]), strict=True):
                out[i] = states
        return out

    def _viterbi(self, sequences: list[list[list[int]]]) -> Iterator[np.ndarray]:
        features, sizes = self._padded(sequences)
        scores = self.weights[features].sum(axis=2)
        n, longest, states = scores.shape
        back = np.zeros((n, longest, states), dtype=np.int8)
        best = scores[:, 0] + self.moves[states]
        for t in range(1, longest):
            paths = best[:, :, None] + self.moves[None, :states]
            back[:, t] = paths.argmax(axis=1)
            on = (t < sizes)[:, None]
            best = np.where(on, paths.max(axis=1) + scores[:, t], best)
        rows = np.arange(n)
        states_at = np.zeros((n, longest), dtype=np.int64)
        now = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            states_at[:, t] = now
            now = np.where((t < sizes) & (t > 0), back[rows, t, now], now)
        return (states_at[i, :size] for i, size in enumerate(sizes))

    @classmethod
    def train(cls, sequences: list[list[list[int]]], states: list[list[int]]) -> Field:
        """Maximum likelihood with a small penalty on the weights, by Adam steps."""
        k = len(STATES)
        field = cls(np.zeros((BUCKETS, k)), np.zeros((k + 1, k)))
        for j, name in enumerate(STATES):
            if name.startswith("I-"):
                # An inside state follows its own kind only.
                allowed = [STATES.index("B" + name[1:]), j]
                field.moves[[i for i in range(k + 1) if i not in allowed], j] = -1e4
        features, sizes = field._padded(sequences)
        n, longest, _ = features.shape
        on = np.arange(longest)[None] < sizes[:, None]
        gold = np.zeros((n, longest), dtype=np.int64)
        for i, s in enumerate(states):
            gold[i, : len(s)] = s
        truth = np.eye(k)[gold] * on[:, :, None]
        true_moves = np.zeros((k + 1, k))
        np.add.at(true_moves, (gold[:, :-1][on[:, 1:]], gold[:, 1:][on[:, 1:]]), 1)
        np.add.at(true_moves, (k, gold[:, 0]), 1)
        flat = features[on].ravel()
        params = [field.weights, field.moves]
        means = [np.zeros_like(p) for p in params]
        squares = [np.zeros_like(p) for p in params]
        for step in range(1, TRAIN_STEPS + 1):
            shares, moves = field._expected(features, sizes, on)
            missing = np.repeat((truth - shares)[on], FEATURES, axis=0)
            gradient = np.stack(
                [np.bincount(flat, missing[:, j], minlength=BUCKETS) for j in range(k)], axis=1
            )
            gradients = [gradient - 0.1 * field.weights, true_moves - moves]
            for p, g, m, v in zip(params, gradients, means, squares, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                move = 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
                p += np.where(p > -1e3, move, 0)
        return field

    def _expected(self, features, sizes, on) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the states at each place, and expected numbers of the state pairs."""
        scores = self.weights[features].sum(axis=2)
        n, longest, k = scores.shape
        first, moves = self.moves[k], self.moves[:k]
        ahead = np.zeros_like(scores)
        behind = np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + first
        for t in range(1, longest):
            step = _logsum(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
            ahead[:, t] = np.where(on[:, t, None], step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _logsum(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(on[:, t + 1, None], step, 0)
        total = _logsum(ahead[:, -1], 1)
        shares = np.exp(ahead + behind - total[:, None, None]) * on[:, :, None]
        pairs = np.zeros((k + 1, k))
        for t in range(1, longest):
            both = (
                ahead[:, t - 1, :, None]
                + moves
                + (scores[:, t] + behind[:, t])[:, None, :]
                - total[:, None, None]
            )
            pairs[:k] += (np.exp(both) * on[:, t, None, None]).sum(axis=0)
        pairs[k] = shares[:, 0].sum(axis=0)
        return shares, pairs


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _states(tokens: list[Span], spans: dict[str, list[Span]]) -> list[int]:
    out = [0] * len(tokens)
    for kind, found in spans.items():
        for start, end in found:
            inside = [i for i, (a, b) in enumerate(tokens) if a >= start and b <= end]
            for place, i in enumerate(inside):
                out[i] = STATES.index(("I-" if place else "B-") + kind)
    return out


def train(lines: list[str]) -> Field:
    """The field from the labelled table: the examples, and lines labelled by the patterns."""
    shapes, sequences, states = Shapes(), [], []
    labelled = [
        (text, {kind: [(text.index(part), text.index(part) + len(part))]} if kind else {})
        for text, part, kind in EXAMPLES
    ]
    by_pattern = [(line, base_spans(line)) for line in lines]
    labelled = labelled * EXAMPLE_WEIGHT + [(line, spans) for line, spans in by_pattern if _certain(line, spans)]
    for text, spans in labelled:
        for window in windows(text):
            tokens, codes = shapes.read(text, window)
            if tokens:
                # Beyond this the window is a table of numbers, of no use for training.
                sequences.append(codes[:TRAIN_TOKENS])
                states.append(_states(tokens, spans)[:TRAIN_TOKENS])
    return Field.train(sequences, states)


def _certain(line: str, spans: dict[str, list[Span]]) -> bool:
    """Whether the patterns leave no long number over, which may be one they don't know."""
    rest = list(line)
    for start, end in (span for found in spans.values() for span in found):
        rest[start:end] = "x" * (end - start)
    return not _LONG_NUMBER.search("".join(rest))


def training_lines(docs: DataFrame, text: str = "text", lines: int = TRAIN_LINES) -> list[str]:
    """At most ``lines`` distinct lines with a digit or ``@``, those with the least hash."""
    line = F.explode(F.filter(F.split(text_of(docs, text), "\n"), lambda x: x.rlike("[0-9@]")))
    picked = (
        docs.select(line.alias("line"))
        .where(F.length("line") <= TRAIN_LINE_CHARS)
        .select("line", F.xxhash64("line").alias("h"))
        .groupBy("h")
        .agg(F.min("line").alias("line"))
        .orderBy("h")
        .limit(lines)
    )
    return [row["line"] for row in picked.collect()]


def _holds(kind: str, text: str) -> bool:
    digits = _digits(text)
    if kind == "phone":
        return 9 <= len(digits) <= 15 and len(text) <= 2 * len(digits)
    if kind == "card":
        return _luhn(digits) and len(text) <= 2 * len(digits)
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and _is_ip(".".join(parts))
    return bool(re.search(r"@|\bat\b", text)) and bool(re.search(r"\.|\bdot\b", text))


def find(texts: list[str], field: Field, shapes: Shapes) -> list[tuple[dict, dict]]:
    """Each text's base spans and added spans, by kind."""
    base = [base_spans(text) for text in texts]
    owners, places, sequences = [], [], []
    for i, text in enumerate(texts):
        for window in windows(text):
            tokens, codes = shapes.read(text, window)
            owners.append(i)
            places.append(tokens)
            sequences.append(codes)
    added: list[dict[str, list[Span]]] = [{kind: [] for kind in KINDS} for _ in texts]
    for i, tokens, states in zip(owners, places, field.decode(sequences), strict=True):
        if not states.any():
            continue
        taken = [span for spans in base[i].values() for span in spans]
        for kind, start, end in _runs(tokens, states):
            free = all(end <= a or start >= b for a, b in taken)
            if free and _holds(kind, texts[i][start:end]):
                added[i][kind].append((start, end))
    return list(zip(base, added, strict=True))


def _runs(tokens: list[Span], states: np.ndarray) -> Iterator[tuple[str, int, int]]:
    i = 0
    while i < len(states):
        if not states[i]:
            i += 1
            continue
        kind, first = STATES[states[i]][2:], i
        inside = STATES.index("I-" + kind)
        i += 1
        while i < len(states) and states[i] == inside:
            i += 1
        yield kind, tokens[first][0], tokens[i - 1][1]


def _written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def find_personal_data(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lines: int = TRAIN_LINES
) -> DataFrame:
    """(doc_id, base counts, base_spans, spans) for every document."""
    field = train(training_lines(docs, text, lines))
    shared = docs.sparkSession.sparkContext.broadcast((field.weights, field.moves))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, shapes = Field(*shared.value), Shapes()
        for batch in batches:
            found = find(batch.column("text").to_pylist(), field, shapes)
            counts = [pa.array([len(b[kind]) for b, _ in found], pa.int64()) for kind in KINDS]
            both = [{kind: b[kind] + a[kind] for kind in KINDS} for b, a in found]
            texts = [pa.array([_written(b) for b, _ in found], pa.string()), pa.array(map(_written, both), pa.string())]
            yield pa.record_batch([batch.column("doc_id"), *counts, *texts], names)

    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"]
    kinds = ", ".join(f"n_{kind} long" for kind in KINDS)
    key = docs[doc_id].alias("doc_id")
    whole = F.make_valid_utf8(text_of(docs, text)).alias("text")
    key_type = docs.select(key).schema["doc_id"].dataType.simpleString()
    return docs.select(key, whole).mapInArrow(
        scan, f"doc_id {key_type}, {kinds}, base_spans string, spans string"
    )
