"""Public tokenizers inside tasks, with a bounded memory of chunks already encoded.

Both encoders cut a text only where its tokens are known to be independent, encode each distinct
chunk once by the library, and so return what the library returns for the whole text:

* sentencepiece: merges never cross the border of a non-blank and a blank, nor a line feed, nor of
  a letter and a mark, if no piece of the vocabulary does; this is looked up, and marks that fail
  aren't cut at, or the whole text is encoded;
* tokenizers with a pre-tokenizer that drops white space (``word_bpe_49k.json``): the
  pre-tokenizer's runs, in texts with common characters only, else what stands between spaces
  and line feeds; other files are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

# Chunks kept per worker; some 150 bytes each.
MEMORY_CHUNKS = 600_000

LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
COMMON_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
COMMON_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
# Characters whose class and lower case no Unicode version has changed.
_OTHER = re.compile("[^\t\n\r -~\xa1-\u024f]")
TEXTS_AT_A_TIME = 64


def file_of(name: str) -> str:
    """The path of a tokenizer: a file, or a name that ``public_tokenizers`` knows."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def version_digest(name: str) -> str:
    """Digest of what decides the tokens: the library, its version and the file."""
    path = file_of(name)
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(
        f"{library.__name__} {library.__version__} {content}".encode()
    ).hexdigest()


class PieceCounter:
    """Token counts by a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = self.model.encode("\n a", out_type=str)
        self.cuts = (
            not any(re.search("[^▁]▁|\n", piece) for piece in pieces)
            and self.model.normalize(" a  b\t\nc ") == "▁▁a▁▁b\t\nc▁"
            and len(self.model.encode("\n")) == 2
            and probe[:1] == ["▁"]
        )
        joined = set(re.findall(f"(?<=[{LETTERS}])[{re.escape(MARKS)}]", "\n".join(pieces)))
        marks = re.escape("".join(mark for mark in MARKS if mark not in joined))
        word = f" *[{LETTERS}]+(?=[{marks}])|" if marks else ""
        self.chunks = re.compile(rf"\n+|{word} *[^ \n]+| +")
        self.memory: dict[str, int] = {}

    def _learn(self, chunks: set[str]) -> None:
        if len(self.memory) + len(chunks) > MEMORY_CHUNKS:
            self.memory.clear()
        new = sorted(chunks)
        # A line feed ahead keeps the model from putting a blank before the chunk.
        encoded = self.model.encode(["\n" + chunk for chunk in new], num_threads=1)
        self.memory.update(zip(new, (len(ids) - 2 for ids in encoded), strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        return [self._count(text) for text in texts]

    def _count(self, text: str) -> int:
        if not text:
            return 0
        # The blank that the model puts before a text, joined to the blanks it begins with.
        # The mark that stands for a blank in the vocabulary is one in a text, too.
        chunks = self.chunks.findall(" " + text.replace("▁", " "))
        try:
            return sum(map(self.memory.__getitem__, chunks))
        except KeyError:
            self._learn({c for c in chunks if c not in self.memory})
        if all(chunk in self.memory for chunk in chunks):
            return sum(map(self.memory.__getitem__, chunks))
        return len(self.model.encode(text, num_threads=1))


class _Places(dict):
    """Places in a memory; -1 for what isn't there."""

    def __missing__(self, part: str) -> int:
        return -1


class IdEncoder:
    """Token ids by a ``tokenizers`` file, special strings in texts handled as its default."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.cuts = self._cuts_at_blanks(settings)
        if self.cuts:
            pattern = settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            # In texts with common characters only, these are all letters and numbers.
            pattern = pattern.replace(r"\p{L}", COMMON_LETTERS).replace(r"\p{N}", COMMON_NUMBERS)
            self.runs = re.compile(pattern)
            special = "|".join(re.escape(token["content"]) for token in settings["added_tokens"])
            self.special = re.compile(special or "(?!)")
            suffix = settings["model"].get("end_of_word_suffix") or None
            vocabulary = settings["model"]["vocab"]
            self.ends = np.zeros(1 + max(self.model.get_vocab().values()), dtype=bool)
            if suffix:
                self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    @staticmethod
    def _cuts_at_blanks(settings: dict) -> bool:
        """Whether white space only separates, for special tokens too."""
        normal = settings.get("normalizer") or {}
        split = ((settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        steps = [step["type"] for step in normal.get("normalizers", [])]
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and split.get("type") == "Split"
            and (split.get("behavior"), split.get("invert")) == ("Removed", True)
            and set(re.findall(r"\\p\{\w+\}", split["pattern"].get("Regex", "")))
            == {r"\p{L}", r"\p{N}"}
            and split["pattern"]["Regex"].endswith(r"[^\s\p{L}\p{N}]+")
            and not any(
                token["lstrip"] or token["rstrip"] or " " in token["content"]
                for token in settings["added_tokens"]
            )
        )

    def _forget(self) -> None:
        self.memory = _Places({"": 0})
        # Part i has the ids flat[starts[i] : starts[i] + sizes[i]]; the arrays grow by doubling.
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.sizes = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0
        # Whether all parts at hand are single runs of the pre-tokenizer.
        self.only_runs = False

    def _parts(self, text: str) -> list[str]:
        """What the text's ids can be put together from.

        The runs of the pre-tokenizer, where all characters are common ones, else what stands
        between blanks.
        """
        if self._uncommon(text):
            return text.replace("\n", " ").split(" ")
        return self.runs.findall(text.lower())

    def _uncommon(self, text: str) -> bool:
        return bool(_OTHER.search(text) or self.special.search(text))

    def _learn(self, parts: set[str]) -> None:
        new = sorted(parts - {""})
        ids, sizes = self._ids(new)
        first, last = len(self.memory), len(self.memory) + len(new)
        self.starts, self.sizes = _grown(self.starts, last), _grown(self.sizes, last)
        self.flat = _grown(self.flat, self.used + len(ids))
        self.starts[first:last] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:last] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.memory.update(zip(new, range(first, last), strict=True))

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row, and how many each has.

        Parts are encoded as one text where each of them ends with an end-of-word token, which
        spares the library most of its work for a text.
        """
        joined = self.model.encode_batch_fast([" ".join(parts)], add_special_tokens=False)
        ids = np.array(joined[0].ids, dtype=np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1 if len(ids) else np.zeros(0, dtype=np.int64)
        if self.only_runs and len(ends) == len(parts) and (not len(ends) or ends[-1] == len(ids)):
            return ids, np.diff(ends, prepend=0)
        found = [e.ids for e in self.model.encode_batch(parts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(parts))
        total = int(sizes.sum())
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=total), sizes

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        for at in range(0, len(texts), TEXTS_AT_A_TIME):
            some = texts[at : at + TEXTS_AT_A_TIME]
            if self.cuts:
                self.only_runs = not any(map(self._uncommon, some))
                yield from map(self._put_together, self._places(list(map(self._parts, some))))
            else:
                for e in self.model.encode_batch(some, add_special_tokens=False):
                    yield np.array(e.ids, dtype=np.uint32)

    def _places(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Each text's parts as their places in the memory, which learns the new ones."""
        places = [self._known(parts) for parts in texts]
        new = [np.flatnonzero(found < 0) for found in places]
        wanted = {parts[i] for parts, at in zip(texts, new, strict=True) for i in at.tolist()}
        if len(self.memory) + len(wanted) > MEMORY_CHUNKS:
            self._forget()
            wanted = set(chain.from_iterable(texts))
            new = [np.arange(len(parts)) for parts in texts]
        if wanted:
            self._learn(wanted)
            for parts, found, at in zip(texts, places, new, strict=True):
                found[at] = self._known([parts[i] for i in at.tolist()])
        return places

    def _known(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memory.__getitem__, parts), np.int64, len(parts))

    def _put_together(self, codes: np.ndarray) -> np.ndarray:
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.starts[codes] - (ends - sizes), sizes)
        return self.flat[places]

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def __call__(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.encode_all(texts)]


def _grown(array: np.ndarray, wanted: int) -> np.ndarray:
    if wanted <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(wanted, 2 * len(array)) - len(array), array.dtype)])


@lru_cache(maxsize=4)
def counter(name: str) -> PieceCounter | IdEncoder:
    """The worker's encoder of this name, kept from task to task."""
    path = file_of(name)
    return PieceCounter(path) if path.endswith(".model") else IdEncoder(path)
