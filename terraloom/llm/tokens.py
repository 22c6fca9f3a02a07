"""Token counts with a whole-token shortcut, for word-level BPE vocabularies with word ends.

Offline, every vocabulary string that ends a word is encoded alone; those that come back
as exactly their own token are proven whole. At run time a text is cut into pre-tokens;
proven ones count one each, and only the rest is merged. A pre-token never merges with its
neighbours, so the sum is the library's count.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LIMIT = 2048
#: Merged pre-tokens remembered per worker, and the longest that is remembered.
REMEMBERED = 200_000
REMEMBERED_CHARS = 64

# Letters, digits and white space up to U+017F as Unicode classes them; other code points,
# and controls, go through the library's own normalizer and splitter.
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "
_PLAIN = re.compile(f"[{_SPACES}!-~¡-įı-ſ‐-‧‰-⁞]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACES}{_LETTERS}{_DIGITS}]+")


@dataclass
class Vocabulary:
    """The tokenizer file's text, the strings proven whole, and the special strings.

    Its size is that of the tokenizer file, whatever the input.
    """

    source: str
    whole: frozenset[str]
    specials: tuple[str, ...]
    _counter: Counter | None = field(default=None, repr=False)

    def counter(self) -> Counter:
        if self._counter is None:
            self._counter = Counter(self)
        return self._counter

    def __getstate__(self):
        return {"source": self.source, "whole": self.whole, "specials": self.specials, "_counter": None}


def _library(source: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(source)


def prove(path: str) -> Vocabulary:
    """Read the tokenizer file and prove which of its strings encode alone as one token."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    tokenizer = _library(source)
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    alphabet = _byte_alphabet()
    strings = {}
    for token, number in tokenizer.get_vocab(with_added_tokens=True).items():
        if token in added or not token.endswith("</w>") or not set(token[:-4]) <= alphabet.keys():
            continue
        try:
            strings[bytes(alphabet[c] for c in token[:-4]).decode()] = number
        except UnicodeDecodeError:
            continue
    names = sorted(strings)
    whole = set()
    for name, code in zip(names, tokenizer.encode_batch(names, add_special_tokens=False)):
        if code.ids == [strings[name]] and _pieces(tokenizer, name) == [name]:
            whole.add(name)
    return Vocabulary(source, frozenset(whole), tuple(sorted(added, key=len, reverse=True)))


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies: printable bytes are themselves, others follow U+00FF."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _pieces(tokenizer, text: str) -> list[str]:
    """Pre-tokens of normalized text, as characters rather than byte stand-ins."""
    normal = tokenizer.normalizer.normalize_str(text)
    return [normal[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


class Counter:
    """Counts tokens; one per worker process, with a bounded memory of merged pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokenizer = _library(vocabulary.source)
        self.whole = vocabulary.whole
        self.sizes = dict.fromkeys(vocabulary.whole, 1)
        self.letters = {b: c for c, b in _byte_alphabet().items()}
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials))) if vocabulary.specials else None

    def count(self, text: str) -> int:
        if self.specials and self.specials.search(text):
            parts = self.specials.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if _PLAIN.fullmatch(text):
            pieces = _PIECES.findall(text.lower())
        else:
            pieces = self._exotic(text)
        sizes = list(map(self.sizes.get, pieces))
        if None in sizes:
            self._merge({p for p, n in zip(pieces, sizes) if n is None})
            sizes = [self._sizes_of[p] if n is None else n for p, n in zip(pieces, sizes)]
        return sum(sizes)

    def _exotic(self, text: str) -> list[str]:
        """Pre-tokens by the library's rules, white-space-separated run by run, plain runs the short way."""
        return [p for run in re.split(f"[{_SPACES}]+", unicodedata.normalize("NFC", text)) if run
                for p in (_PIECES.findall(run.lower()) if _PLAIN.fullmatch(run) else _pieces(self.tokenizer, run))]

    def _merge(self, pieces: Iterable[str]) -> None:
        """Token counts of pre-tokens that are not proven whole, merged by the library's rules."""
        pieces, odd = list(pieces), []
        for piece in pieces:  # normalizing these once more would change them
            if not piece.isascii() and unicodedata.normalize("NFC", piece) != piece:
                odd.append(piece)
        if odd:
            pieces = [p for p in pieces if p not in set(odd)]
        if len(self.sizes) > len(self.whole) + REMEMBERED:
            self.sizes = dict.fromkeys(self.whole, 1)
        self._sizes_of = {p: len(self.tokenizer.model.tokenize("".join(self.letters[b] for b in p.encode()))) for p in odd}
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            for piece, code in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self._sizes_of[piece] = len(code)
                if len(piece) <= REMEMBERED_CHARS:
                    self.sizes[piece] = len(code)


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """All columns of ``documents`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of the whole text.

    Null counts as empty: no bytes, no tokens. Repeated rows stay repeated; an empty table
    gives no rows. Input columns with the names of the new ones are replaced. ``path`` is
    read on the driver only.
    """
    new = {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}
    kept = [c for c in documents.columns if c not in new]
    schema = documents.select(*kept).schema
    for name, kind in new.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    shared = documents.sparkSession.sparkContext.broadcast(prove(path))

    def run(batches):
        counter = shared.value.counter()
        for batch in batches:
            texts = batch.column("text")
            n_bytes, n_tokens = [], []
            for value in texts:
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=[*kept, *new],
            )

    return documents.select(*kept).mapInArrow(run, schema)
