"""Token ids of whole texts with a tokenizer file of the `tokenizers` library.

Byte-level pair encodings work on pieces of text that do not depend on each other: the words, numbers and
signs that their pattern cuts out. Texts repeat such pieces, so a worker keeps the ids of those it has met and asks
the library's model for new ones only. This holds for texts of one-byte (Latin-1) characters and for the two
patterns below, which are read from the tokenizer file; every other text goes to the library as a whole. The
results are the library's own (tests/llm/test_tokens.py compares them).

Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Letters, numbers and white space among the Latin-1 characters.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PIECES = (
    rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: The pattern that a tokenizer file must name for the lower-case word pieces.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_PIECES = rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Pieces a worker remembers, about 150 bytes each; after as many that found no room it starts afresh.
REMEMBERED = 200_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in table)
    table.update((b, chr(256 + k)) for k, b in enumerate(rest))
    return table


class _Pieces(dict):
    """Ids of pieces as packed bytes; asks the model for a piece it has not met."""

    def __init__(self, model, code: str):
        self.model, self.code, self.letters = model, code, byte_letters()
        self.turned_away = 0

    def __missing__(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self.letters)
        ids = array(self.code, [t.id for t in self.model.tokenize(written)]).tobytes()
        # Words that are common are met early; the rare ones that come later would only push them out.
        if len(self) < REMEMBERED:
            self[piece] = ids
        elif (rest := self.turned_away + 1) < REMEMBERED:
            self.turned_away = rest
        else:
            self.clear()
            self.turned_away = 0
        return ids


class Encoder:
    """Encodes texts to packed little-endian ids of `dtype`, the smallest that holds the vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.pieces = _Pieces(self.tokenizer.model, "I" if wide else "H")
        with open(path, encoding="utf-8") as f:
            self.pattern, self.lower = self._known(json.load(f))

    @staticmethod
    def _known(spec: dict):
        """The pattern of independent pieces, and whether texts are lower-cased; None where unknown."""
        before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if normal is None and before.get("type") == "ByteLevel" and before.get("use_regex"):
            if not before.get("add_prefix_space"):
                return re.compile(BYTE_PIECES), False
        steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
        cutters = before.get("pretokenizers", [])
        if steps == WORD_NORMALIZERS and len(cutters) == 2:
            if cutters[0].get("pattern", {}).get("Regex") == WORD_PATTERN and cutters[0].get("invert"):
                return re.compile(WORD_PIECES), True
        return None, False

    def encode(self, text: str) -> bytes:
        if self.pattern is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.whole(text)
            found = self.pattern.findall(text.lower() if self.lower else text)
            return b"".join(map(self.pieces.__getitem__, found))
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process, kept between tasks."""
    return Encoder(path)


def tokenizer_path(name: str) -> str:
    """The place of a tokenizer file of the public collection."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
