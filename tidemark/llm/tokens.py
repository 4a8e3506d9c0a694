"""Token ids by a public tokenizer file, in Spark's Python workers.

The tokenizer of ``word_bpe_49k.json`` drops white space before it looks for merges, so a text's ids
are those of its blank-separated stretches, one after the other.  Stretches repeat, so each worker keeps
the ids of up to ``KNOWN`` of them.  A new stretch that is one lower-case word goes straight to the merges;
marks after a word are a piece of their own; any other stretch goes through the whole tokenizer.
A column of texts is split by Arrow, and each different stretch of about ``PART`` bytes of text is looked up once.
"""

from __future__ import annotations

import string
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if sys.byteorder != "little":
    raise ImportError("ids are kept as this machine's 16-bit integers, which must be little-endian")
MARKS = string.punctuation
KNOWN = 700_000
PART = 12_000_000          # bytes of text whose stretches are looked up together
_ENCODERS: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder(dict):
    """Stretch -> its ids as little-endian unsigned 16-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.merge = self.tokenizer.model.tokenize
        self.alphabet = byte_characters()
        self.known = KNOWN

    def __missing__(self, stretch: str) -> bytes:
        if stretch.isalpha():
            if stretch.isascii():
                out = array("H", [t.id for t in self.merge(stretch.lower())]).tobytes()
            elif self._is_word(stretch):
                word = stretch.lower().encode("utf-8").decode("latin-1").translate(self.alphabet)
                out = array("H", [t.id for t in self.merge(word)]).tobytes()
            else:
                out = self._whole(stretch)
        elif (word := stretch.rstrip(MARKS)) != stretch and word.isalpha():
            out = self[word] + self[stretch[len(word):]]
        else:
            out = self._whole(stretch)
        if len(self) < self.known and len(stretch) <= 64:
            self[stretch] = out
        return out

    def _whole(self, stretch: str) -> bytes:
        return array("H", self.tokenizer.encode(stretch, add_special_tokens=False).ids).tobytes()

    @staticmethod
    def _is_word(stretch: str) -> bool:
        """Of letters, not all ASCII: whether their normal form and lower case leave no room for doubt."""
        low = stretch.lower()
        return ("\u03a3" not in stretch and low.isalpha() and len(low) == len(stretch)
                and unicodedata.is_normalized("NFC", stretch) and unicodedata.is_normalized("NFC", low))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text.

        Plain blanks and line feeds separate stretches.  A-Z are put in lower case first, as the tokenizer does,
        so that fewer stretches differ, unless the text may name a special token."""
        if "<|" not in text:
            text = text.encode("utf-8").lower().decode("utf-8")
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column without nulls, as ``encode`` gives them."""
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.flatnonzero(np.diff((np.cumsum(size) - size) // PART, prepend=-1)).tolist()
        for a, b in pairwise([*first, len(texts)]):
            yield from self._encode_part(texts.slice(a, b - a))

    def _encode_part(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring(texts, "<|")
        plain = pc.replace_substring(pc.ascii_lower(pc.if_else(odd, "", texts)), "\n", " ")
        split = pc.split_pattern(plain, " ")
        coded = split.flatten().dictionary_encode()
        # no stretch has a blank, so that the different ones come over as one string
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), " ")
        ids = list(map(self.__getitem__, joined[0].as_py().split(" ")))
        kind = np.int32 if texts.nbytes < 1 << 29 else np.int64
        own = np.fromiter(map(len, ids), kind, len(ids)) >> 1
        spot, known = np.cumsum(own, dtype=kind) - own, np.frombuffer(b"".join(ids), dtype="<u2")
        at = coded.indices.to_numpy()
        n = own[at]
        end = np.cumsum(n, dtype=kind)
        where = np.repeat(spot[at] - end + n, n)
        where += np.arange(len(where), dtype=kind)
        data = known[where].tobytes()
        cuts = 2 * np.append(0, end)[split.offsets.to_numpy()].astype(np.int64)
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            yield self.encode(texts[k].as_py()) if odd[k].as_py() else data[a:b]


def encoder(path: str | None = None, known: int = KNOWN) -> Encoder:
    """This worker's encoder of a tokenizer file; it keeps at most ``known`` stretches."""
    path = path or default_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].known = known
    return _ENCODERS[path]
