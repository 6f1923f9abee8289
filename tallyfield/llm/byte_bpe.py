"""Byte-level BPE ids of whole texts, one dictionary look-up for each word already seen.

The vocabulary's pre-tokenizer always starts a new piece at a space that is followed by a
character other than white space, and pieces are encoded independently. A text is therefore cut
there, and a cut part has the same ids wherever it stands. Unseen parts go to the tokenizers
library, many of them as one text, whose ids are dealt back by their lengths in bytes.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyfield.llm.common import vocabulary_path
from tallyfield.llm.parts import PartIds

VOCABULARY = "byte_bpe_50k.json"

#: Unseen parts encoded as one text.
PARTS_AT_ONCE = 32

_CUT = re.compile(r"(?= \S)")
_ODD = re.compile(r" (?:\s|\Z)")

#: Texts with white space before or after a space, or a space at an end, are cut by _CUT.
SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_TEXT = rf"^ | [{SPACES}]| $"


class ByteBpe:
    """Encodes texts to 16-bit ids."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, place in names.items():  # in byte-level vocabularies a character stands for a byte
            self.width[place] = len(name)
        self.parts = PartIds(self._learn, self._whole)

    def _has_special(self, text: str) -> bool:
        return any(token in text for token in self.special)

    def _whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, parts: pa.Array) -> pa.Array:
        """Ids of parts that follow a space."""
        given = parts.to_numpy(zero_copy_only=False).tolist()
        cuts = [given[at : at + PARTS_AT_ONCE] for at in range(0, len(given), PARTS_AT_ONCE)]
        joined = [" " + " ".join(some) for some in cuts]
        plain = [not (self._has_special(text) or _ODD.search(text)) for text in joined]
        encoded = iter(self.tokenizer.encode_batch_fast([t for t, p in zip(joined, plain, strict=True) if p], add_special_tokens=False))
        out = []
        for place, some in enumerate(cuts):
            if plain[place]:
                out.append(np.array(next(encoded).ids, "<u2"))
            else:
                out.append(np.frombuffer(b"".join([self._whole(" " + part) for part in some]), "<u2"))
        ids = np.concatenate(out)
        ends = np.cumsum(pc.binary_length(parts).to_numpy().astype(np.int64) + 1)
        offsets = np.append(0, 2 * np.searchsorted(np.cumsum(self.width[ids]), ends, side="right")).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])

    def _odd(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([self._whole(part) for part in _CUT.split(text)]), "<u2")

    def encode_many(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order; a null text has none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD_TEXT)
        plain = self.parts.encode(texts.filter(pc.invert(odd)))
        for place, is_odd in enumerate(odd.to_pylist()):
            yield self._odd(texts[place].as_py()) if is_odd else next(plain)


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str | None = None) -> ByteBpe:
    """One encoder for each Python worker."""
    return ByteBpe(vocabulary_path(vocabulary, VOCABULARY))
