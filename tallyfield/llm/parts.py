"""Token ids of many texts from the ids of their parts, each distinct part encoded once.

Arrow cuts the texts at spaces, numbers the distinct parts, looks them up among those known, and
lays the parts' ids out in text order. Python sees unseen parts only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts kept by one Python worker unless it is told otherwise; those not seen for longest go first.
CACHE_PARTS = 400_000

#: Bytes of text laid out at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


class PartIds:
    """learn(parts) gives the 16-bit ids of each part; first(part) those of a text's first part."""

    def __init__(
        self, learn: Callable[[pa.Array], pa.Array], first: Callable[[str], bytes] | None = None,
        most: int | None = None,
    ):
        self.learn, self.first, self.most = learn, first, most
        self.keys, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (no nulls), in order."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(texts):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
            yield from self._slice(texts.slice(begin, end - begin))
            begin = end

    def _known(self, parts: pa.Array) -> pa.Array:
        """Ids of distinct parts, which then stand first in the cache."""
        found = pc.index_in(parts, value_set=self.keys)
        places, unseen = found.fill_null(-1).to_numpy().copy(), parts.filter(found.is_null())
        places[places < 0] = len(self.keys) + np.arange(len(unseen))
        learned = self.learn(unseen) if len(unseen) else self.ids.slice(0, 0)
        ids = pa.concat_arrays([self.ids, learned]).take(pa.array(places))
        most = self.most or CACHE_PARTS
        rest = np.ones(len(self.keys), bool)
        rest[places[places < len(rest)]] = False
        kept = pa.array(np.flatnonzero(rest)[: max(0, most - len(parts))])
        self.keys = pa.concat_arrays([parts.slice(0, most), self.keys.take(kept)])
        self.ids = pa.concat_arrays([ids.slice(0, most), self.ids.take(kept)])
        return ids

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().cast(pa.string()).dictionary_encode()
        parts, codes = coded.dictionary, coded.indices
        ids = self._known(parts)
        if self.first:
            heads, codes = bounds[:-1], codes.to_numpy().copy()
            own = [self.first(part) for part in parts.take(pa.array(codes[heads])).to_pylist()]
            ids = pa.concat_arrays([ids, pa.array(own, pa.large_binary())])
            codes[heads] = np.arange(len(parts), len(ids))
            codes = pa.array(codes)
        # Taking byte strings lays their bytes out one after another.
        laid = ids.take(codes)
        edges = np.frombuffer(laid.buffers()[1], np.int64)[bounds] >> 1
        flat = np.frombuffer(laid.buffers()[2] or b"", "<u2")
        return [flat[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
