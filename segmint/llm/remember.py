"""What a worker remembers of texts' pieces, compared by their bytes: the pieces of all batches, each encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def spans(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` (any fixed-width numbers) as an Arrow array; ``bounds`` has every border."""
    bounds = np.ascontiguousarray(bounds.astype(np.int64) * data.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


class Memory:
    """Values of pieces, at most ``most`` of them, of up to ``longest`` bytes; beyond that it starts anew."""

    def __init__(self, make: Callable[[list[bytes]], pa.Array], most: int, longest: int = 64):
        self.make, self.most, self.longest = make, most, longest
        self.known = pa.array([], pa.large_binary())
        self.values = make([])

    def look_up(self, pieces: pa.Array) -> pa.Array:
        """The value of each of ``pieces``; ``make`` is asked once for each distinct one that is not known."""
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        if len(self.known) + len(distinct) > self.most:
            self.known, self.values = self.known[:0], self.values[:0]
        slot = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new, values = np.flatnonzero(slot < 0), self.values
        if len(new):
            # remembered ones first, so that the others can be left out afterwards
            long = pc.binary_length(distinct).to_numpy()[new] > self.longest
            new = new[np.argsort(long, kind="stable")]
            parts = distinct.take(pa.array(new))
            made = self.make(parts.to_pylist())
            slot[new] = len(values) + np.arange(len(new))
            kept = len(new) - int(long.sum())
            self.known = pa.concat_arrays([self.known, parts[:kept]])
            self.values = pa.concat_arrays([values, made[:kept]])
            values = self.values if kept == len(new) else pa.concat_arrays([values, made])
        return values.take(pa.array(slot[coded.indices.to_numpy()]))
