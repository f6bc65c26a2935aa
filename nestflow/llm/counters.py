"""Arrays of small counters that tell which keys can have a partner, before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nestflow.llm.common import in_arrow, partitions

#: Counters that are summed as one row; a place in them is two bytes.
SLICE = 1 << 16
POSITIONS = "slice long, places binary"
#: Counters of one key.
HASHES = 3
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _place(keys: np.ndarray, counters: int, k: int) -> np.ndarray:
    """Where the key's ``k``-th counter is."""
    place = keys * np.uint64(_ODD[k])
    place >>= np.uint64(64 - counters.bit_length() + 1)
    return place.view(np.int64)


def positions(keys: Iterator[np.ndarray], counters: int) -> Iterator[pa.RecordBatch]:
    """Keys as rows (``POSITIONS``) to be summed: slice, its places in order, those found more than once twice."""
    held: list[np.ndarray] = []
    size = 0

    def ended() -> pa.RecordBatch:
        places = np.sort(np.concatenate(held))
        if len(places) > 2:  # a third one and more say nothing new
            places = places[np.concatenate([[True, True], places[2:] != places[:-2]])]
        number = places // np.uint32(SLICE)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1])
        offsets = pa.py_buffer((2 * np.append(cuts, len(places))).astype("<i4"))
        own = pa.Array.from_buffers(pa.binary(), len(cuts), [None, offsets, pa.py_buffer((places % np.uint32(SLICE)).astype("<u2"))])
        return pa.RecordBatch.from_arrays([pa.array(number[cuts].astype(np.int64)), own], names=["slice", "places"])

    for own in keys:
        held += [_place(own, counters, k).astype(np.uint32) for k in range(HASHES)]  # counters are fewer than 2 ** 32
        size += HASHES * len(own)
        if size > 4_000_000:
            yield ended()
            held, size = [], 0
    if size:
        yield ended()


class Counts:
    """How often keys occur, up to the most that ``bits`` (1 or 2) bits hold.

    A key has ``HASHES`` counters and its count is the least of them; keys that share a
    counter are counted together there, so a count is never too low.  ``rows`` are ``positions`` of all tasks; the driver
    gets the filled slices, ``counters * bits / 8`` bytes at most, to broadcast.
    """

    def __init__(self, rows: DataFrame, counters: int, bits: int) -> None:
        self.counters, self.bits = counters, bits
        self.slices: dict[int, np.ndarray] = {}
        top = (1 << bits) - 1

        def summed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in found:
                for number, places in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if number not in sums:
                        sums[number] = np.zeros(SLICE, dtype=np.uint8)
                    own, at = sums[number], np.frombuffer(places.as_buffer(), "<u2")
                    for once in (at, at[1:][at[1:] == at[:-1]]):
                        own[once] = np.minimum(own[once] + 1, top)
            for number, own in sums.items():
                packed = sum(own[k::8 // bits] << (bits * k) for k in range(8 // bits)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([packed.tobytes()], pa.binary())], names=["slice", "counters"])

        dealt = rows.repartition(partitions(rows.sparkSession), "slice")
        # Bounded: counters * bits / 8 bytes, which stay in Arrow's buffers: rows would be copied several times.
        found = in_arrow(dealt, summed, "slice long, counters binary").toArrow()
        for number, packed in zip(found.column(0).to_pylist(), found.column(1)):
            self.slices[number] = np.frombuffer(packed.as_buffer(), np.uint8)

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_whole"):
            self._whole = self._joined()
        per, top = 8 // self.bits, np.uint8((1 << self.bits) - 1)
        shifts = np.arange(0, 8, self.bits, dtype=np.uint8)

        def found(keys: np.ndarray, k: int) -> np.ndarray:
            place = _place(keys, self.counters, k)
            out = self._whole[place >> per.bit_length() - 1]
            place &= per - 1
            out >>= shifts[place]
            out &= top
            return out

        out = found(keys, 0)
        left = np.flatnonzero(out)  # most keys that never occur are told by the first
        for k in range(1, HASHES):
            out[left] = np.minimum(out[left], found(keys[left], k))
            left = left[out[left] > 0]
        return out

    def _joined(self) -> np.ndarray:
        whole = np.zeros(self.counters * self.bits // 8, dtype=np.uint8)
        for number, packed in self.slices.items():
            whole[number * len(packed):(number + 1) * len(packed)] = packed
        return whole

    def __getstate__(self) -> dict:
        return {"counters": self.counters, "bits": self.bits, "slices": self.slices}

    def __setstate__(self, state: dict) -> None:
        """A task only looks keys up: it holds the joined array and not the slices beside it."""
        self.__dict__.update(state)
        self._whole = self._joined()
        self.slices = {}
