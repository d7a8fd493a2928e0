"""A wavelet matrix of integers in one compressed file: access, counting and occurrence look-up.

Plane by plane, from the highest bit, the bits of all values are written down and the values
are parted by that bit, zeros first, otherwise in order. Bits lie in blocks, each compressed on
its own, with the number of ones before it, so that a look-up opens one block for each plane.

File: MAGIC, four numbers (values, planes, rows of the side table, length of the directory),
the directory (compressed; ones before each block of each plane, zeros of each plane, end of
each block in the file), the side table (compressed Arrow), and the blocks.
"""

import struct

import numpy as np
import pyarrow as pa
import zstandard

MAGIC = b"EBBWM001"
HEAD = struct.Struct("<4q")
BLOCK_BITS = 1 << 16


def planes_of(largest: int) -> int:
    return max(1, int(largest).bit_length())


def packed(values: np.ndarray, planes: int, side: pa.Table) -> bytes:
    """The file's bytes: `values` as `planes` bit-planes, and a small table kept beside them."""
    blocks, ends, ones, zeros = [], [], [], []
    size = 0
    for plane in reversed(range(planes)):
        bits = (values >> plane & 1).astype(bool)
        raw = np.packbits(bits)
        before = [0]
        for start in range(0, len(values), BLOCK_BITS):
            block = zstandard.compress(raw[start // 8 : (start + BLOCK_BITS) // 8].tobytes())
            blocks.append(block)
            size += len(block)
            ends.append(size)
            before.append(before[-1] + int(bits[start : start + BLOCK_BITS].sum()))
        ones.append(before)
        zeros.append(len(values) - before[-1])
        values = np.concatenate([np.compress(~bits, values), np.compress(bits, values)])
    numbers = np.concatenate([np.ravel(ones), zeros, ends]).astype("<i8")
    directory = zstandard.compress(numbers.tobytes())
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, side.schema) as out:
        out.write_table(side)
    table = zstandard.compress(sink.getvalue().to_pybytes())
    head = HEAD.pack(len(values), planes, len(table), len(directory))
    return b"".join([MAGIC, head, directory, table, *blocks])


class WaveletMatrix:
    """The values of a packed file."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of this format")
        at = len(MAGIC) + HEAD.size
        self.size, self.planes, table, directory = HEAD.unpack_from(data, len(MAGIC))
        numbers = np.frombuffer(zstandard.decompress(data[at : at + directory]), "<i8")
        self.blocks = -(-self.size // BLOCK_BITS)
        cut = self.planes * (self.blocks + 1)
        self.ones = numbers[:cut].reshape(self.planes, self.blocks + 1)
        self.zeros = numbers[cut : cut + self.planes]
        self.ends = numbers[cut + self.planes :]
        self.side = pa.ipc.open_stream(zstandard.decompress(data[at + directory : at + directory + table])).read_all()
        self.data, self.first = memoryview(data), at + directory + table
        self.open: dict[tuple[int, int], np.ndarray] = {}

    def bits(self, plane: int, block: int) -> np.ndarray:
        """One block, uncompressed."""
        n = plane * self.blocks + block
        start = self.first + (int(self.ends[n - 1]) if n else 0)
        raw = zstandard.decompress(self.data[start : self.first + int(self.ends[n])])
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=min(BLOCK_BITS, self.size - block * BLOCK_BITS))

    def block(self, plane: int, block: int) -> np.ndarray:
        """One block, kept open for the next look-up."""
        if (plane, block) not in self.open:
            if len(self.open) >= 4 * self.planes:
                self.open.clear()
            self.open[plane, block] = self.bits(plane, block)
        return self.open[plane, block]

    def ones_before(self, plane: int, place: int) -> int:
        block, rest = divmod(place, BLOCK_BITS)
        return int(self.ones[plane, block]) + (int(self.block(plane, block)[:rest].sum()) if rest else 0)

    def access(self, place: int) -> int:
        """The value at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for plane in range(self.planes):
            bit = int(self.block(plane, place // BLOCK_BITS)[place % BLOCK_BITS])
            ones = self.ones_before(plane, place)
            place = int(self.zeros[plane]) + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a value inside [start, end) lie after the last plane."""
        if value >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            left, right = self.ones_before(plane, start), self.ones_before(plane, end)
            if value >> (self.planes - 1 - plane) & 1:
                start, end = int(self.zeros[plane]) + left, int(self.zeros[plane]) + right
            else:
                start, end = start - left, end - right
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often a value comes in [start, end)."""
        low, high = self._range(value, start, self.size if end is None else end)
        return high - low

    def select(self, value: int, nth: int) -> int:
        """The place of the nth occurrence, from 0."""
        low, high = self._range(value, 0, self.size)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        place = low + nth
        for plane in reversed(range(self.planes)):
            place = self._nth(plane, value >> (self.planes - 1 - plane) & 1, place)
        return place

    def _nth(self, plane: int, bit: int, place: int) -> int:
        """Where the bit that went to `place` in the next plane stands in this one."""
        ones = self.ones[plane]
        before = ones if bit else np.minimum(np.arange(self.blocks + 1) * BLOCK_BITS, self.size) - ones
        nth = place - int(self.zeros[plane]) if bit else place
        block = int(np.searchsorted(before, nth, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self.block(plane, block) == bit)[nth - int(before[block])])

    def values(self) -> np.ndarray:
        """All values in order: from the last plane up, each parting is undone."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        values = np.zeros(self.size, kind)
        for plane in reversed(range(self.planes)):
            parts = [self.bits(plane, b) for b in range(self.blocks)]
            bits = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
            zeros = int(self.zeros[plane])
            whole = np.empty_like(values)
            whole[np.flatnonzero(~bits)] = values[:zeros]
            whole[np.flatnonzero(bits)] = values[zeros:] | kind(1 << (self.planes - 1 - plane))
            values = whole
        return values
