"""Wavelet matrix: a sequence of symbols as bit planes with rank and select, and its compressed file."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"PWM1"
#: Bits between two stored ranks.
STEP = 512


class WaveletMatrix:
    """Plane p holds bit p (highest first) of each symbol, in the order that stable partitions by the planes before it left.

    access, rank and select take a step per plane: a position goes to zeros[p] + rank1 for a one, to rank0 for a zero.
    """

    def __init__(self, n: int, symbols: np.ndarray, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.symbols, self.planes, self.zeros, self.ranks = n, symbols, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        present = np.zeros(int(ids.max()) + 1 if n else 1, bool)
        present[ids] = True
        symbols = np.flatnonzero(present).astype(np.uint32)
        number = np.zeros(len(present), np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        number[symbols] = np.arange(len(symbols))
        now = number[ids]
        planes, zeros, ranks = [], [], []
        for p in range(max(0, len(symbols) - 1).bit_length() - 1, -1, -1):
            bit = (now & now.dtype.type(1 << p)) != 0
            packed = np.packbits(bit)
            planes.append(packed)
            zeros.append(n - int(np.count_nonzero(bit)))
            ranks.append(_ranks(packed))
            then = np.empty_like(now)
            then[: zeros[-1]], then[zeros[-1] :] = now[~bit], now[bit]
            now = then
        return cls(n, symbols, planes, zeros, ranks)

    def _rank1(self, p: int, i: int) -> int:
        block = i // STEP
        part = self.planes[p][block * STEP // 8 : (i + 7) // 8]
        return int(self.ranks[p][block]) + int(np.unpackbits(part, count=i - block * STEP).sum()) if i > block * STEP else int(self.ranks[p][block])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for p in range(len(self.planes)):
            bit = self.planes[p][i >> 3] >> (7 - (i & 7)) & 1
            ones = self._rank1(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return int(self.symbols[value])

    def _number(self, symbol: int) -> int:
        k = int(np.searchsorted(self.symbols, symbol))
        return k if k < len(self.symbols) and self.symbols[k] == symbol else -1

    def _range(self, symbol: int, i: int) -> tuple[int, int]:
        """Where the symbols equal to this one among the first i end up after the last plane."""
        number, low = self._number(symbol), 0
        if number < 0:
            return 0, 0
        for p in range(len(self.planes)):
            bit = number >> (len(self.planes) - 1 - p) & 1
            a, b = self._rank1(p, low), self._rank1(p, i)
            low, i = (self.zeros[p] + a, self.zeros[p] + b) if bit else (low - a, i - b)
        return low, i

    def rank(self, symbol: int, i: int) -> int:
        """How often an id occurs before place i."""
        low, high = self._range(symbol, i)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Place of occurrence k (from 0) of an id."""
        low, high = self._range(symbol, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i, number = low + k, self._number(symbol)
        for p in range(len(self.planes) - 1, -1, -1):
            bit = number >> (len(self.planes) - 1 - p) & 1
            i = self._select(p, i - self.zeros[p] if bit else i, bit)
        return i

    def _select(self, p: int, k: int, bit: int) -> int:
        before = self.ranks[p].astype(np.int64) if bit else np.minimum(np.arange(len(self.ranks[p])) * STEP, self.n) - self.ranks[p]
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[p][block * STEP // 8 : (block + 1) * STEP // 8], count=min(STEP, self.n - block * STEP))
        return block * STEP + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def decode(self) -> np.ndarray:
        """All ids, undoing the partitions from the last plane up."""
        now = np.zeros(self.n, np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32)
        for level, p in enumerate(range(len(self.planes) - 1, -1, -1)):
            bit = np.unpackbits(self.planes[p], count=self.n).view(bool)
            # `now` holds the lower bits in the order after plane p.
            up = np.empty_like(now)
            up[~bit] = now[: self.zeros[p]]
            up[bit] = now[self.zeros[p] :] | now.dtype.type(1 << level)
            now = up
        return self.symbols[now] if self.n else np.zeros(0, np.uint32)


def _ranks(packed: np.ndarray) -> np.ndarray:
    """Ones before each multiple of STEP."""
    ones = np.bitwise_count(packed).astype(np.int64)
    pad = -len(ones) % (STEP // 8)
    return np.r_[0, np.cumsum(np.pad(ones, (0, pad)).reshape(-1, STEP // 8).sum(axis=1))].astype(np.uint32)


_DOCS, _HEAD = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("length", "<u4")]), "<QIIB"


def write_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: magic, a header (ids, documents, symbols, planes), then a zstd frame of document table, symbols, zero
    counts, ranks and planes."""
    m = WaveletMatrix.build(ids)
    docs = np.zeros(len(doc_ids), _DOCS)
    docs["doc_id"], docs["null"], docs["length"] = [d or 0 for d in doc_ids], [d is None for d in doc_ids], lengths
    body = b"".join([docs.tobytes(), m.symbols.astype("<u4").tobytes(), np.array(m.zeros, "<u8").tobytes(), *(r.astype("<u4").tobytes() for r in m.ranks), *(p.tobytes() for p in m.planes)])
    return MAGIC + struct.pack(_HEAD, m.n, len(docs), len(m.symbols), len(m.planes)) + zstandard.ZstdCompressor(level=1).compress(body)


def read_shard(data: bytes) -> tuple[np.ndarray, WaveletMatrix]:
    """Document table and wavelet matrix of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    n, n_docs, n_symbols, n_planes = struct.unpack_from(_HEAD, data, 4)
    body = zstandard.ZstdDecompressor().decompress(data[4 + struct.calcsize(_HEAD) :])
    at = 0

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    docs, symbols, zeros = take(_DOCS, n_docs), take("<u4", n_symbols), take("<u8", n_planes).tolist()
    plane = (n + 7) // 8
    ranks = [take("<u4", -(-plane // (STEP // 8)) + 1) for _ in range(n_planes)]
    return docs, WaveletMatrix(n, symbols, [take(np.uint8, plane) for _ in range(n_planes)], zeros, ranks)
