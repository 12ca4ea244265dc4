"""64-bit hashes of byte ranges for many ranges at once (numpy)."""

from __future__ import annotations

BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2^64


def _tables(n: int):
    """Random values for the byte values; powers of the base and its inverse."""
    import numpy as np

    values = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    power, inverse = (np.full(n + 1, b, np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64)))
    power[0] = inverse[0] = 1
    with np.errstate(over="ignore"):
        return values, np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


def mix(x):
    """A bijective scrambling of uint64 numbers."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fold(parts):
    """One hash of several uint64 arrays, in order."""
    import numpy as np

    out = np.uint64(0x51ED270B)
    with np.errstate(over="ignore"):
        for part in parts:
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out


class Roller:
    """Makes :class:`Rolling` objects; keeps the tables between calls."""

    def __init__(self):
        self.size, self.tables = 0, None

    def __call__(self, data) -> Rolling:
        if len(data) >= self.size:
            self.size = 1 << max(16, (len(data) + 1).bit_length())
            self.tables = _tables(self.size)
        return Rolling(data, self.tables)


class Rolling:
    """Hashes of ranges of one byte array; equal bytes have equal hashes."""

    def __init__(self, data, tables):
        import numpy as np

        n = len(data)
        values, power, self.inverse = tables
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values[data] * power[:n], out=self.sums[1:])

    def ranges(self, start, end):
        import numpy as np

        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, size: int):
        """Of all ranges of ``size`` bytes, by start; not scrambled."""
        import numpy as np

        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:n]) * self.inverse[:n]
