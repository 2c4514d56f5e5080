"""What several text operators share.

Words are runs of bytes other than the six ASCII spaces, so that ``bytes.split``
finds them; ``bytes.lower`` changes A-Z alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; -1 for null."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus)), F.lit(-1))


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.binary()).to_pylist()


def hashed_order(*columns: str) -> Column:
    """An order that looks random and that other SQL engines can compute as well."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns]))


_U = np.uint64
_STEP, _BACK = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = _U(0xE7037ED1A0B428DB)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for at, factor in enumerate((_STEP, _BACK)):
            table = np.full(max(n, 5 << 18), factor, _U)
            table[0] = 1
            _powers[at] = np.cumprod(table)
    return _powers[0][:n], _powers[1][:n]


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and how many each text has.

    A word's hash is the polynomial of its bytes, taken as the difference of two
    prefix sums over all texts, so no word becomes a Python object.
    """
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer((b"\n".join(t or b"" for t in texts) + b"\n").lower() if texts else b"", np.uint8)
    space = _IS_SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=1)
    start, stop = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    value = (sums[stop] - sums[start]) * down[start]
    value = (value ^ (value >> _U(32)) ^ (stop - start).astype(_U)) * _MIX
    ends = np.searchsorted(start, np.cumsum(sizes))
    return value ^ (value >> _U(29)), np.diff(ends, prepend=0)


def chunked(texts: list[bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together; a longer text is one of its own."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text or b"") > limit:
            yield start, at
            start, held = at, 0
        held += len(text or b"")
    if start < len(texts):
        yield start, len(texts)
