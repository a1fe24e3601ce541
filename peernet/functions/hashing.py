"""Node id digests: the original Keccak-256 over public keys, and any other digest in its place."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

Digest = Callable[[Column], Column]

_RATE = 136
# Keccak-f[1600] round constants and rotation offsets (lane x + 5y).
_ROUND_CONSTANTS = np.array(
    [
        0x0000000000000001, 0x0000000000008082, 0x800000000000808A, 0x8000000080008000,
        0x000000000000808B, 0x0000000080000001, 0x8000000080008081, 0x8000000000008009,
        0x000000000000008A, 0x0000000000000088, 0x0000000080008009, 0x000000008000000A,
        0x000000008000808B, 0x800000000000008B, 0x8000000000008089, 0x8000000000008003,
        0x8000000000008002, 0x8000000000000080, 0x000000000000800A, 0x800000008000000A,
        0x8000000080008081, 0x8000000000008080, 0x0000000080000001, 0x8000000080008008,
    ],
    dtype=np.uint64,
)
_ROTATIONS = (
    0, 1, 62, 28, 27,
    36, 44, 6, 55, 20,
    3, 10, 43, 25, 39,
    41, 45, 15, 21, 8,
    18, 2, 61, 56, 14,
)


def _rotl(lane: np.ndarray, n: int) -> np.ndarray:
    return lane if n == 0 else (lane << np.uint64(n)) | (lane >> np.uint64(64 - n))


def _permute(a: list[np.ndarray]) -> list[np.ndarray]:
    """24 rounds over 25 lanes, each lane an array with one entry per message."""
    for constant in _ROUND_CONSTANTS:
        parity = [a[x] ^ a[x + 5] ^ a[x + 10] ^ a[x + 15] ^ a[x + 20] for x in range(5)]
        tilt = [parity[(x + 4) % 5] ^ _rotl(parity[(x + 1) % 5], 1) for x in range(5)]
        b: list[np.ndarray] = [a[0]] * 25
        for y in range(5):
            for x in range(5):
                b[y + 5 * ((2 * x + 3 * y) % 5)] = _rotl(a[x + 5 * y] ^ tilt[x], _ROTATIONS[x + 5 * y])
        a = [b[i] ^ (~b[(i % 5 + 1) % 5 + i // 5 * 5] & b[(i % 5 + 2) % 5 + i // 5 * 5]) for i in range(25)]
        a[0] = a[0] ^ constant
    return a


def keccak256_batch(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """n x 32 bytes of digests; message i is data[ends[i]:ends[i + 1]]. Messages of equal length are done together."""
    lengths = np.diff(ends)
    out = np.empty((len(lengths), 32), np.uint8)
    for length in np.unique(lengths):
        members = np.flatnonzero(lengths == length)
        blocks = int(length) // _RATE + 1
        padded = np.zeros((len(members), blocks * _RATE), np.uint8)
        padded[:, :length] = data[ends[members][:, None] + np.arange(length)]
        padded[:, length] = 0x01
        padded[:, -1] |= 0x80
        words = padded.view("<u8").reshape(len(members), blocks, _RATE // 8)
        state = [np.zeros(len(members), np.uint64) for _ in range(25)]
        for block in range(blocks):
            for lane in range(_RATE // 8):
                state[lane] = state[lane] ^ words[:, block, lane]
            state = _permute(state)
        out[members] = np.stack(state[:4], axis=1).astype("<u8").view(np.uint8)
    return out


@F.pandas_udf(BinaryType())
def _keccak256(keys: pd.Series) -> pd.Series:
    present = keys.notna().to_numpy()
    result = pd.Series([None] * len(keys), index=keys.index, dtype=object)
    if present.any():
        messages = keys[present]
        ends = np.concatenate([[0], np.cumsum(messages.str.len().to_numpy(np.int64))])
        digests = keccak256_batch(np.frombuffer(b"".join(messages), np.uint8), ends)
        result[present] = np.frombuffer(digests.tobytes(), "V32").tolist()
    return result


def keccak256_hex(key: Column) -> Column:
    """Keccak-256 (original padding, not SHA3) of the bytes of a hex text, as hex; NULL if the text is no hex."""
    return F.lower(F.hex(_keccak256(F.unhex(key))))


def sha256_hex(key: Column) -> Column:
    """SHA-256 stand-in with the same shape, for checks against engines without Keccak."""
    return F.sha2(F.unhex(key), 256)
