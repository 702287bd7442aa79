"""Counter-based uniforms: randomness as a pure function of a row's logical key.

``F.rand(seed)`` depends on partitioning and task order, so a re-run, a
repartition or a lost executor would change the sample. Instead every random
choice (subsampling, window radius, negative draws, shuffles, init) is the md5
of ``salt|seed|key...`` mapped to [0, 1). The same expression is written for
DuckDB by :func:`sql_uniform`, which is what makes the draws checkable in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: 52 bits -> [0, 1), exact in a double
HEX_DIGITS = 13
TWO_POW_BITS = 4503599627370496.0


def _as_col(k) -> Column:
    if isinstance(k, Column):
        return k.cast("string")
    if isinstance(k, str):
        return F.col(k).cast("string")
    return F.lit(str(k))


def hash_key(salt: str, seed: int, *keys) -> Column:
    return F.concat_ws("|", F.lit(salt), F.lit(str(seed)), *[_as_col(k) for k in keys])


def uniform(salt: str, seed: int, *keys) -> Column:
    """Uniform double in [0, 1) from md5(salt|seed|k1|k2...).

    Declared non-nullable (the keys never are): otherwise Catalyst infers
    ``isnotnull`` filters from joins on derived keys and evaluates the md5
    once more per inferred filter."""
    hexpart = F.substring(F.md5(hash_key(salt, seed, *keys)), 1, HEX_DIGITS)
    return F.coalesce(F.conv(hexpart, 16, 10).cast("bigint") / F.lit(TWO_POW_BITS), F.lit(0.0))


def sql_uniform(salt: str, seed: int, *key_sql: str) -> str:
    """DuckDB twin of :func:`uniform`; ``key_sql`` are SQL expressions."""
    concat = " || '|' || ".join([f"'{salt}|{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in key_sql])
    return f"((('0x' || substr(md5({concat}), 1, {HEX_DIGITS}))::BIGINT) / {TWO_POW_BITS})"


_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
# rows hashed at a time: their words stay in a core's cache
_ROWS_AT_ONCE = 1 << 14


def _digits(values, n_digits: int):
    """ASCII of numbers that all have ``n_digits`` digits, one column a digit."""
    import numpy as np

    out = np.empty((n_digits, len(values)), np.uint8)
    for j in range(n_digits - 1, -1, -1):
        rest = values // 10
        out[j] = (values - rest * 10).astype(np.uint8) + 48
        values = rest
    return out


def _md5_52(words: list, n: int):
    """First 52 bits of the md5 of ``n`` one-block messages; a word is a number
    that all share or an array."""
    import numpy as np

    k = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
    a, b, c, d = (np.full(n, x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            g = 7 * i % 16
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        w = words[g]
        np.add(f, a, out=f)
        if isinstance(w, int):
            np.add(f, np.uint32((k[i] + w) & 0xFFFFFFFF), out=f)
        else:
            np.add(f, np.uint32(k[i]), out=f), np.add(f, w, out=f)
        np.left_shift(f, np.uint32(_SHIFTS[i]), out=t), np.right_shift(f, np.uint32(32 - _SHIFTS[i]), out=f)
        np.bitwise_or(f, t, out=f), np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    a += np.uint32(0x67452301)
    b += np.uint32(0xEFCDAB89)
    return (a.byteswap().astype(np.uint64) << np.uint64(20)) | (b.byteswap() >> np.uint32(12))


def task_uniforms(salt: str, seed: int, first: tuple, columns: list, last: list | None = None):
    """``uniform(salt, seed, *first, *columns, k)`` for every row of the integer
    arrays (NumPy or Arrow) ``columns`` and every ``k`` of ``last`` (no ``k`` if None), bit for bit,
    as an array (rows, len(last)): for tasks that draw many times a row. Rows whose
    keys have as many digits make messages of one layout, hashed side by side."""
    import numpy as np

    prefix = "|".join([salt, str(seed), *map(str, first)]).encode()
    tails = [b""] if last is None else [f"|{k}".encode() for k in last]
    n = len(columns[0])
    out = np.empty((n, len(tails)))
    size, shape, powers = [], np.zeros(n, np.int64), np.array([10**i for i in range(1, 20)], np.uint64)
    for col in columns:
        absent = col.is_null().to_numpy(zero_copy_only=False) if hasattr(col, "is_null") else np.zeros(n, bool)
        col = np.asarray(col.fill_null(0) if hasattr(col, "fill_null") else col, np.int64)
        mag = np.where(col < 0, np.uint64(0) - col.astype(np.uint64), col.astype(np.uint64))
        size.append(mag)
        many = np.searchsorted(powers, mag, side="right") + 1
        shape = shape * 64 + np.where(absent, 0, many * 2 + (col < 0))
    for code in np.unique(shape):
        group = np.flatnonzero(shape == code)
        layout = [int(code) >> 6 * (len(columns) - 1 - i) & 63 for i in range(len(columns))]
        for at in range(0, len(group), _ROWS_AT_ONCE):
            rows = group[at : at + _ROWS_AT_ONCE]
            text: list = list(prefix)  # a byte that all rows share, or an array of bytes
            for mag, x in zip(size, layout, strict=True):
                if not x:  # a key that is null is left out
                    continue
                text += b"|-" if x & 1 else b"|"
                text += list(_digits(mag[rows].astype(np.uint32 if x >> 1 < 10 else np.uint64), x >> 1))
            for j, tail in enumerate(tails):
                message = [*text, *tail, 0x80]
                if len(message) > 56:
                    raise ValueError("the key is too long for one block")
                message += [0] * (56 - len(message))
                message += ((len(text) + len(tail)) * 8).to_bytes(8, "little")
                out[rows, j] = _md5_52([_word(message[i : i + 4]) for i in range(0, 64, 4)], len(rows)) / TWO_POW_BITS
    return out


def _word(four: list):
    """Four bytes, lowest first, as a number, or an array if one of them differs by row."""
    import numpy as np

    shared = sum(x << 8 * i for i, x in enumerate(four) if isinstance(x, int))
    out = shared
    for i, x in enumerate(four):
        if not isinstance(x, int):
            out = (x.astype(np.uint32) << np.uint32(8 * i)) | (np.uint32(out) if isinstance(out, int) else out)
    return out
