"""64-bit similarity fingerprints, as signed longs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from khabarloom.functions.runs import tokens
from khabarloom.functions.text import bind, runs, tokenize

_SHIFTS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint_of(text: str) -> int:
    """Sign of the bit votes of all three-token runs, each hashed to 8 bytes; ties are 0, no runs give 0."""
    words = tokens(text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    if not grams:
        return 0
    digest = b"".join(blake2b(g.encode(), digest_size=8).digest() for g in grams)
    bits = np.unpackbits(np.frombuffer(digest, np.uint8).reshape(len(grams), 8), axis=1)
    set_ = 2 * bits.sum(axis=0, dtype=np.int64) > len(grams)
    return int.from_bytes(np.packbits(set_).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprint of each text, NULL as an empty one."""
    for t in texts:
        yield t.map(lambda x: fingerprint_of(x or ""), na_action=None)


def md5_hash(gram: Column) -> Column:
    """The first 8 bytes of the MD5 digest."""
    return F.conv(F.substring(F.md5(gram), 1, 16), 16, -10).cast("long")


def _adds_bit(i: int) -> Callable[[Column, Column], Column]:
    return lambda n, h: n + F.getbit(h, F.lit(i)).cast("int")


def simhash_md5(text: Column) -> Column:
    """The same fold over MD5 digests, without leaving the JVM."""

    def fold(hashes: Column) -> Column:
        out = F.lit(0).cast("long")
        for i in range(64):
            ones = F.aggregate(hashes, F.lit(0), _adds_bit(i))
            out = out.bitwiseOR(F.when(2 * ones > F.size(hashes), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return out

    return bind(F.transform(runs(tokenize(text)), md5_hash), fold)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
