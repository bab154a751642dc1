"""Terms of texts for matching and search: runs of ASCII letters and digits and of all that is not ASCII, A-Z lowered."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm.common import LOWER, prefix_hashes, range_hash, word_spans

#: Bytes of lowered terms: 0-9, a-z and every byte of a code point from U+0080 on.
IN_TERM = np.zeros(256, bool)
IN_TERM[0x30:0x3A] = IN_TERM[0x61:0x7B] = IN_TERM[0x80:] = True
#: What separates lowered terms, as a pattern.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lowered bytes; start, end and row of every term; and a 64-bit hash of each (a filter: equal hashes prove nothing)."""
    low = LOWER[data]
    start, end, row = word_spans(low, offs, IN_TERM[low])
    return low, start, end, row, range_hash(prefix_hashes(low), start, end)


#: Bits of a Bloom filter: so many a key, within these bounds, whatever the number of keys. The largest has 16 MB.
KEY_BITS, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27


def bloom(keys: DataFrame) -> np.ndarray:
    """A Bloom filter (two bits a key) of the only column of `keys`, 64-bit hashes; Spark sets the bits, the driver gets at most 16 MB."""
    h = F.col(keys.columns[0])
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (keys.count() * KEY_BITS).bit_length()))
    places = keys.select(F.explode(F.array(h.bitwiseAND(F.lit(n_bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(n_bits - 1)))).alias("i"))
    words = places.groupBy(F.shiftright("i", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(i & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(n_bits >> 6, np.uint64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def maybe_in(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; a key never fails."""
    mask, six, low = np.uint64(len(bits) * 64 - 1), np.uint64(6), np.uint64(63)
    i = h & mask
    out = (bits[i >> six] >> (i & low)) & np.uint64(1) != 0
    some = np.flatnonzero(out)
    i = (h[some] >> np.uint64(32)) & mask
    out[some] = (bits[i >> six] >> (i & low)) & np.uint64(1) != 0
    return out
