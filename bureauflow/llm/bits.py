"""Bit sets of bounded size that keep most rows without a partner from being sent to a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_set(rows: DataFrame, column: str, most: int, each: int = 16) -> np.ndarray:
    """Two bits of every value of a bigint column, by its first bits and by those after them; `each` bits a value or more, 2 ** most at most
    (27 at most). It is gathered by words of 64, so it never exceeds its size."""
    power = max(10, min(most, (each * rows.count()).bit_length()))
    value = F.col(column)
    places = F.array(F.shiftrightunsigned(value, 64 - power), F.shiftrightunsigned(F.shiftleft(value, power), 64 - power))
    found = (
        rows.where(value.isNotNull())
        .select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << power >> 6, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def has_bit(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether both bits of each unsigned value are set."""
    power = (len(bits) * 8).bit_length() - 1
    out = np.ones(len(values), bool)
    for shifted in (values, values << np.uint64(power)):
        place = shifted >> np.uint64(64 - power)
        out &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
