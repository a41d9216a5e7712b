"""A bounded filter for the rows that a join will keep, so that the others aren't moved.

The filter is a bitmap of ``BITS`` bits, 4 MB, whatever the number of keys: it is built in
pages on the executors and is the only thing that is broadcast. It lets every wanted row
pass and few others while there are far fewer keys than bits; with more keys it lets more
rows pass and the join that follows does the work alone. It never decides a result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.text import built
from framesift.workspace import ship_package

BITS = 1 << 25
PAGE = 1 << 16


def _packed(positions: pd.Series) -> pd.Series:
    def page(at):
        bits = np.zeros(PAGE, dtype=np.uint8)
        bits[np.asarray(at, dtype=np.int64)] = 1
        return np.packbits(bits).tobytes()

    return positions.map(page)


class Filter:
    """Bitmap of the values of one long column, which must be hashes: their low bits are
    the place in the bitmap."""

    def __init__(self, keys: DataFrame, column: str):
        ship_package(keys.sparkSession)
        place = keys.select(F.pmod(F.col(column), F.lit(BITS)).alias("place"))
        pages = (
            place.select((F.col("place") / PAGE).cast("int").alias("page"), (F.col("place") % PAGE).cast("int").alias("at"))
            .distinct()
            .groupBy("page")
            .agg(F.collect_list("at").alias("at"))  # at most PAGE of them
            .select("page", F.pandas_udf(_packed, "binary")("at").alias("bits"))
        )
        bits = np.zeros(BITS // 8, dtype=np.uint8)
        for page, packed in pages.collect():  # 4 MB at most
            bits[page * PAGE // 8 : (page + 1) * PAGE // 8] = np.frombuffer(packed, np.uint8)
        self.shared = keys.sparkSession.sparkContext.broadcast(bits)
        self.key = uuid.uuid4().hex

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """False for no hash that is among the keys. For use in tasks."""
        bits = built("filter", self.key, lambda: self.shared.value)
        at = hashes.view(np.int64) & np.int64(BITS - 1)
        return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1

    def may_have(self, column: Column | str) -> Column:
        """False for no row whose hash is among the keys."""

        @F.pandas_udf("boolean")
        def test(hashes: pd.Series) -> pd.Series:
            return pd.Series(self.has(hashes.to_numpy(dtype=np.int64)))

        return test(column)
