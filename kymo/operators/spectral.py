"""Relational DFT and autocorrelation on stored windows (one row per position)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from kymo.session import ship

#: Zero-padded transform length, and bins of 0.5 to 5 Hz at 25 Hz.
N_FFT, FIRST_BIN, LAST_BIN = 256, 6, 51


def spectrum(df: DataFrame, key: str, pos: str, x: str, n: int) -> DataFrame:
    """``key, k, magnitude``: centred, Hamming-weighted DFT magnitudes of the band's bins.

    All bins of a window come from one grouped aggregation (two sums a bin over
    constant twiddles of the position), so no join multiplies the rows.
    """
    w = Window.partitionBy(key)
    v = (F.col(x) - F.avg(x).over(w)) * (0.54 - 0.46 * F.cos(F.lit(2 * math.pi) * F.col(pos) / (n - 1)))
    d = df.select(key, F.col(pos).alias("p"), v.alias("v"))
    sums = []
    for k in range(FIRST_BIN, LAST_BIN + 1):
        angle = F.lit(2 * math.pi * k / N_FFT) * F.col("p")
        sums.append(F.struct(F.lit(k).alias("k"), F.sum(F.col("v") * F.cos(angle)).alias("re"), F.sum(F.col("v") * F.sin(angle)).alias("im")))
    s = d.groupBy(key).agg(F.array(*sums).alias("s")).select(key, F.explode("s").alias("s"))
    return s.select(key, "s.k", F.sqrt(F.col("s.re") * F.col("s.re") + F.col("s.im") * F.col("s.im")).alias("magnitude"))


def autocorrelation_peak(df: DataFrame, values: Column, low: int, high: int) -> Column:
    """Largest normalised autocorrelation of an array over the lags ``low..high``; windows of one length are one matrix a batch.

    A null window and one without spread give 0; lags beyond the window count as 0.
    """
    ship(df.sparkSession)

    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.zeros(len(s))
            lengths = s.map(lambda v: 0 if v is None else len(v)).to_numpy()
            for n in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == n)
                c = np.stack(s.iloc[at].to_list()).astype(float)
                c -= c.mean(axis=1, keepdims=True)
                r0 = (c * c).sum(axis=1)
                r = np.stack([(c[:, : n - k] * c[:, k:]).sum(axis=1) if k < n else np.zeros(len(c)) for k in range(low, high + 1)])
                out[at] = np.where(r0 > 0, r.max(axis=0) / np.where(r0 > 0, r0, 1.0), 0.0)
            yield pd.Series(out)

    return run(values)
