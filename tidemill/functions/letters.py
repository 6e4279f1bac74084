"""Letters of a text, counted in one look at its bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_counts(text: Column, letters: str) -> Column:
    """``array<int>``: how often each of ``letters`` (of one or two bytes in UTF-8) occurs in the text."""
    codes = [c.encode() for c in letters]
    if any(len(c) > 2 for c in codes):
        raise ValueError("a letter takes more than two bytes")
    plain = np.array([len(c) == 1 for c in codes])
    first, last = np.array([c[0] for c in codes]), np.array([c[-1] for c in codes])
    leads = [int(b) for b in np.unique(first[~plain])]

    @F.pandas_udf("array<int>")
    def counted(texts: pd.Series) -> pd.Series:
        out = []
        for whole in texts:
            if whole is None:
                out.append(None)
                continue
            data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
            found = np.bincount(data, minlength=256)[last]
            # no other character has the first byte of two-byte letters within it
            for lead in leads:
                seconds = np.bincount(data[np.flatnonzero(data[:-1] == lead) + 1], minlength=256)
                found = np.where(~plain & (first == lead), seconds[last], found)
            out.append(found.astype(np.int32))
        return pd.Series(out, dtype=object)

    return counted(text)
