"""Sequence heuristics: hydropathy, membrane spans, signal peptides and lipoboxes."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kyte-Doolittle hydropathy. Fixed values.
HYDROPATHY = {
    "A": 1.8, "R": -4.5, "N": -3.5, "D": -3.5, "C": 2.5, "Q": -3.5, "E": -3.5, "G": -0.4, "H": -3.2, "I": 4.5,
    "L": 3.8, "K": -3.9, "M": 1.9, "F": 2.8, "P": -1.6, "S": -0.8, "T": -0.7, "W": -0.9, "Y": -1.3, "V": 4.2,
}
WINDOW, THRESHOLD, CORE = 19, 1.6, 9


def clean_sequence(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"[\s*]", ""))


def stops(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\*"))


_TENTHS = np.zeros(256, np.int64)
for _letter, _value in HYDROPATHY.items():
    _TENTHS[ord(_letter)] = round(_value * 10)


def hydrophobic_spans(sequence: str, window: int = WINDOW, threshold: float = THRESHOLD, core: int = CORE) -> list[tuple[int, int]]:
    """(start, end) of the hydrophobic cores of one sequence, one-based: a window above the threshold
    speaks for its centre, centres in a row form a span. Running sums, so that a residue is touched
    a fixed number of times whatever the window's width; letters beyond the scale count zero."""
    letters = np.frombuffer(sequence.encode("latin-1", "replace"), np.uint8)
    if len(letters) < window:
        return []
    sums = np.concatenate([[0], np.cumsum(_TENTHS[letters])])
    hit = sums[window:] - sums[:-window] >= round(threshold * 10 * window, 6)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2)
    return [(int(a) + window // 2 + 1, int(b) + window // 2) for a, b in edges if b - a >= core]


def membrane_spans(df: DataFrame, sequence: str = "sequence", window: int = WINDOW, threshold: float = THRESHOLD, core: int = CORE) -> DataFrame:
    """``df`` with ``spans``: array of (start, end) of ``hydrophobic_spans``; null without a sequence."""

    @F.pandas_udf("array<struct<start: int, end: int>>")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda s: None if s is None else [{"start": a, "end": b} for a, b in hydrophobic_spans(s, window, threshold, core)])

    return df.withColumn("spans", run(F.col(sequence)))


def _hydrophobic_core(s: str) -> tuple[int, int, float] | None:
    """Most hydrophobic uncharged stretch of 8 to 21 residues starting at residues 3 to 18."""
    limit, found = min(len(s), 45), None
    for start in range(3, min(18, limit) + 1):
        stretch = 0
        while start - 1 + stretch < limit and stretch < 21 and s[start - 1 + stretch] not in "DEKRHNQP":
            stretch += 1
        total = 0.0
        for n in range(1, stretch + 1):
            total += HYDROPATHY.get(s[start + n - 2], 0.0)
            mean = total / n
            if n >= 8 and mean >= 2.2 and (found is None or mean > found[2]):
                found = (start, start + n - 1, round(mean, 2))  # the kept mean has two digits
    return found


def targeting(sequences: Column) -> Column:
    """Struct (signal, cleavage, lipoprotein, cysteine) from the first 45 residues, by a
    vectorised Python function: the search over stretches has no compact SQL form."""
    box = re.compile(r"[LVI][ASTVIG][GAS]C")

    @F.pandas_udf("signal boolean, cleavage int, lipoprotein boolean, cysteine int")
    def run(column: pd.Series) -> pd.DataFrame:
        rows = []
        for s in column.fillna(""):
            core = _hydrophobic_core(s)
            cut = cysteine = 0
            if core and len(s) >= 30 and set("KR") & set(s[:12]):
                sites = range(max(14, core[1] + 3), min(45, len(s)) + 1)
                cut = next((i for i in sites if s[i - 1] in "AGSCT" and s[i - 3] in "AGSCT"), 0)
            if core:
                ends = (m.end() for m in box.finditer(s[:45]))
                cysteine = next((e for e in ends if e >= 12 and core[0] + 3 <= e <= core[1] + 8), 0)
            rows.append((cut > 0, cut, cysteine > 0, cysteine))
        return pd.DataFrame(rows, columns=["signal", "cleavage", "lipoprotein", "cysteine"])

    return run(sequences)
