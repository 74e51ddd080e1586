"""String similarity scores as built-in Spark expressions (0–100)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_score(a: Column, b: Column) -> Column:
    """100 · (m − d) / m with d the Levenshtein distance and m the longer length; 100 for two empty strings."""
    m = F.greatest(F.length(a), F.length(b))
    d = F.levenshtein(a, b)
    return F.when(m == 0, F.lit(100.0)).otherwise(F.lit(100.0) * (m - d).cast("double") / m.cast("double"))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by the textbook dynamic programme written as nested ``aggregate``:
    the outer fold walks the characters of ``a`` carrying the previous DP row, the inner fold builds the next row
    cell by cell. Runs inside the JVM; meant for short strings (vocabulary words, distinct category values)."""
    lb = F.length(b)
    chars = F.split(a, "")

    def next_row(prev, ca):
        def cell(cur, j):
            match = F.element_at(prev, j) + 1                                    # DP[i-1][j-1] + 1
            skip = F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j))   # max(DP[i-1][j], DP[i][j-1])
            return F.concat(cur, F.array(F.when(ca == F.substring(b, j, 1), match).otherwise(skip)))

        return F.aggregate(F.sequence(F.lit(1), lb), F.array(F.lit(0)), cell)

    start = F.array_repeat(F.lit(0), lb + 1)
    last = F.aggregate(chars, start, next_row, lambda row: F.element_at(row, lb + 1))
    return F.when((F.length(a) == 0) | (lb == 0), F.lit(0)).otherwise(last)


def indel_score(a: Column, b: Column) -> Column:
    """Normalised Indel similarity 100 · 2·LCS / (|a| + |b|) (insertions and deletions only); 100 for two empty
    strings."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.lit(200.0) * lcs_length(a, b).cast("double") / total.cast("double"))


SCORERS = {"levenshtein": levenshtein_score, "indel": indel_score}
