"""Edit-distance joins by the pigeonhole principle.

A string is cut into ``k + 1`` segments; another within ``k`` edits holds at least one of them whole, at a place shifted by
at most ``k``. Segments of all strings form an inverted index; each string looks up its substrings of fitting length and
place, and the pairs found are verified with a banded edit distance. Long strings of a hot segment are spread by the join
itself (AQE splits skewed keys); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import map_batches


def segments(n: int, k: int) -> list[tuple[int, int]]:
    """``k + 1`` parts of a string of length ``n`` as (start, length), as even as can be, shorter ones first."""
    parts = k + 1
    short, longer = n // parts, n % parts
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def damerau(a: str, b: str, most: int) -> int | None:
    """Edits with swaps of neighbours (optimal string alignment) if at most ``most``; only a band of ``2 * most + 1`` is computed."""
    if abs(len(a) - len(b)) > most:
        return None
    big = most + 1
    before, last = None, {j: j for j in range(min(len(b), most) + 1)}
    for i in range(1, len(a) + 1):
        row = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                row[0] = i
                continue
            v = min(last.get(j, big) + 1, row.get(j - 1, big) + 1, last.get(j - 1, big) + (a[i - 1] != b[j - 1]))
            if before is not None and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, before.get(j - 2, big) + 1)
            row[j] = v
        if min(row.values()) > most:
            return None
        before, last = last, row
    d = last.get(len(b), big)
    return d if d <= most else None


def near_pairs(strings: DataFrame, column: str, most: int = 1, least_length: int = 4) -> DataFrame:
    """``a, b, distance`` for all pairs ``a < b`` of the distinct strings within ``most`` edits, swaps counting as one.

    Null and short strings are in no pair. A swap can damage two segments, so ``2 * most + 1`` of them are cut.
    """
    k = 2 * most
    distinct = strings.select(F.col(column).alias("s")).where(F.length("s") >= max(least_length, k + 1)).distinct()

    def index(batches):
        for (values,) in batches:
            out = [(len(s), i, s[at : at + size], s) for s in values for i, (at, size) in enumerate(segments(len(s), k))]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out], [x[3] for x in out]

    def probe(batches):
        for (values,) in batches:
            out = set()
            for s in values:
                for n in range(max(k + 1, len(s) - most), len(s) + 1):
                    for i, (at, size) in enumerate(segments(n, k)):
                        for p in range(max(0, at - most), min(len(s) - size, at + most) + 1):
                            out.add((n, i, s[p : p + size], s))
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out], [x[3] for x in out]

    left = map_batches(distinct, index, "n int, i int, part string, x string")
    right = map_batches(distinct, probe, "n int, i int, part string, y string")
    met = left.join(right, ["n", "i", "part"]).where("x <> y and (length(x) < length(y) or x < y)").select("x", "y").distinct()

    def verify(batches):
        for xs, ys in batches:
            out = [(min(x, y), max(x, y), d) for x, y in zip(xs, ys) if (d := damerau(x, y, most)) is not None]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]

    return map_batches(met, verify, "a string, b string, distance int").distinct()
