import pytest

from lavra.llm.similarity import damerau, near_pairs, segments as cuts


@pytest.mark.parametrize("a, b, most, want", [("abcd", "abdc", 1, 1), ("abcd", "abcd", 1, 0), ("abcd", "bacde", 1, None), ("abcd", "bacde", 2, 2), ("", "a", 1, 1), ("abc", "xyz", 2, None)])
def test_damerau(a, b, most, want):
    assert damerau(a, b, most) == want


def test_near_pairs_is_complete(spark):
    import itertools
    import random

    rng = random.Random(5)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    strings = set(base)
    for s in base:
        i = rng.randrange(len(s) - 1)
        strings |= {s[:i] + s[i + 1 :], s[:i] + s[i + 1] + s[i] + s[i + 2 :], s[:i] + "z" + s[i:]}
    strings = sorted(x for x in strings if len(x) >= 4)
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(strings, 2) if damerau(a, b, 1) is not None}
    df = spark.createDataFrame([(s,) for s in strings + strings[:5] + [None, "ab"]], "s string")
    assert {(r.a, r.b) for r in near_pairs(df, "s", 1).collect()} == want
    assert sum(n for _, n in cuts(11, 2)) == 11
