"""Small documents that hold every case an operator has to define."""

import pytest

WORDS = "the of river stone and bright over seven water cloud under light with deep green hill from old road to far north wind".split()


def prose(seed: int, n: int) -> str:
    """n words of a repeatable random text."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + (str(x % 97) if x % 5 == 0 else "") + ("." if i % 11 == 10 else ""))
    return " ".join(out)


#: (doc_id, text, lang, source, n_chars, kept): nulls, empties, ties, repeated rows, a long text, a column that clashes.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, `row` int"


def rows() -> list[tuple]:
    out = [(i, prose(i, 40 + 13 * i), "xx" if i % 2 else None, f"s{i % 3}", 1, "a", 1) for i in range(20)]
    out += [(100, None, "xx", "s0", None, None, None), (101, "", "xx", None, 0, "b", 2), (102, " \t\n", None, "s1", 3, "c", 3)]
    out += [(None, prose(3, 90), "xx", "s1", 1, "d", 4), (103, prose(5, 105), None, None, 1, "e", 5)]
    out += [(104, prose(4, 400), "xx", "s2", 1, "f", 6)] * 3 + [(104, prose(6, 70), "xx", "s2", 1, "g", 7)]
    out += [(105, prose(9, 60000), "xx", "s0", 1, "h", 8), (106, "x" * 300000, "xx", "s0", 1, "i", 9)]
    out += [(107, "ünï 漢字 \U0001f600 word word a b", "yy", "s0", 1, "j", 10), (108, "12 34 -- !!", "yy", "é", 1, "k", 11)]
    out += [(110 + i, prose(2, 300), "xx", "s0", 1, "l", 12) for i in range(12)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
