import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the quick brown fox jumps over a lazy dog while seven bright wizards mix strange potions near old "
         "stone bridges under pale moons and quiet rivers carry small wooden boats toward distant harbours").split()


def sentence(seed: int, n: int) -> str:
    """``n`` words drawn by a small generator, alike for a seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if x % 3 else str(x % 97)))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, a null id, copies, a near copy, repeated rows, symbols and
    letters of several scripts, one long text."""
    long = sentence(5, 4000)
    near = long.replace("fox", "cat", 1)
    rows = [(1, long), (2, near), (3, long), (4, None), (5, ""), (6, sentence(6, 40)), (6, sentence(6, 40)),
            (None, sentence(7, 30)), (8, "!!! ??? ---"), (9, "漢字 かな 🙂 naïve café"), (10, sentence(8, 3)),
            (11, "x" * 700), (12, "\x00\t \n  end")]
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(1, 13)] + [(1, None, None)],
                                 "doc_id long, quality int, toxic int")
