import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shardloom.llm.common import workers_find_package  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

PROSE = ("The river ran past the old mill and under the stone bridge where children threw sticks into the water. "
         "Every evening the baker closed his shop and walked home along the bank with a loaf for his sister. ")
#: (id, text): null and empty texts, white space, no letters, one word, ties, copies, repeated rows,
#: a null id (twice), repeated ids with other texts, a very long text
ODD = [
    (1, PROSE * 3), (2, PROSE * 3), (3, PROSE * 2 + "Then it rained."), (3, "another text with the same id"),
    (4, None), (5, ""), (6, " \t\n "), (7, "12345 ### !!!"), (8, "word"), (9, "two words"), (10, "a\nb\na\n\n A \nb"),
    (None, "a text without an id " * 20), (None, "a text without an id " * 20), (None, None),
    (11, PROSE * 3), (11, PROSE * 3), (12, "Ünïcödé ﬁ ① 日本語 😀 ▁ <|endoftext|> é H̱ don't x"),
    (13, "x" * 300), (14, (PROSE + "\n") * 900), (15, "\n"), (-16, PROSE.upper()), (17, "\x0bA\x1cB\x85C  double  spaces "),
]


@pytest.fixture(scope="session")
def spark(spark):
    workers_find_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd(spark):
    """The rows of ODD with more columns whose names operators use inside."""
    extra = ["h", "_h", "_id", "_null", "key", "node", "tile", "length", "n_words", "carried", "row", "score", "start", "lang"]
    rows = [(i, t, *[f"{c}{k}" for c in extra]) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def rows(df, *columns):
    """Rows as sorted tuples (nulls first)."""
    got = [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda r: [(x is not None, x) for x in r])
