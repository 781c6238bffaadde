import pytest

from ticketlake.llm.common import ship


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    ship(spark)


LONG = "lorem ipsum dolor sit amet consectetur " * 4000
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "...!!",
    "one",
    "four words are here",
    "the same text of seven words twice",
    "the same text of seven words twice",
    "THE SAME text of seven words twice",
    "ünï çødé ñandú straße 中文字 🙂 ok then",
    "x" * 50_000,
    LONG,
    LONG + "end",
    "tab\x0bvertical\x0cfeed\x85next line nbsp \x00 nul",
    "<|endoftext|> <b>&amp; special</b>",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns named like results."""
    rows = [
        (i if i != 3 else None, t, [None, "en", "de"][i % 3], "s" if i % 2 else None, None, "mine", -1.0, -7, False)
        for i, t in enumerate(ODD_TEXTS)
    ]
    rows += [rows[6], rows[6]]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "lang_pred string, score double, n_words bigint, kept boolean",
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
