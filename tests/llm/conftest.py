import os

import pytest

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables are not there")
    return SF_DIR


#: Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names.
ODD_TEXTS = [
    (1, None), (2, ""), (3, "\n\n"), (4, "the same line here\nand another line here"), (5, "The SAME line here\t\nown words only"),
    (5, "The SAME line here\t\nown words only"), (None, "the same line here"), (6, "word " * 30_000), (7, "é" * 5_000),
    (8, "one two three four five six seven eight nine ten eleven twelve"),
    (9, "one two three four five six seven eight nine ten eleven twelve"), (9, "quite another text for the same id, it is"),
    (None, None), (10, " \t\x0b\x0c\r "), (11, "a\x00b \U0001f600 <|endoftext|> c"),
]


@pytest.fixture()
def odd(spark):
    """Rows with the columns of ``documents`` and names that the operators use themselves."""
    rows = [
        (i, text, None if i == 3 else "en", None if i in (None, 8) else f"s{i % 3}", 1, "x", "y", 0.5, True, "z", 1, 2, "w", "d")
        for i, text in ODD_TEXTS
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, id string, row string, rate double,"
        " kept boolean, __doc string, __shard int, __later int, w0 string, `a.b` string"
    )
    return spark.createDataFrame(rows, schema)
