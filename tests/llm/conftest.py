import pytest


@pytest.fixture
def docs_of(spark):
    """Rows of (doc_id, text) as documents, with a column whose name clashes with the operators' own."""

    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", "src", len(t or ""), "clash") for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, score string",
        )

    return build


HARD = [
    (1, None),
    (2, ""),
    (3, " \t\n  "),
    (4, "one"),
    (5, "one two"),
    (6, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich."),
    (7, "  uneven   white \n\n space  at\t the edges  "),
    (8, "<|endoftext|> is ordinary here, and \x1c\x85　 are odd"),
    (9, "same words " * 400),
    (9, "same words " * 400),
    (10, "".join(chr(97 + i % 26) for i in range(20_000))),
    (None, "a row without an id"),
]


@pytest.fixture
def hard(docs_of):
    return docs_of(HARD)


@pytest.fixture
def empty(docs_of):
    return docs_of([]).limit(0)
