import pytest

LONG = "lorem ipsum dolor sit amet, consectetur. " * 8000
PROSE = ("The miller kept his accounts in a narrow book. Every sack was counted twice before the cart left. "
         "His daughter learned to read from those pages, line by line.\nLater she wrote letters for the village, "
         "and nobody remembered who had taught her. The river was high that year.")
ROWS = [
    (0, PROSE), (1, PROSE), (2, PROSE.replace("narrow", "small")), (3, "one two"), (4, "one two"), (5, ""), (6, None),
    (7, " \n\t "), (8, LONG), (8, LONG), (9, "Überall ist Wärme, überall ist Licht. " * 6), (None, PROSE), (None, None),
    (10, "x"), (11, "%%% $$$ ### 123"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank, repeated and very long texts, and
    extra columns with names that operators use inside."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, id string, key long, kept string, "
              "digest string, cls long, score string, row string, _i long, marks string, _counts long, dir string, "
              "path string, Notice string, n_words string, held_out string, cell int, v long, part string")
    rows = [(i, t, None if n % 5 == 4 else ("de" if t and "Ü" in t else "en"), None if n % 3 else "s", None, "x", n, "no", None,
             1, "a", "b", 2, "c", 3, "d", f"a/b/{n}", "e", "f", "g", 4, 5, "h") for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
