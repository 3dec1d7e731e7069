import pytest

CLASHING = ["key", "k", "v", "n", "c", "a", "text_key", "_of", "_id", "_text", "_kept", "_n", "kept", "size", "first"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, copies, repeated rows and ids, and columns whose names the operators use inside."""
    long = " ".join(f"Wort{i % 900} ist hier." for i in range(20_000))
    para = " ".join(f"w{i}" for i in range(60)) + "."
    near = para.replace("w30 ", "zzz ")
    rows = [
        (1, para), (2, para), (2, para), (3, near), (4, None), (5, ""), (6, "  \n"), (7, long), (8, long + " Ende."), (9, "one"),
        (10, "one"), (11, "Ünïcode ▁ text 日本 \U0001f600 x  y\n\nz "), (None, para), (None, "alone and null"), (12, "a b c"),
        (12, "other text of a repeated id"), (13, "!!! ... ???"), (14, "x " * 3000),
    ]
    rows = [(i, t, "en", "s", len(t) if t is not None else None, *[7] * len(CLASHING)) for i, t in rows]
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
