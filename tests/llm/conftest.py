import pytest

EDGE_DDL = ("doc_id long, text string, lang string, source string, n_chars long, id long, key long, n long, `group` string, "
            "rank int, length int, part int, kind int, bundle int, value string, n_lines int, n_removed int, score double")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows and
    columns whose names clash with the operators' own."""
    long_text = " ".join(f"word{i % 977} thing{i % 13}." for i in range(60_000))
    texts = ["The cat sat on the mat.\nThe cat sat on the mat.\nAnother line here, with more words in it.", None, "", "   \n\t ",
             "one", long_text, "Émile naïve Ünder\xa0space\x1c 中文 😀\r\nlast line", "The cat sat on the mat.", "the CAT sat on the mat.",
             "<|endoftext|> a\x00b  c   d\n\n\ne", "you are an idiot, you stupid clown"]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, None if i % 5 == 0 else 7, i, 1, 2, "g", 1, 1, 1, 1, 1,
             "v", 1, 1, 0.5) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "a text without a key", *rows[1][2:]))
    rows.append((None, None, None, None, None, *[None] * 13))
    return spark.createDataFrame(rows, EDGE_DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_DDL)
