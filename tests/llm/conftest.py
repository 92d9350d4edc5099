import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, "
           # Names that the operators use themselves.
           "score double, row long, host string, spans string, fingerprint string, words string, kept boolean, held_out int, "
           "_row string, _spans long, __ROW double")
LONG = " ".join(f"word{i % 977}x{i * i % 613}" for i in range(30_000))


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source) tuples, with clashing extra columns."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None, 0.5, 1, "h", "s", "f", "w", True, 3, "own", 9, 0.25)
                for r in rows]
        return spark.createDataFrame(full, COLUMNS)
    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, equal texts, a very long one, other scripts."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five"), (4, "one two three four five"),
            (None, "one two three four five"), (None, None), (5, LONG), (6, "né 漢字 𝄞 ▁x  two\nthree"), (7, "a" * 3000),
            (4, "another text under the same id")]
