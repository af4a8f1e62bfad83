import pytest

pytest.importorskip("graphweave.llm")

# names that the operators use inside; the caller may have them too
CLASH = ["_row", "_k1", "_lines", "t1", "drop", "key", "rep", "n", "_id", "_text", "kept", "ids", "uid", "bin"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text, lang, source) rows, with clashing extra columns."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
        return df
    return make


def words(n, salt=0):
    """n invented words that differ by salt."""
    return " ".join(f"w{salt}x{i}" for i in range(n))


ODD = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "word " * 5000, "en", "a"),
       (5, "same text here for two rows of one id", "en", "b"), (5, "same text here for two rows of one id", "en", "b"),
       (6, "Ünïcödé 日本語 🙂 \x0b x", "fr", "a"), (None, "no id at all in this row", "en", "a")]
