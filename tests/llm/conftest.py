import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside; a user's table may have them too.
CLASHES = ("ids", "pii", "whole", "row", "fp", "key", "node", "size", "order", "bucket", "bits", "bytes", "shard", "page", "score", "lang_pred", "copies", "target", "kind", "cell", "text_", "n")


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clash=True):
        full = [(i, t, *(rest or ("en", "s"))[:2], len(t) if t is not None else None) for i, t, *rest in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F
        return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)]) if clash else df
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, null ids, a very long text, repeated rows and ties."""
    long = " ".join(f"word{k % 977} th{k % 31}ing" for k in range(30_000))
    return [(0, "The quick brown fox jumps over the lazy dog.", "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, long, "de", "b"), (None, "id is null here", "en", None),
            (5, "same text again and again", "en", "c"), (6, "same text again and again", "en", "c"), (5, "same text again and again", "en", "c"),
            (8, "  two  spaces \n\n\t tabs and more \U0001f600\U0001f468‍\U0001f469 é́ \r\n", "fr", "b"), (9, "aaaaaaa ababababab -------- 1111111111 ........", "es", "a"),
            (10, "12 !? --", "en", "a"), (11, "\x1c\x85 　x\x00y", "en", "a")]
