import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text[, lang, source]) rows."""
    def make(rows, extra=()):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), *(7,) * len(extra)) for r in rows]
        return spark.createDataFrame(full, ", ".join([DOC, *(f"`{c}` int" for c in extra)]))
    return make


#: Extra columns whose names operators might use themselves.
CLASHES = ("k1", "k2", "node", "size", "shard", "kept", "c", "_doc", "blob", "content", "key", "score", "a.b")


@pytest.fixture
def clashes():
    return CLASHES


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"
