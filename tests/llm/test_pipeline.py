import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_stages_decide_as_their_operators(spark, outputs):
    from shelfwise.llm.decontamination import contamination
    from shelfwise.llm.near_dups import near_duplicates
    from shelfwise.llm.quality import judge

    docs, good, single, clean, masked, packed = outputs
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert all(x.columns == docs.columns for x in outputs[:5])
    assert ids(good) == ids(judge(docs).filter("kept"))
    assert ids(single) == ids(near_duplicates(good).filter("doc_id = class_id"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(clean) == ids(contamination(single, bench).filter("not contaminated"))
    assert ids(masked) == ids(clean)
    for r in masked.collect():
        assert not re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text) and r.n_chars == len(r.text)
    assert sorted({r.doc_id for r in packed.select("doc_id").collect()}) == ids(masked)


def test_run_gives_the_last_stage(spark, outputs):
    pieces = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    got, expected = corpus_pipeline.run(spark, SF), outputs[-1]
    tokens = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert tokens(got) == tokens(expected)
    assert sum(p[2] for p in pieces(got)) == sum(p[2] for p in pieces(expected))


@pytest.fixture
def odd(documents, clashes):
    """Nulls, empty and very long texts, repeated rows, a null id and columns
    with the names that operators use."""
    fresh = lambda n, at=0: " ".join(f"word{at + i}" for i in range(n))
    rows = [(1, None), (2, ""), (2, ""), (3, "x"), (4, fresh(60_000)), (5, fresh(60_000)), (5, fresh(60_000)),
            (6, fresh(59_990)), (None, fresh(80, 200_000)), (7, fresh(90, 300_000) + ' password="hunter2222" ' + fresh(20, 400_000)),
            (8, fresh(70, 500_000), None, None), (8, fresh(70, 600_000), None, None)]
    return documents(rows, clashes)


EXPECTED = {"quality": [None, 4, 5, 5, 6, 7, 8, 8], "near_dedup": [None, 1, 2, 3, 4, 7, 8, 8],
            "decontamination": [None, 1, 2, 2, 3, 4, 5, 5, 6, 7, 8, 8], "secrets": [None, 1, 2, 2, 3, 4, 5, 5, 6, 7, 8, 8]}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_documents(spark, odd, tmp_path, name, stage):
    stage(spark, odd, SF).write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    ids = sorted((r.doc_id for r in got.select("doc_id").collect()), key=lambda i: -1 if i is None else i)
    if name == "packing":
        assert sorted(set(ids) - {None}) == [1, 2, 3, 4, 5, 6, 7, 8] and None in ids
    else:
        assert got.columns == odd.columns and ids == EXPECTED[name]
    if name == "secrets":
        texts = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
        assert texts[1][0] is None and "hunter2222" not in texts[7][0] and texts[7][1] == len(texts[7][0])
    nothing = stage(spark, odd.limit(0), SF)
    assert nothing.count() == 0 and (name == "packing" or nothing.columns == odd.columns)


def test_odd_documents_through_all_stages(spark, odd, tmp_path):
    docs = odd
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {None, 4, 7, 8}
