import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.encoding import encoder
from shelfwise.llm.packing import Packer, pack
from shelfwise.llm.queries import op4_packing, op6_token_counts
from shelfwise.llm.token_counts import at_limits, length_histogram, quantile_lengths, suffix_sums, token_lengths


@lru_cache
def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def full():
    return lambda text: _tokenizer().encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=60) | st.text(st.sampled_from(" \n\t'sétß\xa0\x1c\x85a1!漢<|endoftext|>"), max_size=60))
def test_ids_equal_the_tokenizers_file(text):
    assert encoder().ids(text).tolist() == _tokenizer().encode(text, add_special_tokens=False).ids


def test_long_and_special_texts(full):
    for text in ("x" * 30_000, " " * 30_000, "word " * 10_000, "a <|endoftext|> b", "", "naïve \n\n  façade"):
        assert encoder().ids(text).tolist() == full(text)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(1, 9))
def test_windows_are_whole(sizes, max_open):
    packer = Packer(window=16, max_open=max_open)
    docs = [np.arange(i * 1000, i * 1000 + n, dtype="<u4") for i, n in enumerate(sizes)]
    for i, ids in enumerate(docs):
        packer.add(i, ids)
    packer.flush()
    pieces, windows = {}, {}
    for doc, start, length, ids, total, seq, offset, seq_len in packer.done:
        assert total == sizes[doc] and len(ids) == 4 * length
        pieces.setdefault(doc, []).append((start, ids))
        windows.setdefault(seq, []).append((offset, length, seq_len))
    for i, ids in enumerate(docs):
        assert b"".join(x for _, x in sorted(pieces[i])) == ids.tobytes()
    for rows in windows.values():
        rows.sort()
        at = 0
        for offset, length, seq_len in rows:
            assert offset == at
            at += length
        assert at == rows[0][2] and (at == 16 or at & (at - 1) == 0)


def test_level_has_the_least_sum_of_squares():
    rng = np.random.default_rng(1)
    for _ in range(300):
        packer = Packer(window=12)
        packer.count[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 12))

        def after(level):
            count = packer.count.copy()
            if level:
                count[level] -= 1
            if level + size < 12:
                count[level + size] += 1
            return int((count[1:12] ** 2).sum())

        open_levels = [0] + [h for h in range(1, 12 - size + 1) if packer.count[h]]
        best = min(after(h) for h in open_levels)
        chosen = packer.level_for(size)
        assert chosen == max(h for h in open_levels if after(h) == best)


def test_pack_odd_rows(documents, clashes, full):
    rows = [(1, None), (2, ""), (3, "some words"), (3, "some words"), (None, "no id"), (4, "long text " * 5000)]
    docs = documents(rows, clashes)
    got = pack(docs).collect()
    total = sum(len(full(t or "")) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total and {r.doc_id for r in got} == {1, 2, 3, 4, None}
    assert [r.ids for r in got if r.doc_id == 2] == [(1).to_bytes(4, "little")]
    assert pack(docs.limit(0)).count() == 0


def test_query_round_trip(spark, full):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: full(r.text or "") + [1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op4_packing(spark, sf_dir).collect()
    per_doc, per_seq = {}, {}
    for r in got:
        ids = np.array(texts[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(texts[r.doc_id])
        per_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        per_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {d: sum(n for _, n in v) for d, v in per_doc.items()} == {d: len(v) for d, v in texts.items()}
    padding = 0
    for spans in [*per_doc.values(), *per_seq.values()]:
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
    for spans in per_seq.values():
        n = sum(x for _, x in spans)
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding == 0


def test_suffix_sums_against_brute_force(spark, full):
    sf_dir = "/root/testdata/sf0.001"
    lengths = [len(full(r.text or "")) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sums = op6_token_counts(spark, sf_dir)
    got = {r.n_tokens: r for r in sums.collect()}
    assert sorted(got) == sorted(set(lengths))
    for n, r in got.items():
        assert (r.n_docs, r.docs_from, r.tokens_from) == (
            lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert r.docs_upto == sum(x <= n for x in lengths) and abs(r.quantile - r.docs_upto / len(lengths)) < 1e-12
    limits = [0, 1, 100, 128, 4096, 10 ** 9]
    for r in at_limits(sums, limits).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in lengths)
        assert r.docs_over == sum(x > r.context_limit for x in lengths)
    ordered = sorted(lengths)
    for r in quantile_lengths(sums, [0.25, 0.5, 1.0]).collect():
        assert r.n_tokens == ordered[int(np.ceil(r.quantile * len(ordered))) - 1]


def test_token_counts_of_odd_rows(documents, clashes):
    docs = documents([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a")], clashes)
    assert sorted(r.n_tokens for r in token_lengths(docs).collect()) == [0, 0, 1, 2, 2]
    assert suffix_sums(length_histogram(docs.limit(0))).count() == 0


def test_token_counts_of_very_long_texts(documents, full):
    texts = ["word " * 150_000, "ü1 " * 90_000, "a" * 200_000]
    got = {r.doc_id: r.n_tokens for r in token_lengths(documents(list(enumerate(texts)))).collect()}
    assert got == {i: len(full(t)) for i, t in enumerate(texts)}
    sums = {r.n_tokens: r for r in suffix_sums(length_histogram(documents(list(enumerate(texts))))).collect()}
    assert {r.total_tokens for r in sums.values()} == {sum(got.values())}
