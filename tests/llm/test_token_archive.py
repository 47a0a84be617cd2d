from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rateweave.llm import rans, token_archive
from tests.conftest import SF001

PATH = public_tokenizers.path(token_archive.TOKENIZER)


def expected(rows):
    """(id, start, tokens, checksum) from the library, in order of ids, nulls last."""
    tokenizer, found, start = Tokenizer.from_file(PATH), [], 0
    for own_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        found.append((own_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in df.collect()), key=lambda r: r[1])


def archive_of(spark, docs, path, **more):
    token_archive.write(docs, str(path), PATH, **more)
    return token_archive.Archive(spark, str(path))


def test_query_equals_the_library(spark):
    from rateweave.llm.queries import op11_rans_archive

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    assert found(op11_rans_archive(spark, SF001)) == expected([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("block_ids", [rans.BLOCK_IDS, 100, 7])
def test_odd_rows(spark, docs_of, tmp_path, block_ids):
    """Nulls, empty texts, repeated ids and rows, a text over many blocks, columns with names used inside."""
    rows = [(5, "one text"), (1, None), (2, ""), (None, "no id"), (None, "no id"), (3, "same"), (3, "same"), (4, "Été  ÇA,\n\tx." * 90)]
    archive = archive_of(spark, docs_of(rows), tmp_path / "a", block_ids=block_ids)
    got = found(archive.documents())
    want = expected(rows)
    assert got == want and archive.total == sum(w[2] for w in want)
    pieces = sorted(archive.pieces().collect(), key=lambda r: (r["start"], r["at"]))
    whole = [i for r in pieces for i in r["ids"]]
    tokenizer = Tokenizer.from_file(PATH)
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert whole == [i for _, t in ordered for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]]
    for first, stop in ((0, 1), (11, 13), (3, 200), (len(whole) - 1, len(whole))):
        part = sorted(archive.pieces(first, stop).collect(), key=lambda r: (r["start"], r["at"]))
        assert [i for r in part for i in r["ids"]] == whole[first:stop]


def test_empty_table(spark, docs_of):
    assert token_archive.archived(docs_of([(1, "x")]).limit(0), PATH).count() == 0


def test_equal_ids_with_different_texts_keep_their_texts(spark, docs_of):
    rows = [(1, "a b c"), (1, "d e f g"), (1, None), (2, "h")]
    got = found(token_archive.archived(docs_of(rows), PATH))
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in expected(rows))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]] and got[-1][0] == 2


def test_hot_id_is_spread(spark):
    """A third of the rows under one id, all of one text: no range gets them all."""
    rows = [(7 if n % 3 == 0 else 1000 + n, "same text" if n % 3 == 0 else f"text {n}") for n in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    from rateweave.session import fresh_path

    path = fresh_path(spark, "archive")
    token_archive.write(docs, path, PATH)
    parts = [(r["part"], r["doc_ids"].count(7)) for r in spark.read.parquet(f"{path}/blocks").collect()]
    assert sum(n for _, n in parts) == 1000 and max(n for _, n in parts) < 700


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=900), st.integers(1, 40))
def test_block_round_trip(ids, lanes):
    ids = np.array(ids, dtype=np.uint32)
    counts = np.bincount(ids, minlength=70).astype(np.int64)
    coder = rans.Coder(rans.table_of(counts))
    block = coder.encode(ids, lanes)
    assert (coder.decode(block) == ids).all()
    middle = len(ids) // 2
    assert (coder.decode(block, middle // 2, middle) == ids[middle // 2 : middle]).all()


def test_sections_and_size():
    """Each section decodes alone; the size is near the entropy; damage and another table are noticed."""
    rng = np.random.default_rng(5)
    ids = (rng.zipf(1.2, 700_000) % 5000).astype(np.uint32)
    counts = np.bincount(ids, minlength=5000).astype(np.int64)
    table = rans.table_of(counts)
    assert int(table.freq.sum()) == 1 << table.bits and ((table.freq > 0) == (counts > 0)).all()
    coder = rans.Coder(table)
    block = coder.encode(ids)
    share = counts[counts > 0] / len(ids)
    assert len(block) < 1.06 * -(share * np.log2(share)).sum() * len(ids) / 8
    for first, stop in ((0, 10), (262_143, 262_145), (500_000, 700_000), (699_999, 700_000)):
        assert (coder.decode(block, first, stop) == ids[first:stop]).all()
    for at in (30, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(broken))
    with pytest.raises(ValueError):
        rans.Coder(rans.table_of(counts[::-1].copy())).decode(block)


def test_checksums_of_pieces_make_that_of_the_whole():
    data = bytes(range(256)) * 33
    for cuts in ([0, len(data)], [0, 1, 5, 4096, len(data)]):
        total = 0
        for a, z in zip(cuts, cuts[1:]):
            total ^= rans.crc_followed_by(zlib.crc32(data[a:z]), len(data) - z)
        assert total == zlib.crc32(data)


def test_table_of_extremes():
    assert int(rans.table_of(np.array([0, 9])).freq[1]) == 1 << 18
    many = rans.table_of(np.concatenate([[10**12], np.ones(100_000, dtype=np.int64)]))
    assert int(many.freq.sum()) == 1 << many.bits and int(many.freq.min()) == 1
    assert rans.table_of(np.zeros(3, dtype=np.int64)).freq.sum() == 0
