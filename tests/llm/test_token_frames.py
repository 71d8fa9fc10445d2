from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from deskmetrics.llm import queries, token_frames
from deskmetrics.llm.common import scratch

from .conftest import SF


@pytest.fixture(scope="module")
def encode():
    return token_frames.encoder(queries.byte_bpe(), 2)


def _whole(encode, text):
    ids = encode.tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 2], "<u4").tobytes()


def test_chunks_encode_like_whole_texts(encode):
    rnd = random.Random(3)
    letters = " \n\t\xa0\x1c\x85 abé's'll12!?$ü　漢字\r\x0b<|endoftext|>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    texts += ["<|endoftext|>", None, "", "a<|endoftext|> b", "x" * 5000]
    assert list(encode(pa.array(texts))) == [_whole(encode, t) for t in texts]
    for t in texts[:300]:        # each in a run of its own, without wide spaces of others
        assert list(encode(pa.array([t, "", t], pa.string()))) == [_whole(encode, x) for x in (t, "", t)]


def test_query_matches_whole_text_encoding(spark, sf_texts, encode):
    rows = {r.doc_id: r for r in queries.op7_token_frames(spark, SF).collect()}
    start = 0
    for k in sorted(sf_texts):
        content = _whole(encode, sf_texts[k])
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (start, len(content) // 4, zlib.crc32(content))
        start += len(content) // 4
    assert len(rows) == len(sf_texts)


def test_files_hold_single_documents(spark, clashing_docs, edge_rows, encode, no_docs):
    folder = scratch(spark, "frames-test")
    files = token_frames.write_frames(clashing_docs, folder, queries.byte_bpe(), files=3)
    listed = files.orderBy("shard").collect()
    ids = []
    for f in listed:
        reader = token_frames.FrameReader(f.path)
        ids += reader.ids
        if 10 in reader.ids:
            text = next(t for k, t, *_ in edge_rows if k == 10)
            assert reader.tokens(10).tobytes() == _whole(encode, text)
        reader.close()
    assert ids == sorted((r[0] for r in edge_rows), key=lambda x: (x is not None, x or 0))
    rows = token_frames.read_frames(files).orderBy("shard", "frame").collect()
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    # any zstandard decoder streams a file, and a changed byte is found
    import zstandard
    system, path = token_frames.file_system(listed[0].path)
    with system.open_input_stream(path, compression=None) as raw:
        data = raw.read()
    with system.open_input_stream(path, compression="zstd") as stream:
        assert len(stream.read()) == 4 * listed[0].n_ids
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == 4 * listed[0].n_ids
    broken = bytearray(data)
    broken[12] ^= 0xFF
    with system.open_output_stream(path + ".broken") as out:
        out.write(bytes(broken))
    with pytest.raises(Exception):  # noqa: B017 - the decoder or the checksum says so
        reader = token_frames.FrameReader(listed[0].path + ".broken")
        for i in range(len(reader.ids)):
            reader.content(i)
    empty = token_frames.write_frames(no_docs, scratch(spark, "frames-test"), queries.byte_bpe())
    assert empty.collect() == [] == token_frames.read_frames(empty).collect()
