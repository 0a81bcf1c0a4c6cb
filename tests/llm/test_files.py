"""Token files and WARC archives: exact round trips, format corners, edge rows."""

from __future__ import annotations

import collections
import hashlib
import io
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pointtally.llm import queries
from pointtally.llm import token_files as TF
from pointtally.llm import warc as W

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    "plain words, and more.\nNext line  with  spaces ", "", None, " ", "\n\n", "tab\tand nbsp here  x",
    "it's we'll don't '" + "s" * 3, "<|endoftext|> marks <|endoftext|>", "größe été 東京 🙂🙂", "a" * 30_000,
    "x,y;z!!??  \r\n mixed \x1c sep", "word " * 3000, "\x00\x01 control",
]


# ------------------------------------------------------------------ blocks


@pytest.mark.parametrize("top", [1, 2, 200, 256, 65536, 2**32 - 1])
def test_blocks_round_trip(top):
    rng = np.random.RandomState(top % 1000)
    for n in (1, 2, 100, 4096):
        ids = rng.randint(0, top, n, dtype=np.uint64).astype(np.uint32)
        ids[rng.rand(n) < 0.02] = top
        for percentile in (1, 50, 99, 100):
            assert (TF.decode_block(TF.encode_block(ids, percentile)) == ids).all()


def test_outliers_become_exceptions():
    ids = np.full(1000, 1_000_000, np.uint32) + np.arange(1000, dtype=np.uint32) % 4
    small = len(TF.encode_block(ids))
    ids[5], ids[77] = 2**31, 3
    ids[77] = 2_000_000
    data = TF.encode_block(ids, 99)
    assert (TF.decode_block(data) == ids).all()
    assert len(data) == small + 2 * 8  # the width stays, two exceptions are added


def test_file_reads_any_run():
    class Kept(io.BytesIO):
        def close(self):
            pass

    rng = np.random.RandomState(3)
    ids = rng.randint(0, 50_000, 10_000).astype(np.uint32)
    out = Kept()
    writer = TF.FileWriter(out, block=128)
    for a in range(0, len(ids), 777):
        writer.append(ids[a : a + 777])
    assert writer.close() == len(out.getvalue())
    reader = TF.FileReader(io.BytesIO(out.getvalue()))
    assert reader.n == len(ids) and len(reader.starts) == -(-len(ids) // 128) + 1
    for start, n in ((0, 10_000), (127, 2), (128, 128), (9_999, 1), (5_000, 0), (3, 4_000)):
        assert (reader.read(start, n) == ids[start : start + n]).all()
    with pytest.raises(ValueError):
        TF.FileReader(io.BytesIO(b"x" * 100))


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    pieces = ["the", "Of", "x1", "é", ",", ".", "...", ".,", "(a)", "²", "a" * 70, "'s", "'", "\n", "\t", "  ", " ", " ", "東", "!!", "12", "\r\n", "\x85"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(300)]
    encoder = TF.Encoder(PATH, cache_bytes=4000)
    for a in range(0, len(texts), 40):
        ids, lens = encoder.encode(texts[a : a + 40])
        want = [tok.encode(t, add_special_tokens=False).ids for t in texts[a : a + 40]]
        assert lens.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_encoder_cache_is_bounded_in_bytes():
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    encoder = TF.Encoder(PATH, cache_bytes=200_000)
    for _ in range(30):
        encoder.encode([" ".join(word(8) for _ in range(500)) + " " + word(5000)])
        assert encoder.young.nbytes + encoder.old.nbytes <= 400_000
        assert all(len(w) <= TF.LONGEST_CHUNK for a in encoder.young.words for w in a.to_pylist())
    assert encoder.old.n


def test_encoder_leaves_other_tokenizers_whole():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tok = TF.Encoder(path), Tokenizer.from_file(path)
    texts = ["Two words.", "", "a  b\nC", "x" * 300]
    ids, lens = encoder.encode(texts)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert not encoder.by_chunk and ids.tolist() == [i for w in want for i in w]
    assert lens.tolist() == encoder.lengths(texts).tolist() == [len(w) for w in want]


def test_packed_lengths_are_tokens(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgxyzé日本語,.'") for _ in range(rng.randint(1, 12)))
    texts = [" ".join(word() for _ in range(rng.choice([3, 40, 900]))) for _ in range(40)]
    texts += ["日本語のとても長い文章です。" * 700, "x1" * 3000, "a\tb\r\nc", "\u3000全角 x", "  two  \n\n lines \n", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = TF.Encoder(PATH).tok
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert want[40] > 4096  # no white space, and more than the longest sequence
    assert TF.Encoder(PATH, cache_bytes=4000).lengths([t or "" for t in texts]).tolist() == [want[i] - 1 for i in want]
    monkeypatch.setattr(queries, "_table", lambda *a: df)
    for rows in (queries.op3_packing(spark, "").collect(), corpus_pipeline.pack(spark, df, "").collect()):
        total, used = collections.Counter(), collections.Counter()
        for r in rows:
            total[r["doc_id"]] += r["length"]
            used[(r["shard"], r["bin"], r["capacity"])] += r["length"]
        assert total == want
        assert all(n <= capacity for (_, _, capacity), n in used.items())


def test_token_files(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    docs = [(k * 7 % 13 - 5, t) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS b", "2 AS bucket", "3 AS file")
    for size in (1 << 20, 2000):
        index = TF.write_tokens(df.repartition(3), PATH, block=64, range_bytes=size)
        got = {r["doc_id"]: r for r in TF.read_tokens(index, with_ids=True).collect()}
        start = 0
        for i, t in sorted(docs):
            ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
            r = got[i]
            assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            start += len(ids)


def test_token_files_edges(spark):
    schema = "doc_id long, text string"
    assert TF.read_tokens(TF.write_tokens(spark.createDataFrame([], schema), PATH)).collect() == []
    odd = spark.createDataFrame([(None, "b"), (3, "same"), (3, "same"), (3, "again"), (None, None)], schema)
    rows = TF.read_tokens(TF.write_tokens(odd, PATH)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, 3, 3, 3] and rows[0]["n_tokens"] == 1


# ------------------------------------------------------------------ WARC


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark):
    big = "<p>" + "long text é " * 40_000 + "</p>"
    same, short = "<html>" + "same payload " * 20 + "</html>", "<p>short</p>"
    rows = [
        (5, "http://a.example/x y\r\nInjected: 1", same), (2, "http://b.example/%20", same), (9, None, same),
        (4, "u", short), (3, "u", short), (7, "v", None), (8, "v", ""), (1, "w", big), (6, "w\x00é", "é" * 60),
        (10, "z", "é" * 60), (11, "z", "é" * 49), (12, "z", "é" * 49), (None, "n", same), (2, "rep", same),
        (13, "q", "Content-Length: 3\r\n\r\nWARC/1.1\r\n" * 9),
    ]
    df = pages(spark, rows).selectExpr("*", "1 AS digest", "2 AS refers_to", "3 AS r_page")
    got = W.read_warc(W.write_warc(df.repartition(3), sample_bytes=500)).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), str(r[1]))
    first: dict = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if i is not None and len(p) >= 100:
            first[p] = min(i, first.get(p, i))
    for r, (i, url, html) in zip(sorted(got, key=lambda r: (str(r["page_id"]), str(r["url"]))), sorted(rows, key=key)):
        p = (html or "").encode()
        revisit = p in first and first[p] != i
        assert (r["page_id"], r["url"]) == (i, url)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(p), hashlib.sha256(p).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[p]) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else p)


def test_warc_file_layout(spark):
    import zstandard

    html = [f"<html><body><p>page number {k} with common words</p></body></html>" for k in range(300)]
    index = W.write_warc(pages(spark, [(k, f"http://x.example/{k}", h) for k, h in enumerate(html)]).coalesce(1))
    (row,) = index.collect()
    data = open(row["file"].removeprefix("file:"), "rb").read()
    assert row["n_records"] == 300 and row["n_bytes"] == len(data)
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    assert size == row["dict_bytes"]
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest = data[8 + size :]
    records = 0
    while rest:  # each record is a frame of its own
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        record = frame.decompress(rest)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        rest = frame.unused_data
        records += 1
    assert records == 300
    plain = sum(len(zstandard.compress(W.record_bytes(k, "u", h.encode(), "d" * 64, None))) for k, h in enumerate(html))
    assert len(data) - size < plain


def test_target_uris_are_not_encoded_twice():
    head = lambda url: W.record_bytes(1, url, b"x", "d", None).split(b"\r\n\r\n")[0].decode().split("\r\n")
    assert "WARC-Target-URI: http://x/a%20b?c=%C3%A9" in head("http://x/a%20b?c=%C3%A9")
    assert not any(line.startswith("X-Page-URL") for line in head("http://x/a%20b"))
    odd = head("http://x/a b%20c\r\nEvil: 1")
    assert "WARC-Target-URI: http://x/a%20b%20c%0D%0AEvil:%201" in odd
    assert "X-Page-URL: http://x/a%20b%2520c%0D%0AEvil:%201" in odd


def test_warc_empty(spark):
    index = W.write_warc(pages(spark, []))
    assert index.collect() == [] and W.read_warc(index).collect() == []
    nulls = W.read_warc(W.write_warc(pages(spark, [(None, None, None)] * 2))).collect()
    assert [tuple(r)[:5] for r in nulls] == [(None, 0, hashlib.sha256(b"").hexdigest(), "response", None)] * 2
