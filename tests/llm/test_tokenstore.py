import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stripeline.llm import tokenstore as ts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(ts.default_tokenizer())


def expected(rows, library):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, ts.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_odd_rows_round_trip(frame, odd_rows, library, tmp_path, spark):
    folder = ts.write(frame(odd_rows), f"file://{tmp_path}/store")
    want = expected(odd_rows, library)
    got = sorted(map(tuple, ts.summary(spark, folder).collect()), key=lambda r: r[1])
    assert got == [r[:4] for r in want]
    back = sorted(map(tuple, ts.documents(spark, folder).collect()), key=lambda r: r[1])
    assert [(r[0], list(r[3])) for r in back] == [(r[0], r[4]) for r in want]


def test_whole_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], library)
    got = sorted(map(tuple, ts.token_store(docs).collect()), key=lambda r: r[1])
    assert got == [r[:4] for r in want]


def test_chunks_are_stored_once(frame, tmp_path, spark):
    text = " ".join(f"alpha{k}" for k in range(4000))
    folder = ts.write(frame([(k, text if k % 2 else f"lead {k} {text}") for k in range(12)]), f"file://{tmp_path}/store")
    stored = spark.read.parquet(f"{folder}/chunks").where("payload is not null")
    uses = spark.read.parquet(f"{folder}/chunks")
    assert stored.count() == stored.select("digest").distinct().count() == uses.select("digest").distinct().count()
    assert stored.agg(F.sum("n")).first()[0] < 0.3 * uses.agg(F.sum("n")).first()[0]  # boundaries follow the content, so shifted copies share chunks


def test_empty_table(frame, spark, tmp_path):
    folder = ts.write(frame([(1, "x")]).where("false"), f"file://{tmp_path}/store")
    assert ts.summary(spark, folder).count() == 0 and ts.documents(spark, folder).count() == 0


def test_damage_is_found(frame, spark, tmp_path):
    folder = ts.write(frame([(1, "some words to keep"), (2, "others")]), f"file://{tmp_path}/store")
    chunks = spark.read.parquet(f"{folder}/chunks")
    bad = chunks.withColumn("payload", F.when(F.col("payload").isNotNull(), F.concat(F.expr("substring(payload, 1, octet_length(payload) - 1)"), F.lit(b"\xff"))))
    bad.coalesce(1).write.parquet(f"file://{tmp_path}/bad/chunks")
    spark.read.parquet(f"{folder}/recipes").write.parquet(f"file://{tmp_path}/bad/recipes")
    spark.read.text(f"{folder}/manifest").coalesce(1).write.text(f"file://{tmp_path}/bad/manifest")
    with pytest.raises(Exception, match="damaged"):
        ts.summary(spark, f"file://{tmp_path}/bad").collect()


def test_crc_arithmetic():
    rng = np.random.default_rng(3)
    wholes = [[rng.bytes(int(n)) for n in sizes] for sizes in ((0, 1, 7, 1000, 4096), (), (5,), (70_000, 3), (1,) * 300)]
    parts = [p for w in wholes for p in w]
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in wholes])))
    got = ts.crc_joins(np.array([zlib.crc32(p) for p in parts]), np.array([len(p) for p in parts]), offsets)
    assert got.tolist() == [zlib.crc32(b"".join(w)) for w in wholes]


def test_rolling_hash_depends_on_its_window_only():
    a, b = np.arange(500) * 7 % 1000, np.arange(500) * 11 % 1000
    joined = np.concatenate([b[:100], a])
    assert (ts.rolling(a)[ts.WINDOW :] == ts.rolling(joined)[100 + ts.WINDOW :]).all()


def test_memory_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(ts, "MAX_WORDS", 5)
    e = ts.Encoder(ts.default_tokenizer())
    texts = ["The quick, brown fox. isn't here", "a b c d e f g h i j", "The quick, THE Quick."]
    got = [np.frombuffer(x, e.kind).tolist() for _ in range(2) for t in texts for x in e.encode([t.encode()])]
    assert got == [library.encode(t, add_special_tokens=False).ids for _ in range(2) for t in texts]


def test_words_as_the_library_has_them(library):
    """Letters of several scripts, marks, digits, punctuation, blanks and special strings in any order."""
    import random

    rng = random.Random(5)
    letters = "aAbBzZéÉßİıſKΣςσ ＡａⅠ1２.,'!-<|>́̀ \t\n\x0b  \x85_日本*$#&%'stmdrvel"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) + rng.choice(["", "<|endoftext|>", "it's", "'S don'T", " words. foo.,!"]) for _ in range(3000)]
    e = ts.Encoder(ts.default_tokenizer())
    assert e.by_words
    for k in range(0, len(texts), 97):
        part = texts[k : k + 97]
        got = [np.frombuffer(x, e.kind).tolist() for x in e.encode([t.encode() for t in part])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in part]


def test_other_tokenizers_get_whole_texts(frame, odd_rows, spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not ts.Encoder(path).by_words
    want = [r[:4] for r in expected(odd_rows, Tokenizer.from_file(path))]
    folder = ts.write(frame(odd_rows), f"file://{tmp_path}/store", path)
    assert sorted(map(tuple, ts.summary(spark, folder).collect()), key=lambda r: r[1]) == want
