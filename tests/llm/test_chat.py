import hashlib
import random

from stripeline.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    return by


def check(spark, rows):
    made = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    texts = {r.conv_id: r for r in made.collect()}
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), sha(loss)), c
        assert r.formatted_chars == len(texts[c].formatted) == sum(len(x) for x in [texts[c].formatted])
    return texts


def test_control_strings_round_trip(spark):
    bits = ["\\", "###", "#", "</turn>", "<", "\\h", "\\l", "\\n", "\n", "### Assistant: ", "x", "é日"]
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb### ", None]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))) for c in range(60) for t in range(rng.randint(1, 7))]
    check(spark, rows)


def test_adjacent_turns_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 2, "assistant", "c"), (1, 1, "user", "b"), (1, 3, "assistant", "</turn>")]
    texts = check(spark, rows)
    assert texts[1].formatted == "### user\na</turn>b</turn>\n### assistant\nc</turn>\\l/turn></turn>\n"
    assert [texts[1].formatted[s.start : s.end] for s in texts[1].loss] == ["c", "\\l/turn>"]


def test_odd_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, ""), (1, 0, "user", "tie"), (1, 0, "assistant", "tie"), (1, 0, "assistant", "tie"), (None, 3, "user", "x"), (None, 1, "assistant", "y"), (2, 0, "assistant", "long " * 50_000), (3, 0, "user", "only")]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.formatted(empty)).count() == 0


def test_extra_columns_and_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", "o", "b")], SCHEMA + ", own string, blocks string")
    made = chat.digests(chat.formatted(df))
    assert made.count() == 1 and "Python" not in made._jdf.queryExecution().toString()


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
    got = {r.conv_id: r for r in queries.op10_chat(spark, sf).collect()}
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len("\\### Assistant: </turn> ok") and len(got) == len({r[0] for r in rows}) + 1


def test_many_turns(spark):
    """Tens of thousands of turns in one conversation, of one role and of two: work is linear in them."""
    import time

    one = [(1, k, "user" if k % 1000 else "assistant", f"turn {k} ### \\") for k in range(30_000)]
    two = [(2, k, ("user", "assistant")[k % 2], f"said {k}</turn>") for k in range(30_000)]
    began = time.perf_counter()
    check(spark, one + two)
    assert time.perf_counter() - began < 90


def test_cuts_of_pieces(spark):
    from pyspark.sql import functions as F

    from stripeline.llm import arrays

    text = "".join(chr(97 + k % 26) if k % 7 else "\U0001f600" for k in range(3 * arrays.PIECE + 5))
    n = arrays.PIECE
    places = [(0, 0), (0, 1), (n - 1, 1), (n - 1, 2), (n, n), (5, 2 * n + 3), (3 * n, 5), (0, len(text)), (len(text), 0)]
    df = spark.createDataFrame([(text, a, k) for a, k in places], "t string, a long, k long")
    got = df.select("a", "k", arrays.cut(arrays.pieces(F.col("t")), F.col("a"), F.col("k")).alias("x")).collect()
    assert all(r.x == text[r.a : r.a + r.k] for r in got)
