import random

import pytest

from stripeline.llm import tokencount as tc


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tc.default_tokenizer())


@pytest.fixture(scope="module")
def machine():
    return tc.transducer(tc.default_tokenizer())


WEIRD = ["", "'", "''s", "don't  we'll   \n\n x'r", "  'tis", " \n a", "a \n", "'re're'rx'l", "x<|endoftext|> y<|endoftext|>", " é́ 日本語 １２３ ½", "\t\t\tfoo\t bar", "a" * 300, "!!!'s ---===", "   ", "'s" * 9, "\x1c\x1d a", "0123456789" * 30, "  x\xa0y", "İstanbul ﬁn"]


def test_counts_as_the_library(machine, library):
    rng = random.Random(5)
    texts = WEIRD + ["".join(rng.choice("ab'sretl dvm\n\t 1é!?日") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for t in texts:
        want = len(library.encode(t, add_special_tokens=False).ids)
        assert machine.count(t) == want, t
        assert machine.count(t, 7) == want, t  # many chunks
    for chunk in (1, 2, 3):
        assert machine.count(texts[3], chunk) == len(library.encode(texts[3], add_special_tokens=False).ids)


def test_maps_compose_associatively(machine):
    rng = random.Random(8)
    for _ in range(200):
        parts = ["".join(rng.choice("ab' \n!1") for _ in range(rng.randint(1, 9))) for _ in range(3)]
        a, b, c = map(machine.chunk_map, parts)
        left, right = machine.composed(machine.composed(a, b), c), machine.composed(a, machine.composed(b, c))
        assert left == right
        assert machine.scanned([a, b, c])[1:] == [machine.composed(a, b), left]


def test_seam_rule_is_bpe(machine):
    """follows() against merging the two tokens' bytes from scratch."""
    rng = random.Random(2)
    m = machine.merges
    some = rng.sample(sorted(m.tokens), 120)
    for a in some:
        for b in some[:40]:
            assert m.follows(a, b) == (m.encode(a + b) == [a, b]), (a, b)


def test_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 20)
    monkeypatch.setattr(tc, "MAX_PAIRS", 10)
    monkeypatch.setattr(tc, "MAX_WORDS", 3)
    own = tc.Transducer(tc.default_tokenizer())
    for t in [*WEIRD, "several plain words, again and again"] * 2:
        assert own.count(t) == len(library.encode(t, add_special_tokens=False).ids)
        own.trim()


def test_rows(frame, odd_rows, library, spark, sf):
    got = tc.token_counts(frame(odd_rows)).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in odd_rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tc.token_counts(frame(odd_rows).where("false")).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in tc.token_counts(docs).collect())


def test_long_texts_by_parts(frame, library):
    """Texts cut into rows: runs of one kind, special strings at seams, and texts that are all head."""
    rng = random.Random(3)
    special = "<|endoftext|>"
    texts = ["a" * 500, "日本語" * 200, special * 20, f"x{special}{special} y " * 12, "plain words, and more of them. " * 30, "'" * 99 + "s" * 99, " " * 300, "1a" * 200]
    texts += ["".join(rng.choice(["ab", "'s", " ", "\n", "1", "é", "日", "!?", special, "tion "]) for _ in range(rng.randint(50, 200))) for _ in range(60)]
    rows = list(enumerate([*WEIRD, *texts, None]))
    got = tc.token_counts(frame(rows), long=40, part=17).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert sorted(map(tuple, got)) == want


def test_places_where_all_states_meet(machine, library):
    """Texts with and without them; the map's state doesn't depend on what was read before."""
    rng = random.Random(6)
    for _ in range(400):
        before, text = ("".join(rng.choice("ab'sr1!日 \n") for _ in range(rng.randint(1, 9))) for _ in range(2))
        head, n, state = machine.chunk_map(text)
        if state is not None:
            whole, total = machine.read(("start", tc.EMPTY, ""), (before + text,))
            _, first = machine.read(("start", tc.EMPTY, ""), (before, *head))
            assert whole == state and total == first + n
    assert machine.chunk_map("a" * 50)[1:] == (None, None) and machine.chunk_map("日本。日本")[2] is not None


def test_memory_of_long_texts():
    """Three million characters without white space, of one kind and of two: in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource, sys
from tokenizers import Tokenizer
from stripeline.llm import tokencount as tc
rng = random.Random(1)
machine = tc.transducer(tc.default_tokenizer())
machine.count("warm")
text = {"cjk": "".join(chr(rng.randrange(0x4e00, 0x5000)) for _ in range(1_500_000)), "letters": "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3_000_000))}[sys.argv[1]]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = machine.count(text)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1000)
cut = 0
if sys.argv[1] == "cjk":
    assert n == len(Tokenizer.from_file(tc.default_tokenizer()).encode(text, add_special_tokens=False).ids)
"""
    for what in ("cjk", "letters"):
        out = subprocess.run([sys.executable, "-c", code, what], capture_output=True, text=True, timeout=600)
        assert out.returncode == 0, out.stderr
        assert float(out.stdout.split()[-1]) < 500, (what, out.stdout)
