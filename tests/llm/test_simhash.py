import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from stripeline.llm import simhash as sh


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    fps = sorted(set(fps))
    of = {f: f for f in fps}

    def find(f):
        while of[f] != f:
            f = of[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                of[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    root = plain_components([f for _, f in fps])
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[root[f]].append(i)
    return sorted(((i, f"{f:016x}", min(least[root[f]], default=None)) for i, f in fps), key=repr)


def test_odd_rows(frame, odd_rows):
    got = sh.simhash_classes(frame(odd_rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == expected(odd_rows)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sh.simhash_classes(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_empty_table(frame):
    assert sh.simhash_classes(frame([(1, "x")]).where("false")).count() == 0


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 40))]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return list(out)


@pytest.mark.parametrize("large", [2048, 16])
def test_links_keep_components(spark, large):
    """Also where groups are split into pairs of slices."""
    fps = clustered(500, 5)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = sh.links(df, large=large)
    of = {int(np.int64(r.node).astype(np.uint64)): r.root for r in sh.components(edges).collect()}
    want = plain_components(fps)
    groups, have = defaultdict(set), defaultdict(set)
    for f in fps:
        groups[want[f]].add(f)
        have[of.get(f, ("alone", f))].add(f)
    have_root = {frozenset(v | ({int(np.int64(k).astype(np.uint64))} if not isinstance(k, tuple) else set())) for k, v in have.items()}
    # roots have no row of their own: put each with its component
    merged = [s for s in have_root if not any(s < t for t in have_root)]
    assert {frozenset(v) for v in groups.values()} == set(merged)


def test_stars_match_all_pairs():
    for seed in range(6):
        fps = np.array(clustered(300, seed), np.uint64)
        fps = fps[np.argsort(rank(fps))]
        a, b = sh.stars(np.zeros(len(fps), np.int64), fps)
        want = plain_components([int(f) for f in fps])
        of = {int(f): int(f) for f in fps}

        def find(f):
            while of[f] != f:
                f = of[f]
            return f

        for x, y in zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist(), strict=True):
            of[max(find(x), find(y))] = min(find(x), find(y))
        groups = defaultdict(set)
        for f in want:
            groups[find(f)].add(want[f])
        assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(set(want.values()))
        assert len(a) <= len(fps)  # a star, not the pairs


def rank(fps):
    for k in (1, 2, 4, 8, 16, 32):
        fps = fps ^ (fps >> np.uint64(k))
    return fps


def test_gray_neighbours_differ_by_a_bit(spark):
    fps = [k ^ k >> 1 for k in range(64)]
    df = spark.createDataFrame([(f,) for f in reversed(fps)], "fp long").orderBy(sh.gray_rank(sh.F.col("fp")))
    got = [r.fp for r in df.collect()]
    assert got == fps


def test_keep_one(frame):
    a, b = "one two three four five six seven eight", "entirely other words stand in this text here"
    rows = [(5, a), (3, a), (3, a), (4, b), (None, a), (8, None), (7, "")]
    got = sh.keep_one(frame(rows))
    assert got.columns == frame(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 3), (False, 4), (False, 7), (True, 0)]


def test_orders_find_every_link(spark):
    """10,000 clustered fingerprints in many parts: the components of all links, found by opening few pairs."""
    fps = clustered(10_000, 9)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    keys = np.array(fps, np.uint64)
    near = {(min(a, b), max(a, b)) for k, a in enumerate(fps) for b in keys[np.bitwise_count(keys ^ keys[k]) <= 4].tolist() if a != b}
    for orders in (1, 3, 5):
        of = {f: f for f in fps}

        def find(f, of=of):
            while of[f] != f:
                of[f] = of[of[f]]
                f = of[f]
            return f

        unsigned = lambda v: int(np.int64(v).astype(np.uint64))
        edges = [(unsigned(r.a), unsigned(r.b)) for r in sh.links(df, orders=orders, large=500).collect()]
        whole = {f: f for f in fps}
        for a, b in edges:
            of[max(find(a), find(b))] = min(find(a), find(b))
        for a, b in near:
            x, y = find(a, whole), find(b, whole)
            whole[max(x, y)] = min(x, y)
        assert [find(f) for f in fps] == [find(f, whole) for f in fps]
    for r in sh.report(df, large=500).collect():
        print(r)
        assert r.possible == 10_000 * 9_999 // 2 and r.compared < 0.1 * r.possible


def test_budgets_cover_the_radius():
    for radius in range(9):
        for orders in range(1, radius + 2):
            own = sh.leads(radius, orders)
            assert sum(b + 1 for _, _, b in own) == radius + 1 and sum(n for _, n, _ in own) == 64 and all(b >= 0 for _, _, b in own)
    with pytest.raises(ValueError, match="orders"):
        sh.leads(4, 6)


def test_hot_fingerprints(frame):
    """Copies that hold most rows, empty texts among them."""
    rows = [(k, "one two three four five six") for k in range(3000)] + [(k, "") for k in range(3000, 5000)] + [(k, f"other text {k} stands here for itself {k * 7}") for k in range(5000, 5100)]
    got = {r.doc_id: r.component_id for r in sh.simhash_classes(frame(rows, extra=False)).collect()}
    assert len(got) == 5100 and {got[k] for k in range(3000)} == {0} and {got[k] for k in range(3000, 5000)} == {3000} and len({got[k] for k in range(5000, 5100)}) == 100
