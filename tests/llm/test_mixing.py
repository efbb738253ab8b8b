import random

from pyspark.sql import functions as F

from stripeline.llm import mixing as mx


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, full long, tokens string")


def corpus(seed=4, n=600):
    rng = random.Random(seed)
    hot = lambda: "src0" if rng.random() < 0.4 else f"src{rng.randint(1, 7)}"
    return [(k, " ".join("w" for _ in range(rng.randint(0, 30))) or None, rng.choice(["en", "en", "de", "fr", None]), hot(), 1, "x") for k in range(n)]


def leaf(row):
    return (f"domain{int(row[3][3:]) % 4}", row[2] or "", row[3])


def plain_budgets(available, mix):
    """Units of one token each, handed out level by level: the total goes to children by weight as far as they can use it."""
    usable = {k: v * mix.max_epochs for k, v in available.items()}

    def down(prefix, total):
        level = len(prefix)
        names = sorted({k[level] for k in usable if k[:level] == prefix})
        room = {x: sum(v for k, v in usable.items() if k[: level + 1] == (*prefix, x)) for x in names}
        got, open_, left = dict.fromkeys(names, 0.0), set(names), min(total, sum(room.values()))
        while left > 1e-9 and open_:
            w = sum(mix.weight(level, x) for x in open_)
            step = min([1.0, *((room[x] - got[x]) / (left * mix.weight(level, x) / w) for x in open_)])
            for x in open_:
                got[x] += step * left * mix.weight(level, x) / w
            left *= 1 - step
            open_ = {x for x in open_ if room[x] - got[x] > 1e-9}
        if level == 2:
            return {(*prefix, x): int(v + 1e-6) for x, v in got.items()}
        return {k: v for x in names for k, v in down((*prefix, x), got[x]).items()}

    total = mix.tokens if mix.tokens is not None else mix.share * sum(available.values())
    return down((), total)


def test_budgets_match_filling_step_by_step():
    rng = random.Random(3)
    for k in range(30):
        available = {(f"d{rng.randint(0, 2)}", rng.choice("ab"), f"s{rng.randint(0, 9)}"): rng.randint(0, 500) for _ in range(20)}
        mix = mx.Mix(domains={"d0": 3.0}, languages={"a": 2.0}, sources={"s1": 5.0}, share=rng.choice([0.1, 0.7, 1.5]), max_epochs=rng.randint(1, 3))
        got, want = mx.budgets(available, mix), plain_budgets(available, mix)
        assert got.keys() == want.keys() and all(abs(got[x] - want[x]) <= 1 for x in got), k


def test_shortages_go_to_siblings_first():
    available = {("d", "en", "a"): 10, ("d", "en", "b"): 1000, ("e", "en", "c"): 1000}
    got = mx.budgets(available, mx.Mix(tokens=400, max_epochs=1))
    assert got == {("d", "en", "a"): 10, ("d", "en", "b"): 190, ("e", "en", "c"): 200}


def test_selection_is_each_leafs_prefix(spark, monkeypatch):
    monkeypatch.setattr(mx, "BUCKET", 8)  # several buckets a leaf
    rows = corpus()
    for mix in (mx.Mix(), mx.Mix(share=0.3, max_epochs=1, seed=5)):
        docs = docs_of(spark, rows)
        got = sorted((r._row.doc_id, r._epoch) for r in mx.select(docs, mix).collect())
        places = {(r.doc_id, r.e): r.p for r in docs.select("doc_id", F.explode(F.array(*map(F.lit, range(3)))).alias("e")).select("doc_id", "e", mx.place(mix.seed, F.col("e")).alias("p")).collect()}
        tokens = {r[0]: len((r[1] or "").split()) for r in rows}
        leaves = {}
        for r in rows:
            leaves.setdefault(leaf(r), []).append(r[0])
        budget = mx.budgets({k: sum(tokens[i] for i in v) for k, v in leaves.items()}, mix)
        want = []
        for k, ids in leaves.items():
            left, all_ = budget[k], sum(tokens[i] for i in ids)
            epoch = 0
            while epoch < mix.max_epochs:
                if left >= all_:
                    want += [(i, epoch) for i in ids]
                    left -= all_
                    epoch += 1
                    if not left:
                        break
                    continue
                for i in sorted(ids, key=lambda i: (places[i, epoch], i)):
                    left -= tokens[i]
                    if left < 0:
                        break
                    want.append((i, epoch))
                break
        assert got == sorted(want)


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    got = mx.rows_of(mx.select(docs, mx.Mix(share=1.0, max_epochs=1)))
    assert got.columns == docs.columns and got.count() == len(odd_rows)  # the whole is a mix of itself
    assert mx.select(docs.where("false")).count() == 0
    half = mx.select(docs, mx.Mix(share=0.5)).collect()
    assert len({r._epoch for r in half if r._row.doc_id == 7}) * 2 == len([r for r in half if r._row.doc_id == 7])  # repeated rows go together
    nulls = docs_of(spark, [(1, "a b", None, None, 1, ""), (None, "c d", None, None, 1, ""), (None, None, "en", "src1", 1, "")])
    assert mx.select(nulls, mx.Mix(share=1.0, max_epochs=1)).count() == 3


def test_budgets_in_tables(spark, monkeypatch):
    """The same budgets, to a token, as on the driver; weights of zero wait for the others."""
    rng = random.Random(8)
    for k in range(4):
        available = {(f"d{rng.randint(0, 2)}", rng.choice("ab"), f"s{rng.randint(0, 9)}"): rng.randint(0, 500) for _ in range(40)}
        mix = mx.Mix(domains={"d0": 3.0}, languages={"a": 2.0, "b": (0.0, 1.0)[k % 2]}, sources={"s1": 5.0, "s2": 0.0}, share=(0.1, 0.7, 0.95, 1.5)[k], max_epochs=1 + k % 2)
        leaves = spark.createDataFrame([(*a, 1, v) for a, v in available.items()], "_domain string, _lang string, _source string, docs long, tokens long")
        got = {tuple(r[:3]): r.budget for r in mx.budget_rows(leaves, mix).collect()}
        want = mx.budgets(available, mix)
        assert got.keys() == want.keys() and all(abs(got[x] - want[x]) <= 1 for x in got), k


def test_many_leaves_are_planned_alike(spark, monkeypatch):
    rows = corpus()
    docs = docs_of(spark, rows)
    mix = mx.Mix(share=0.4, max_epochs=1)
    take = lambda: sorted((r._row.doc_id, r._epoch) for r in mx.select(docs, mix).collect())
    want = take()
    monkeypatch.setattr(mx, "MAX_LEAVES", 3)
    assert take() == want


def test_token_column(spark):
    rows = [(k, "word " * (k % 5), "en", "src1", 10 if k % 2 else None, "x") for k in range(40)]
    got = mx.select(docs_of(spark, rows), mx.Mix(share=0.5, max_epochs=1), tokens="full").collect()
    assert sum(r._row.full or 0 for r in got) == 100
