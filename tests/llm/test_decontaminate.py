import hashlib
import random
import re

from stripeline.llm import decontaminate as dc


def plain(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = []
    for name, t in items:
        w = words(t)
        m = min(10, len(w))
        windows += [(str(name), w[k : k + m]) for k in range(len(w) - m + 1 if m else 0)]
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for name, p in windows:
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(name)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def check(spark, docs, rows, items):
    got = dc.contamination(docs, items_of(spark, items)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, items)


def test_odd_rows(spark, frame, odd_rows):
    items = [(1, "two three four five six seven eight nine ten eleven"), (2, "Short"), (10, "no ID"), (3, None), (4, "..."), (5, "zzz yyy xxx www vvv uuu ttt sss rrr qqq ppp")]
    check(spark, frame(odd_rows), odd_rows, items)


def test_random_overlaps(spark, frame):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    rows = [(k, text(rng.randint(0, 60))) for k in range(60)]
    check(spark, frame(rows), rows, [(k, text(rng.randint(0, 14))) for k in range(6)])


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()][:12]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(spark, docs, rows, items)


def test_blocks_and_empty(spark, frame, monkeypatch):
    rows = [(1, "a b c d e f g h i j k"), (2, "nothing")]
    items = items_of(spark, [(1, "a b c d e f g h i j"), (2, "b c d e f g h i j k")])
    got = dc.occurrences(frame(rows), items, most=3).collect()  # a block for each item
    assert [sorted(r["items"]) for r in got] == [["1", "2"], []] and [tuple(h) for h in got[0]["hits"]] == [(0, 11)]
    assert dc.contamination(frame(rows), items.where("false")).where("contaminated").count() == 0
    assert dc.contamination(frame(rows).where("false"), items).count() == 0


def test_keep(spark, frame):
    rows = [(1, "x a b c d e f g h i j k"), (2, "fine"), (3, None), (None, "fine")]
    docs = frame(rows)
    got = dc.keep_uncontaminated(docs, items_of(spark, [(1, "a b c d e f g h i j")]))
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == ["2", "3", "None"]


def test_shift_table_skips():
    m = dc.WuManber({(1, 2, 3, 4, 5, 6): [0]})
    assert m.shift[(5, 6)] == 0 and m.shift[(1, 2)] == 4 and m.far == 5
    seen = []
    m.search([1, 2, 3, 4, 5, 6, 0, 1, 2, 3, 4, 5, 6], lambda s, o: seen.append(s))
    assert seen == [0, 7]


def test_many_blocks_and_long_items(spark, frame):
    """A block for every few words, items longer than a block, hits of several blocks in one row."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    rows = [(k, text(rng.randint(0, 80))) for k in range(50)] + [(50, None), (None, text(40)), (7, text(30)), (7, text(30))]
    items = [(k, text(rng.randint(0, 45))) for k in range(7)]
    assert len(list(dc.blocks_of(items_of(spark, items), "item_id", "text", 5))) > 10
    found = dc.occurrences(frame(rows), items_of(spark, items), most=5).collect()
    one = dc.occurrences(frame(rows), items_of(spark, items)).collect()
    key = lambda r: repr((r["_row"], r["n_words"], r["hits"], r["items"]))
    assert sorted(map(key, found)) == sorted(map(key, one))


def test_common_endings_are_looked_up():
    patterns = {(k + 10, *range(1, 8), 8, 9): [k] for k in range(100)}
    m = dc.WuManber(patterns)
    assert type(m.buckets[(8, 9)]) is dict
    seen = []
    m.search([0, 15, *range(1, 10), 109, *range(1, 10), 110, *range(1, 10)], lambda s, o: seen.append((s, o)))
    assert seen == [(1, [5]), (11, [99])]
