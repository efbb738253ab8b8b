import random
from collections import Counter

import numpy as np

from stripeline.llm import quality as ql


def plain(t):
    t = t or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    marked = {i for k, w in enumerate(windows) if counts[w] > 1 for i in range(k, k + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(marked)


def test_statistics(odd_rows, spark, sf):
    rng = random.Random(1)
    texts = [t for _, t in odd_rows] + ["".join(rng.choice("ab# \n*é") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for t in texts:
        assert ql.statistics((t or "").encode()) == plain(t)


def corpus():
    rng = random.Random(6)
    rows, marks = [], []
    for k in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 90))]
        bad = k % 9 == 0
        rows.append((k, " ".join(w + "###" if bad and rng.random() < 0.7 else w for w in words)))
        marks.append((k, int(not bad), 0))
    return rows, marks


def test_forest_parts_bad_from_good(frame, labels):
    rows, marks = corpus()
    good = {i: q for i, q, _ in marks}
    got = ql.quality(frame(rows), labels(marks)).collect()
    wrong = [r.doc_id for r in got if r.kept != bool(good[r.doc_id])]
    assert len(wrong) <= 3


def test_path_lengths():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(0, 1, (400, ql.RATIOS)), np.full((3, ql.RATIOS), 30.0)])
    scores = ql.Forest.fit(rows).score(rows)
    assert scores[-3:].min() > scores[:-3].max() and scores.max() <= 1 and scores.min() > 0
    assert ql.average_path(2) == 1 and ql.average_path(1) == 0 and 10 < ql.average_path(256) < 11


def test_odd_rows(frame, labels, odd_rows):
    rows, marks = corpus()
    forest = ql.fit(frame(rows), labels(marks))
    got = ql.verdicts(frame(odd_rows), forest).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(plain(t) for _, t in odd_rows)
    assert all(r.base_failed == ql.failed(r.n_words, r.n_repeat_words) and not (r.base_failed and r.kept) for r in got)
    assert ql.verdicts(frame(odd_rows).where("false"), forest).count() == 0


def test_no_labels(frame, labels, odd_rows):
    got = ql.quality(frame(odd_rows), labels([(1, None, 0), (None, 1, 1)])).collect()
    assert all(r.kept == (not r.base_failed) for r in got)


def test_scores_are_those_of_walks_down_the_trees(frame, labels):
    """Each row by itself, down every tree, with the path lengths' formula written out."""
    rows, marks = corpus()
    forest = ql.fit(frame(rows), labels(marks))
    stats = np.array([ql.statistics(t.encode()) for _, t in rows], np.int64)
    x = ql.ratios(stats)
    for k, s in enumerate(stats):
        n = max(s[0], 1)
        assert np.allclose(x[k], [s[1] / n, np.log(1 + 100 * s[2] / n), s[3] / n, s[4] / n])
    n = forest.size
    expected = 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    for row, score in zip(x, forest.score(x), strict=True):
        total = 0.0
        for feature, cut, left, path in forest.trees:
            at = 0
            while feature[at] >= 0:
                at = left[at] + int(row[forest.uses[feature[at]]] >= cut[at])
            total += path[at]
        assert abs(2 ** (-total / len(forest.trees) / expected) - score) < 1e-12


def test_verdicts_are_the_rules_and_the_threshold(frame, labels):
    rows, marks = corpus()
    forest = ql.fit(frame(rows), labels(marks))
    for r in ql.verdicts(frame(rows), forest).collect():
        assert r.kept == (not r.base_failed and r.anomaly <= forest.threshold)


def test_very_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (6, 20, 400)] + [" ".join(str(k % 500) for k in range(3000)), " ".join(map(str, range(3000)))]
    want = [ql.statistics(t.encode()) for t in texts]
    monkeypatch.setattr(ql, "FEW_WORDS", 0)
    assert [ql.statistics(t.encode()) for t in texts] == want == [plain(t) for t in texts]
    monkeypatch.undo()
    assert ql.statistics((" ".join(str(k % 1000) for k in range(10**6))).encode())[4] == 10**6


def test_repeated_ids_give_one_labelled_row(frame, labels):
    rows, marks = corpus()
    docs = frame(rows)
    many = docs.union(frame([(1, f"copy {k} " * 20) for k in range(3000)]))
    assert len(ql.fit(docs, labels(marks)).trees) == len(ql.fit(many, labels(marks)).trees) == ql.TREES
