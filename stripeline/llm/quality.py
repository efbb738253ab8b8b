"""Quality rules: an isolation forest on rule statistics, its threshold calibrated from labelled rows.

Rule statistics of a text: words, their characters, symbols, repeated lines, and words in 5-word windows that the text
holds twice or more. Two hard rules come first (too few words, too many repeated words). The forest looks at the
statistics as ratios: each tree splits a subsample at random (feature, then cut between its least and greatest
value) until rows stand alone; a row's score is 2^(-mean path length / expected path length), so odd documents,
which few splits part from the rest, score high. A document is kept if its score is at most the threshold that
parts the labelled rows best, where a wrongly rejected document counts ``CAUTION`` times a wrongly kept one. Which
of the ratios the forest sees is calibrated as well: each choice is fitted on one half of the labelled rows and
judged on the other, as a ratio that is odd in good documents too only costs.

Forest and threshold are fitted on at most ``MAX_SAMPLE`` labelled rows, those with the smallest hash of their id (of rows with
one id the one with the least statistics); the statistics and verdicts cover every whole text.

Defined cases: null, empty and blank texts have no words and fail the hard rule; null ids and repeated rows stay; an
empty table gives an empty result; without labelled rows of both kinds only the hard rules decide.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_rows

WINDOW = 5
MIN_WORDS = 10
#: Texts of more words are looked at as arrays of numbers.
FEW_WORDS = 100_000
MAX_REPEATED = 20  # per cent
SYMBOLS = b"#*$%&|<>"
#: At most so many labelled rows fit the forest and its threshold.
MAX_SAMPLE = 6000
TREES, SUBSAMPLE, SEED = 100, 256, 7
CAUTION = 10.0
RATIOS = 4
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()  # bytes: ASCII blanks only
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode())
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = text.split(b"\n")
    dup = 0
    if len(lines) > 1 and len(set(lines)) < len(lines):
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                dup += bool(line.split())
            seen.add(line)
    return n, chars, symbols, dup, repeated_words(words) if n > WINDOW else 0


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that are found twice or more."""
    if len(words) > FEW_WORDS:  # as numbers: a tuple for each window of a very long text would take too much memory
        return repeated_in(words)
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, until, repeated = Counter(windows), 0, 0
    for k, w in enumerate(windows):
        if counts[w] > 1:
            repeated += k + WINDOW - max(k, until)
            until = k + WINDOW
    return repeated


def repeated_in(words: list[bytes]) -> int:
    """The same with arrays: equal windows get equal numbers, which grow by a word at a time."""
    known: dict[bytes, int] = {}
    one = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    window = one
    for k in range(1, WINDOW):
        window = np.unique(window[:-1] * len(known) + one[k:], return_inverse=True)[1]
    twice = np.bincount(window)[window] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(twice)] += twice
    edges[WINDOW : WINDOW + len(twice)] -= twice
    return int((np.cumsum(edges) > 0).sum())


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED * n_words


def ratios(stats: np.ndarray) -> np.ndarray:
    """Rows of STATS as RATIOS: mean word length; symbols per 100 words, as log; repeated lines and repeated words per word."""
    s = stats.astype(np.float64)
    n = np.maximum(s[:, :1], 1.0)
    return np.concatenate([s[:, 1:2] / n, np.log1p(100 * s[:, 2:3] / n), s[:, 3:] / n], axis=1)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), cut, left child (right is next), path length added at a leaf."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    size: int
    #: Columns of ratios() that it sees.
    uses: tuple[int, ...] = tuple(range(RATIOS))
    threshold: float = 1.0

    @classmethod
    def fit(cls, rows: np.ndarray, uses: tuple[int, ...] = tuple(range(RATIOS)), trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
        rows = rows[:, uses]
        rng = np.random.default_rng(seed)
        size = min(subsample, len(rows))
        deepest = math.ceil(math.log2(max(size, 2)))
        out = []
        for _ in range(trees):
            feature, cut, left, path = [], [], [], []

            def node(part: np.ndarray, at: int, depth: int) -> None:
                low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
                open_ = np.flatnonzero(high > low)
                if depth >= deepest or len(part) <= 1 or not len(open_):
                    path[at] = depth + float(average_path(len(part)))
                    return
                f = int(rng.choice(open_))
                c = rng.uniform(low[f], high[f])
                first = len(feature)
                for _ in range(2):
                    for xs, v in ((feature, -1), (cut, 0.0), (left, 0), (path, 0.0)):
                        xs.append(v)
                feature[at], cut[at], left[at] = f, c, first
                below = part[:, f] < c
                node(part[below], first, depth + 1)
                node(part[~below], first + 1, depth + 1)

            for xs, v in ((feature, -1), (cut, 0.0), (left, 0), (path, 0.0)):
                xs.append(v)
            node(rows[rng.choice(len(rows), size, replace=False)], 0, 0)
            out.append((np.array(feature), np.array(cut), np.array(left), np.array(path)))
        return cls(out, size, tuple(uses))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, higher: odder. rows: of ratios()."""
        rows = rows[:, self.uses]
        total = np.zeros(len(rows))
        for feature, cut, left, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                k = at[inner]
                at[inner] = left[k] + (rows[inner, f[inner]] >= cut[k])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(average_path(self.size)), 1.0)) if self.trees else np.zeros(len(rows))


def calibrated(scores: np.ndarray, good: np.ndarray, caution: float = CAUTION) -> tuple[float, float]:
    """The threshold with the best share of bad rows over it, less caution times the share of good rows over it, and that gain; ties: the highest."""
    best, at = 0.0, 1.0
    for t in np.unique(scores):
        gain = (scores[~good] > t).mean() - caution * (scores[good] > t).mean()
        if gain > 0 and gain >= best:
            best, at = gain, float(t)
    return at, best


def fitted(stats: np.ndarray, good: np.ndarray) -> Forest:
    """The forest on the choice of ratios that parts the second half best, and its threshold on all rows. Ties: more ratios."""
    x, half = ratios(stats), len(good) // 2
    choices = [c for k in range(RATIOS, 0, -1) for c in combinations(range(RATIOS), k)]
    best, uses = -math.inf, choices[0]
    if good[:half].any() and not good[:half].all() and good[half:].any() and not good[half:].all():
        for c in choices:
            forest = Forest.fit(x[:half], c)
            t, _ = calibrated(forest.score(x[:half]), good[:half])
            over = forest.score(x[half:]) > t
            gain = over[~good[half:]].mean() - CAUTION * over[good[half:]].mean()
            if gain > best:
                best, uses = gain, c
    forest = Forest.fit(x, uses)
    forest.threshold, _ = calibrated(forest.score(x), good)
    return forest


def with_statistics(docs: DataFrame, *more: str) -> DataFrame:
    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [statistics(t) for t in as_bytes(batch.column(0))]
            cols = [pa.array([x[k] for x in found], pa.int64()) for k in range(len(STATS))]
            return pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], [*more, *STATS])

        return run

    kinds = dict(docs.dtypes)
    return map_rows(docs.select(F.col("text").cast("string").alias("text"), *more), make, ", ".join([*(f"{k} {kinds[k]}" for k in more), *(f"{k} long" for k in STATS)]))


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_SAMPLE) -> Forest:
    some = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # bound rows of two numbers
    found = with_statistics(rows, "doc_id", "quality").groupBy("doc_id", "quality").agg(F.min(F.struct(*STATS)).alias("own"))  # however often an id is there
    sample = sorted(tuple(r) for r in found.select("doc_id", "quality", "own.*").collect())  # bound rows of numbers
    stats = np.array([r[2:] for r in sample], np.int64).reshape(-1, len(STATS))
    good = np.array([r[1] == 1 for r in sample], bool)
    open_ = np.array([not failed(s[0], s[4]) for s in stats.tolist()], bool)
    stats, good = stats[open_], good[open_]
    if not good.any() or good.all():
        return Forest([], 0)
    return fitted(stats, good)


def verdicts(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly (the forest's score), kept of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # TREES trees of 2 * SUBSAMPLE nodes

    def make():
        own = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            stats = np.array([statistics(t) for t in as_bytes(batch.column(1))], np.int64).reshape(-1, len(STATS))
            bad = np.array([failed(s[0], s[4]) for s in stats.tolist()], bool)
            odd = own.score(ratios(stats))
            cols = [pa.array(stats[:, k]) for k in range(len(STATS))]
            verdict = [pa.array(bad), pa.array(odd), pa.array(~bad & (odd <= own.threshold))]
            return pa.RecordBatch.from_arrays([batch.column(0), *cols, *verdict], ["doc_id", *STATS, "base_failed", "anomaly", "kept"])

        return run

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, " + ", ".join(f"{k} long" for k in STATS) + ", base_failed boolean, anomaly double, kept boolean"
    return map_rows(docs.select("doc_id", F.col("text").cast("string").alias("text")), make, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return verdicts(docs, fit(docs, labels))
