"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Folding lower-cases, maps homoglyphs (full-width forms, Cyrillic and Greek look-alikes) and digit or symbol
substitutions to letters, and turns everything else into blanks. As ``1``, ``!`` and ``|`` stand for ``i`` as
well as ``l``, these letters fold to one. Lexicon entries are word stems, which match at the start of a word, or whole
words, which end with a blank and match nothing longer. Exception phrases are whole words on both sides; an entry
that begins inside one is no hit. Besides a few fixed ones they are learned: two words of which one is a hit,
found in ``MIN_CLEAN`` clean labelled rows or more and in no toxic one.

The lexicon, its weights, the exceptions and the calibration are learned from at most ``MAX_LABELLED`` labelled rows
(those with the smallest hash of their id; of rows with one id the one with the least text), never from held-out
rows. Scoring covers every whole text, in time linear in it.

Defined cases: a null or empty text has no hit and gets the score of length 0; null ids are scored like any
other and are not held out (crc32 of null counts as remainder -1); repeated rows give repeated results; an
empty table gives an empty result; without usable labels the lexicon is empty and every score is the prior.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, stage

#: At most so many labelled rows fit the lexicon and the calibration.
MAX_LABELLED = 6000
#: At most so many entries in the lexicon, the strongest first.
MAX_TERMS = 4000
THRESHOLD = 0.3
#: Lengths of stems; whole words of the least length or more are candidates too.
STEMS = tuple(range(4, 13))
MIN_G2 = 15.0
#: Learned exceptions: clean rows that one needs, and how many at most, those in most clean rows first.
MIN_CLEAN, MAX_EXCEPTIONS = 3, 1000

#: Characters that stand for a letter.
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i",
    "а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "х": "x", "у": "y", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b", "і": "i", "ј": "j", "ѕ": "s",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
#: Phrases in which a listed word is no insult.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "clown shoes", "sore loser rule", "scum of the pond", "stupid simple")


def fold_table() -> dict[int, str]:
    """One-to-one translation: letters stay (folded), everything else in Latin-1 becomes a blank."""
    out = {i: " " for i in range(0x250) if not chr(i).isalpha()}
    for i in range(0x250):
        low = chr(i).lower()
        if chr(i).isalpha() and len(low) == 1:
            out[i] = low
    for i in range(0xFF01, 0xFF5F):  # full-width forms
        out[i] = chr(i - 0xFEE0).lower() if chr(i - 0xFEE0).isalnum() else " "
    for k, v in SUBSTITUTES.items():
        for x in {k, k.upper()} if len(k.upper()) == 1 else {k}:
            out[ord(x)] = v
    for i in range(0xFF01, 0xFF5F):
        out[i] = SUBSTITUTES.get(out[i], out[i])
        out[i] = SUBSTITUTES.get(chr(i - 0xFEE0), out[i])
    for i in (*range(0x2000, 0x2070), 0x3000):
        out[i] = " "
    for i in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF):  # invisible
        out[i] = ""
    return out


FOLD = fold_table()


def fold(text: str) -> str:
    return text.translate(FOLD)


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Intercept, weight of the summed hits, weight of the hits per 100 words.
    calibration: tuple[float, float, float] = (-4.0, 2.0, 1.0)
    _found: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._found is None:
            a = ahocorasick.Automaton()
            for term, w in self.weights.items():
                a.add_word(" " + term, (len(term), w))
            for phrase in self.exceptions:
                if own := fold(phrase).strip():
                    a.add_word(f" {own} ", (len(own), None))
            if len(a):
                a.make_automaton()
            self._found = a
        return self._found

    def forget(self) -> None:
        """To be called when weights or exceptions were changed."""
        self._found = None

    def __getstate__(self):
        return self.__dict__ | {"_found": None}

    def hits(self, text: str) -> tuple[float, int, int]:
        """Sum of weights, number of matched words, number of words."""
        flat = " " + fold(text) + " "
        words = len(flat.split())
        a = self.automaton()
        if not len(a) or not words:
            return 0.0, 0, words
        best = self.found(flat)
        return sum(w for _, w in best.values()), len(best), words

    def found(self, flat: str) -> dict[int, tuple[int, float]]:
        """By place of a word's beginning in the folded text: length and weight of the longest entry there, exceptions left out."""
        best: dict[int, tuple[int, float]] = {}
        begins: list[int] = []
        ends: list[int] = []
        for end, (n, w) in self.automaton().iter(flat):  # by end: phrases that overlap are joined
            if w is not None:
                start = end - n + 1
                if n > best.get(start, (0, 0.0))[0]:
                    best[start] = (n, w)
                continue
            start = end - n
            while begins and start <= ends[-1]:
                start = min(start, begins.pop())
                ends.pop()
            begins.append(start)
            ends.append(end)
        if begins:
            spared = lambda s: (k := bisect_right(begins, s)) and s < ends[k - 1]
            best = {s: x for s, x in best.items() if not spared(s)}
        return best

    def phrases(self, text: str) -> set[str]:
        """Two words, with one blank between, of which one is a hit."""
        flat, out = " " + fold(text) + " ", set()
        for start in self.found(flat) if len(self.automaton()) else ():
            end = flat.index(" ", start)
            for a, b in ((flat.rfind(" ", 0, start - 1) + 1, end), (start, flat.find(" ", end + 1))):
                own = flat[a:b] if a < b else ""
                if own.count(" ") == 1 and own[0] != " " != own[-1]:
                    out.add(own)
        return out

    def score(self, total: float, words: int) -> float:
        a, b, c = self.calibration
        x = a + b * math.log1p(total) + c * math.log1p(100.0 * total / max(words, 1))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, x))))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of at most bound labelled rows that are not held out; a doc labelled twice counts as toxic if once so."""
    some = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")  # bound rows of two numbers
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))  # however often an id is there


def learn(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> Lexicon:
    """Terms (word stems of 4 to 12 letters, and whole words) that G-squared ties to the label, weighted by log odds; then the calibration."""
    spark = docs.sparkSession
    rows = stage(labelled(docs, labels, bound), "toxicity-sample")
    ship(spark)
    words = stage(rows.select("text", "toxic").mapInArrow(_stems, "toxic int, terms array<string>"), "toxicity-terms")
    n = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return Lexicon({}, calibration=(math.log((bad + 0.5) / (good + 9.5)), 2.0, 1.0))
    seen = words.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (bad + 1)) - F.log((F.col("c") + 0.5) / (good + 1))
    part = lambda k, of, rest: F.when(F.col(k) > 0, 2 * F.col(k) * F.log(F.col(k) / (of * (F.col("t") + F.col("c")) / rest))).otherwise(0.0)
    g2 = part("t", F.lit(float(bad)), F.lit(float(bad + good))) + part("c", F.lit(float(good)), F.lit(float(bad + good)))
    top = (
        seen.where("t >= 3").select("term", "t", "c", odds.alias("w"), g2.alias("g2"))
        .where((F.col("g2") >= MIN_G2) & (F.col("w") >= 2.5) & (F.col("c") <= 0.2 * F.col("t")))
        .orderBy(F.desc("g2"), "term").limit(MAX_TERMS).collect()
    )
    lexicon = Lexicon(reduced({r["term"]: (r["t"], r["w"]) for r in top}))
    lexicon.exceptions += exceptions(rows, lexicon)
    lexicon.forget()
    shared = spark.sparkContext.broadcast(lexicon)  # MAX_TERMS entries at most
    points = map_rows(rows.select("text", "toxic"), lambda: lambda b: _points(b, shared.value), "toxic int, total double, words long").collect()
    lexicon.calibration = calibrated([(r["total"], r["words"], r["toxic"]) for r in points])
    return lexicon


def exceptions(rows: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Phrases around hits that clean rows have and toxic ones don't."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)  # MAX_TERMS entries at most

    def make():
        lex = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(lex.phrases(t or "")) for t in batch.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.string()))], ["toxic", "phrases"])

        return run

    found = map_rows(rows.select("text", "toxic"), make, "toxic int, phrases array<string>")
    seen = found.select("toxic", F.explode("phrases").alias("phrase")).groupBy("phrase").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    top = seen.where((F.col("t") == 0) & (F.col("c") >= MIN_CLEAN)).orderBy(F.desc("c"), "phrase").limit(MAX_EXCEPTIONS).collect()
    return tuple(r["phrase"] for r in top)


def reduced(terms: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Without stems that a longer one matches as often, and without longer ones or words whose stem is kept."""
    kept, sizes = dict(terms), sorted({len(t) for t in terms})
    shorter = lambda t: (t[:k] for k in sizes if k < len(t))
    for t in sorted(terms, key=len):
        for stem in shorter(t) if t[-1] != " " else ():  # a stem also finds other forms than the word
            if stem in kept and terms[stem][0] <= terms[t][0]:
                del kept[stem]
    return {t: w for t, (_, w) in kept.items() if not any(x in kept for x in shorter(t))}


def _stems(batches: Iterator[pa.RecordBatch], each: int = 64) -> Iterator[pa.RecordBatch]:
    """toxic and distinct terms of each text, in small batches, as a text has far more terms than letters."""
    for batch in batches:
        for k in range(0, batch.num_rows, each):
            part, out = batch.slice(k, each), []
            for text in part.column(0).to_pylist():
                words = {w for w in fold(text or "").split() if len(w) >= min(STEMS)}
                terms = {w[:k] for w in words for k in STEMS if len(w) >= k} | {w + " " for w in words}
                out.append(pa.array([sorted(terms)], pa.list_(pa.string())))  # Arrow at once: smaller than Python's strings
            yield pa.RecordBatch.from_arrays([part.column(1), pa.concat_arrays(out)], ["toxic", "terms"])


def _points(batch: pa.RecordBatch, lexicon: Lexicon) -> pa.RecordBatch:
    found = [lexicon.hits(t or "") for t in batch.column(0).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(1), pa.array([x[0] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.int64())], ["toxic", "total", "words"])


def calibrated(points: list[tuple[float, int, int]], steps: int = 60, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge, slopes kept at 0 or more."""
    points = sorted(points)
    x = np.array([[1.0, math.log1p(t), math.log1p(100.0 * t / max(n, 1))] for t, n, _ in points])
    y = np.array([float(p) for *_, p in points])
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        move = np.linalg.solve(h, g)
        w += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits, n_words of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # MAX_TERMS entries at most

    def make():
        lex = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [lex.hits(t or "") for t in batch.column(2).to_pylist()]
            scores = [lex.score(t, n) for t, _, n in found]
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            columns += [pa.array([k for _, k, _ in found], pa.int64()), pa.array([n for *_, n in found], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "n_hits", "n_words"])

        return run

    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), make, f"doc_id {kind}, held_out boolean, score double, predicted int, n_hits long, n_words long")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose text scores threshold or more; columns stay. One pass: the texts aren't shuffled."""
    lexicon = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = docs.columns.index("text")

    def make():
        lex = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = [lex.score(t, n) < threshold for t, _, n in (lex.hits(x or "") for x in batch.column(at).to_pylist())]
            return batch.filter(pa.array(keep, pa.bool_()))

        return run

    return map_rows(docs, make, docs.schema)
