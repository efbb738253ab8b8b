"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark windows (10 consecutive words; a shorter item is one window). Words become numbers;
the search looks at blocks of two words. A shift table says how far the window can move when a block isn't the
end of any pattern; where the shift is 0, a hash of the pattern's last block selects the patterns to test, and direct
comparison of all words confirms each occurrence (in a bucket of many patterns a hash of all their words goes before).
A word outside the benchmark moves the window past itself. Shorter windows are searched in the same way, one pass a length.

The benchmark is a stated query set. It is taken in blocks of at most ``BLOCK_WORDS`` words, of which one at a time is indexed
and broadcast: a benchmark of one block takes one pass over the documents without a shuffle. For a larger one, the documents
are written once with a row number, each block takes a pass that writes the hits it finds, and these are joined by row.

Defined cases: null, empty and blank texts have no words and no hits; items without words match nothing; rows with a
null item id count as an item named "" ; repeated items with one id count once; null document ids are kept;
repeated rows give repeated results; empty tables give empty results or no hits.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, map_rows, stage

WINDOW = 10
#: Words of benchmark items that one broadcast holds (about 400 bytes each).
BLOCK_WORDS = 250_000
#: Patterns of one last block that are compared one by one; more are looked up.
FEW = 16
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """ASCII lower case; runs of letters, digits and non-ASCII characters."""
    return WORD.findall(text.lower())


class WuManber:
    """Patterns of one length over word numbers; number 0 is any word that no pattern has."""

    def __init__(self, patterns: dict[tuple[int, ...], list[int]]):
        self.m = m = len(next(iter(patterns)))
        self.block = block = min(2, m)
        self.far = m - block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for p, owners in patterns.items():
            for end in range(block, m + 1):
                key = p[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.far), m - end)
            self.buckets[p[m - block :]].append((p, owners))
        for key, own in self.buckets.items():
            if len(own) > FEW:
                self.buckets[key] = dict(own)

    def search(self, ids: list[int], found) -> None:
        """Calls found(start, owners) for every occurrence."""
        m, block, far, shift, buckets, n = self.m, self.block, self.far, self.shift, self.buckets, len(ids)
        i = m - 1
        while i < n:
            if not ids[i]:
                i += m
                continue
            key = (ids[i - 1], ids[i]) if block == 2 else (ids[i],)
            step = shift.get(key, far)
            if step:
                i += step
                continue
            start = i - m + 1
            own, bucket = tuple(ids[start : i + 1]), buckets[key]
            if type(bucket) is dict:
                owners = bucket.get(own)
            else:
                owners = next((owners for p, owners in bucket if p == own), None)
            if owners is not None:
                found(start, owners)
            i += 1


class Index:
    """Searchers of one block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(dict)
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            for k in range(len(ids) - m + 1 if m else 0):
                owners = by_length[m].setdefault(tuple(ids[k : k + m]), [])
                if number[name] not in owners:
                    owners.append(number[name])
        self.searchers = [WuManber(p) for _, p in sorted(by_length.items())]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged hit ranges of words (end exclusive), names of items with occurring windows."""
        words = words_of(text)
        ids = list(map(self.vocabulary.get, words, (0,) * len(words)))
        ranges: list[tuple[int, int]] = []
        items: set[int] = set()
        for s in self.searchers:
            s.search(ids, lambda start, owners, m=s.m: (ranges.append((start, start + m)), items.update(owners)))
        return len(words), merged(ranges), sorted(self.names[k] for k in items)


def merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def blocks_of(items: DataFrame, key: str, text: str, most: int = BLOCK_WORDS, window: int = WINDOW):
    """Yields the items in blocks of at most most words, streamed through the driver one partition at a time. A longer item comes in
    pieces of one name that overlap by a window less one word, so no window is lost."""
    block, size = [], 0
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    for r in rows.toLocalIterator():
        words = words_of(r["t"].encode())
        for at in range(0, max(1, len(words) - window + 1), most):
            part = words[at : at + most + window - 1]
            if block and size + len(part) > most:
                yield block
                block, size = [], 0
            block.append((r["k"], b" ".join(part)))
            size += len(part)
    yield block


HITS = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))


def _searched(rows: DataFrame, block: list[tuple[str, bytes]], window: int, hit_only: bool) -> DataFrame:
    """The first column of rows, n_words, hits and items of each row (of those with hits), by the text in its second column."""
    shared = rows.sparkSession.sparkContext.broadcast(Index(block, window))  # BLOCK_WORDS words at most
    name = rows.columns[0]

    def make():
        index = shared.value
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [index.scan(text) for text in as_bytes(batch.column(1))]
            hits = pa.array([[{"start": a, "end": b} for a, b in hits] for _, hits, _ in found], spans)
            columns = [batch.column(0), pa.array([n for n, *_ in found], pa.int64()), hits, pa.array([names for *_, names in found], pa.list_(pa.string()))]
            out = pa.RecordBatch.from_arrays(columns, [name, "n_words", "hits", "items"])
            return out.filter(pa.array([bool(hits) for _, hits, _ in found], pa.bool_())) if hit_only else out

        return run

    schema = T.StructType().add(rows.schema[0]).add("n_words", "long").add("hits", HITS).add("items", T.ArrayType(T.StringType()))
    return map_rows(rows, make, schema)


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = BLOCK_WORDS) -> DataFrame:
    """_row (the columns of docs), n_words, hits (array of start, end word ranges, merged) and items (names, sorted) of every row."""
    blocks = blocks_of(items, "item_id", "text", most, window)
    first, second = next(blocks), next(blocks, None)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").cast("string").alias("text"))
    if second is None:
        return _searched(rows, first, window, False)
    rows = stage(rows.withColumn("_n", F.monotonically_increasing_id()), "decontaminate-rows")
    counted = _searched(rows.select("_n", "text"), [], window, False).select("_n", "n_words")
    parts = [stage(_searched(rows.select("_n", "text"), block, window, True), "decontaminate-hits") for block in chain((first, second), blocks)]
    joined = reduce(DataFrame.union, parts).groupBy("_n").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    every = rows.select("_n", "_row").join(counted, "_n").join(joined, "_n", "left")

    def tidy(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [[{"start": a, "end": b} for a, b in merged((h["start"], h["end"]) for h in own or ())] for own in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, batch.column(2).type), batch.column(3)], ["_row", "n_words", "hits", "items"])

    empty = F.coalesce("items", F.array().cast("array<string>")).alias("items")
    schema = T.StructType().add(rows.schema["_row"]).add("n_words", "long").add("hits", HITS).add("items", T.ArrayType(T.StringType()))
    return map_rows(every.select("_row", "n_words", "hits", empty), lambda: tidy, schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hits themselves, of every row."""
    found = occurrences(docs.select("doc_id", "text"), items, window)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["end"] - h["start"])
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "hits", "items",
    )


def keep_uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the rows that hold a benchmark window; columns stay. One pass, no shuffle."""
    return occurrences(docs, items, window).where(F.size("hits") == 0).select("_row.*")
