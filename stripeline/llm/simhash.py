"""SimHash near-duplicates: fingerprints of word shingles, linked through a Gray-order hierarchical index.

1. One pass makes the fingerprints; documents with one fingerprint become one row (partial aggregation).
2. The distinct fingerprints are sorted by Gray rank (the position in the reflected Gray code, whose neighbours differ by
   a bit) in ``ORDERS`` orders, each of which begins with another part of the bits: a pair within ``radius`` bits differs in one
   of the leading parts by no more than that order's budget, since the budgets and one for each sum up to radius + 1.
3. Each order is a hierarchy. Its upper nodes are the parts of the sorted whole (``PARTS`` ranges of as many fingerprints
   each, more of them over ``PART``): a node factors out the bits that all below it share, as mask and pattern. Pairs of upper nodes accumulate the
   differences in bits that both share; over the radius, or over the budget in the leading bits, the pair of parts is pruned
   as a whole. Only what is left is opened: both parts go to one task, where trees of the same kind descend together, each
   node adding what it shares beyond its parent, and prune in the same way down to single fingerprints. Where even the
   union of all bits that vary stays within the radius, two subtrees are linked whole.
4. A pair of parts returns a spanning star of each of its components, never its pairs; large-star and small-star rounds
   join them over all, and each fingerprint's component gets the smallest document id in it.

A fingerprint that many documents have is joined to them by broadcast, if it holds over a ``HOT``-th of the rows.

Defined cases: null, empty and blank texts have fingerprint zero and link like any other; rows with a null id get
a fingerprint and the component's smallest id that isn't null; repeated rows give repeated results; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT, as_bytes, drop_folder, join_by, map_rows, new_folder, partitions, stage

SHINGLE = 4
RADIUS = 4
ORDERS = 3
#: Parts of an order; fingerprints in a part, about, over which there are more parts; parts of an order at most, whose nodes the driver holds.
PARTS, PART, MAX_PARTS = 64, 1 << 20, 1 << 15
#: Children of a node in a part's tree, and pairs of nodes that are looked at in one step.
FAN, WIDE = 4, 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = 42) -> int:
    """As a signed 64-bit integer."""
    words = text.lower().split()  # bytes: only A-Z, and only ASCII blanks
    n = len(words)
    if not n:
        return 0
    flat = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return int(np.uint64(digest(flat, seed)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.array([digest(flat[a:b], seed) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (long) of every row."""

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t) for t in as_bytes(batch.column(1))], pa.int64())], ["doc_id", "fp"])

        return run

    kind = dict(docs.dtypes)[key]
    return map_rows(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), make, f"doc_id {kind}, fp long")


def gray_rank(fp: Column) -> Column:
    """Inverse reflected Gray code, shifted so that signed order is unsigned order."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def leads(radius: int = RADIUS, orders: int = ORDERS) -> list[tuple[int, int, int]]:
    """Of each order: the rotation that brings its part of the bits to the front, that part's length, and its budget."""
    if not 0 < orders <= min(radius + 1, 63):
        raise ValueError("orders must be from 1 to radius + 1")
    cuts = [round(64 * k / orders) for k in range(orders + 1)]
    each, more = divmod(radius + 1, orders)
    return [(a, b - a, each - 1 + (k < more)) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def rotated(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def ordered(fps: DataFrame, radius: int, orders: int, large: int) -> DataFrame:
    """order, part, key of the distinct fingerprints in column fp: keys are the rotated fingerprints, parts ranges of their Gray rank.
    The ranges come from approximate quantiles, so that nothing is shuffled to sort the whole."""
    parts = max(PARTS, min(MAX_PARTS, math.ceil(fps.count() / large)))
    rotations = [by for by, _, _ in leads(radius, orders)]
    shares = [k / parts for k in range(1, parts)]
    cuts = fps.agg(*(F.percentile_approx(gray_rank(rotated(F.col("fp"), by)), shares, max(10_000, 20 * parts)) for by in rotations)).first()  # parts numbers for each order
    cuts = [np.array(x if x is not None else [], np.int64) for x in cuts]

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp, out = batch.column(0).to_numpy().view(np.uint64), []
            for k, by in enumerate(rotations):
                key = (fp << np.uint64(by)) | (fp >> np.uint64(64 - by)) if by else fp
                rank = key.copy()
                for step in (1, 2, 4, 8, 16, 32):
                    rank ^= rank >> np.uint64(step)
                part = np.searchsorted(cuts[k], (rank ^ np.uint64(1 << 63)).view(np.int64))
                out.append((np.full(len(fp), k, np.int32), part.astype(np.int32), key.view(np.int64)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["order", "part", "key"])

        return run

    return stage(map_rows(fps.select("fp"), make, "order int, part int, key long"), "simhash-orders")


def part_pairs(keys: DataFrame, radius: int, orders: int) -> pa.Table:
    """order, a, b of the pairs of parts (a <= b) that may hold links: the upper nodes, one for each part, joined by their
    accumulated differences. The driver holds MAX_PARTS nodes of an order at most, in Gray order."""
    nodes = keys.groupBy("order", "part").agg(F.bit_and("key").alias("all"), F.bit_or("key").alias("any")).orderBy("order", "part").collect()
    found = [pa.table({c: pa.array([], pa.int32()) for c in ("order", "a", "b")})]
    for k, (_, length, budget) in enumerate(leads(radius, orders)):
        own = [r for r in nodes if r["order"] == k]
        if own:
            names = np.array([r["part"] for r in own], np.int32)
            tree = Tree(*(np.array([r[c] for r in own], np.int64).view(np.uint64) for c in ("all", "any")))
            for i, j in descend(tree, tree, True, lead_mask(length), budget, radius, None):
                found.append(pa.table({"order": np.full(len(i), k, np.int32), "a": names[i], "b": names[j]}))
    return pa.concat_tables(found)


def opened(fps: DataFrame, radius: int = RADIUS, orders: int = ORDERS, large: int = PART) -> DataFrame:
    """order, pair, side, key of the pairs of parts to be opened, each pair in one partition, in Gray order. In a pair of a part with itself all have side 0."""
    spark = fps.sparkSession
    keys = ordered(fps, radius, orders, large)
    pairs = part_pairs(keys, radius, orders)
    n = pairs.num_rows
    ids, one = pa.array(np.arange(n)), pa.array(np.ones(n, np.int32))
    first = pa.table({"order": pairs["order"], "part": pairs["a"], "pair": ids, "side": pc.subtract(one, one)})
    second = pa.table({"order": pairs["order"], "part": pairs["b"], "pair": ids, "side": one}).filter(pc.not_equal(pairs["a"], pairs["b"]))
    where = spark.createDataFrame(pa.concat_tables([first, second]).combine_chunks())
    parts = len(set(zip(pairs["order"].to_pylist(), pairs["b"].to_pylist(), strict=True)))
    copies = orders * (first.num_rows + second.num_rows) / max(1, parts)  # of a fingerprint
    return (
        keys.join(where, ["order", "part"]).select("order", "pair", "side", "key")
        .repartition(partitions(fps, 3.0 * copies), "pair")
        .withColumn("_rank", gray_rank(F.col("key")))  # a column, or each comparison of the sort would compute it anew
        .sortWithinPartitions("pair", "side", "_rank").drop("_rank")
    )


def links(fps: DataFrame, radius: int = RADIUS, orders: int = ORDERS, large: int = PART) -> DataFrame:
    """(a, b) with a < b: spanning stars of the distinct fingerprints in column fp; their components are those of all links."""
    found = opened(fps, radius, orders, large).mapInArrow(lambda batches: _found(batches, radius, orders, False), "a long, b long")
    return found.distinct()


def report(fps: DataFrame, radius: int = RADIUS, orders: int = ORDERS, large: int = PART) -> DataFrame:
    """order, pairs (of parts, opened), members (in them), possible (pairs of fingerprints in the whole order), compared (of them)."""
    n = fps.count()
    found = opened(fps, radius, orders, large).mapInArrow(lambda batches: _found(batches, radius, orders, True), "order int, members long, compared long")
    sums = found.groupBy("order").agg(F.count("*").alias("pairs"), F.sum("members").alias("members"), F.sum("compared").alias("compared"))
    return sums.select("order", "pairs", "members", F.lit(n * (n - 1) // 2).alias("possible"), "compared")


def _found(batches: Iterator[pa.RecordBatch], radius: int, orders: int, counts: bool) -> Iterator[pa.RecordBatch]:
    """Opens one pair of parts after the other and sends back its stars, or what it cost."""
    own = leads(radius, orders)
    for order, a, b in _pairs(batches):
        by, length, budget = own[order]
        compared = [0]
        x, y = linked(a, b, lead_mask(length), budget, radius, compared)
        if counts:
            members = len(a) + len(b if b is not None else ())
            columns = [pa.array([order], pa.int32()), pa.array([members], pa.int64()), pa.array(compared, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["order", "members", "compared"])
        elif len(x):
            x, y = (((v >> np.uint64(by)) | (v << np.uint64(64 - by)) if by else v).view(np.int64) for v in (x, y))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """(order, keys of side 0, keys of side 1 or None) of each pair of parts; rows come sorted by pair and side."""
    held: list[np.ndarray] = []

    def whole(rows: np.ndarray):
        cut = int(np.searchsorted(rows[2], 1))
        keys = rows[3].view(np.uint64)
        return int(rows[0, 0]), keys[:cut], keys[cut:] if cut < len(keys) else None

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
        if not rows.shape[1]:
            continue
        cuts = np.flatnonzero(rows[1, 1:] != rows[1, :-1]) + 1
        parts = np.split(rows, cuts, axis=1)
        if held and held[0][1, 0] != parts[0][1, 0]:
            yield whole(np.concatenate(held, axis=1))
            held = []
        for k, part in enumerate(parts):
            if k:
                yield whole(np.concatenate(held, axis=1))
                held = []
            held.append(part)
    if held:
        yield whole(np.concatenate(held, axis=1))


class _Labels:
    """Smallest index of each component, kept by merging arrays of links."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


def lead_mask(length: int) -> np.uint64:
    return np.uint64(((1 << length) - 1) << (64 - length))


class Tree:
    """A hierarchy over nodes in Gray order, FAN children each: by level, from the leaves up, the bits set in all and in any leaf below."""

    def __init__(self, every: np.ndarray, any_: np.ndarray):
        self.all, self.any = [every], [any_]
        while len(self.all[-1]) > 1:
            first = np.arange(0, len(self.all[-1]), FAN)
            self.all.append(np.bitwise_and.reduceat(self.all[-1], first))
            self.any.append(np.bitwise_or.reduceat(self.any[-1], first))
        #: Bits that all leaves below share.
        self.shared = [~(x ^ y) for x, y in zip(self.all, self.any, strict=True)]

    def __len__(self) -> int:
        return len(self.all[0])


def descend(a: Tree, b: Tree, same: bool, lead: np.uint64, budget: int, radius: int, whole, compared: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields pairs of leaves (i of a, j of b; i <= j if both are the same tree) that no node rules out. Both trees go down by turns, the higher one first.
    whole(level a, i, level b, j) is told of pairs of nodes with all leaves within the radius, which then go no further; if it is None, there are none.
    At leaves that are fingerprints what is left are the links of this order."""
    work = [(len(a.all) - 1, len(b.all) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint8), np.zeros(1, np.uint8), np.zeros(1, np.uint64))]
    while work:
        la, lb, i, j, total, leading, seen = work.pop()
        if len(i) > WIDE:
            work += [(la, lb, *(x[k : k + WIDE] for x in (i, j, total, leading, seen))) for k in range(0, len(i), WIDE)]
            continue
        common = a.shared[la][i] & b.shared[lb][j]
        # Bits that the nodes above had already compared are counted in total and leading.
        off = (a.all[la][i] ^ b.all[lb][j]) & common & ~seen
        total = total + np.bitwise_count(off)
        leading = leading + np.bitwise_count(off & lead)
        left = (total <= radius) & (leading <= budget)
        if same:  # each pair once: not where all leaves of i come after those of j
            left &= i * FAN**la < (j + 1) * FAN**lb
        if compared is not None and la == lb == 0:
            compared[0] += len(i)
        i, j, total, leading, common = (x[left] for x in (i, j, total, leading, common))
        if whole is not None and la + lb:
            vary = (a.any[la][i] | b.any[lb][j]) & ~(a.all[la][i] & b.all[lb][j])
            near = np.bitwise_count(vary) <= radius
            if near.any():
                whole(la, i[near], lb, j[near])
                i, j, total, leading, common = (x[~near] for x in (i, j, total, leading, common))
        if not len(i):
            continue
        if la == lb == 0:
            yield i, j
            continue
        down, level, size = (i, la, len(a.all[la - 1])) if la >= lb else (j, lb, len(b.all[lb - 1]))
        n = np.minimum(FAN, size - down * FAN)
        at = np.repeat(np.arange(len(i)), n)
        child = down[at] * FAN + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        more = (total[at], leading[at], common[at])
        work.append((la - 1, lb, child, j[at], *more) if la >= lb else (la, lb - 1, i[at], child, *more))


def linked(a: np.ndarray, b: np.ndarray | None, lead: np.uint64, budget: int, radius: int, compared: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs from each component's first to its others, by the links of two parts (b None: within one) that this order finds. Keys unsigned, in Gray order."""
    every = a if b is None else np.concatenate([a, b])
    first = Tree(a, a)
    second = first if b is None else Tree(b, b)
    shift = 0 if b is None else len(a)
    labels = _Labels(len(every))

    def leaves(level: int, node: np.ndarray, size: int, at: int) -> tuple[np.ndarray, np.ndarray]:
        begin = node * FAN**level
        n = np.minimum(FAN**level, size - begin)
        return at + np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), n

    def whole(la: int, i: np.ndarray, lb: int, j: np.ndarray) -> None:
        root = i * FAN**la
        for own, n in (leaves(la, i, len(first), 0), leaves(lb, j, len(second), shift)):
            labels.merge(np.repeat(root, n), own)

    if len(a) and (b is None or len(b)):
        for i, j in descend(first, second, b is None, lead, budget, radius, whole, compared):
            labels.merge(i, j + shift)
    root = labels.of
    others = root != np.arange(len(root))
    return every[root[others]], every[others]


def stars(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """The same of whole groups by one order with the whole radius as its budget. group: ascending numbers; fps: unsigned, in Gray order within a group. Pairs are signed, a < b."""
    out = [linked(own, None, lead_mask(64), radius, radius) for own in np.split(fps, np.flatnonzero(group[1:] != group[:-1]) + 1)]
    a, b = (np.concatenate([np.empty(0, np.uint64), *x]).view(np.int64) for x in zip(*out, strict=True))
    return np.minimum(a, b), np.maximum(a, b)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b): large-star and small-star rounds, each written to the shared folder."""
    spark = edges.sparkSession
    path = new_folder(spark, "simhash-edges")
    edges.write.parquet(path)
    edges, before = spark.read.parquet(path), None
    for _ in range(most_rounds):
        # Large star: a node's larger neighbours move to the smallest in its neighbourhood.
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(low, "b").select("a", "b", "m")
        small = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).union(moved.select(F.col("m").alias("a"), "b")).where("a < b").distinct()
        after = new_folder(spark, "simhash-edges")
        small.write.parquet(after)
        drop_folder(spark, path)
        path, edges = after, spark.read.schema("a long, b long").parquet(after)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"), F.count_distinct("b").alias("d")).first()
        if now == before and now["n"] == now["d"]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def simhash_classes(docs: DataFrame, radius: int = RADIUS, orders: int = ORDERS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, fingerprint, component_id of every row."""
    rows = stage(fingerprints(docs, key, text), "simhash-fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius, orders))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = stage(rooted.join(least, "root").select("fp", "n", "component_id"), "simhash-classes")
    # A join by fingerprint alone would bring all copies of a text to one task.
    every = join_by(rows, classes, ["fp"], F.col("n") * HOT > rows.count())
    return every.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, orders: int = ORDERS) -> DataFrame:
    """docs with one document of each class, the one with the smallest id; columns stay.

    Rows without an id stay, as no class can name them. Of repeated rows with the kept id, one stays.
    """
    classes = simhash_classes(docs, radius, orders)
    kept = classes.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count("*").alias("copies"))
    kept = stage(kept, "simhash-kept")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id")  # as a struct, no column clashes
    named = rows.join(kept.hint("merge"), "doc_id")  # the kept ids grow with the data: never broadcast, whatever their size now
    order = F.struct(F.col("_row.text"), F.to_json("_row"))
    repeated = named.where("copies > 1").groupBy("doc_id").agg(F.min_by("_row", order).alias("_row"))
    return named.where("copies = 1").select("_row").union(repeated.select("_row")).union(rows.where(F.col("doc_id").isNull()).select("_row")).select("_row.*")
