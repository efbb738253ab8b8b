"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to other mentions.

Patterns (leftmost, not overlapping, per kind; failing matches are dropped): e-mail addresses, IPv4 addresses, card
numbers (Luhn) and phone numbers.

The field's nodes are a document's words with a digit or an @; its labels are none or one of the kinds. Each node has
a potential from its shape and the cue word before it; neighbours in the text share a chain potential; nodes
with equal or similar normal forms (same letters and digits, or same last digits) share a skip potential, each mention
with the form's first, so that any two mentions are two steps apart however many there are. Loopy message passing
(sum-product, damped) goes on until the messages settle; it gives each node's marginals, so what one mention shows
reaches all mentions in the document. Nodes that a pattern covers are clamped to its kind, and a node whose own digits
rule a kind out (a card number's by Luhn, an address by a part over 255) can't have it. A node outside the patterns'
spans whose label is a kind with probability ``SURE`` or more is a span of its own.

Weights are trained by pseudo-likelihood on at most ``MAX_SAMPLE`` documents with nodes, those with the smallest hash
of id and text, with the patterns' kinds as labels; a document that would bring the nodes of the sample over
``MAX_NODES`` is not sampled. The skip weights are drawn to ``CONSISTENT`` for equal labels, not to zero: mentions
of one form have one label unless the documents show otherwise. Detection covers every whole text.

Spans are code points, end exclusive. Defined cases: null and empty texts have no spans; null ids and repeated rows
stay; an empty table gives an empty result; without documents to train on the weights are zero and only patterns count.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stage

KINDS = ("email", "ip", "card", "phone")
MAX_SAMPLE = 2000
#: Nodes of the whole training sample at most.
MAX_NODES = 200_000
DAMPING, SETTLED, SURE = 0.3, 1e-6, 0.9
#: What the skip weights of equal labels are drawn to: more than the chain weights of two neighbours weigh.
CONSISTENT = 16.0
#: Characters of a word that its form needs to link it; a shorter number may stand twice by chance.
LEAST_FORM = 6
#: Log potential of a label that a node can't have.
NEVER = -1e3
#: Nodes or messages that one step of array arithmetic takes.
BLOCK = 1 << 16
CHAIN_GAP = 12  # code points between neighbours of a chain

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits fails from any later place where it fails from its first, so matches begin at run starts.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NODE = re.compile(r"[0-9@]")
#: Words that announce a kind.
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "kontakt", "correo", "courriel"), "ip": ("ip", "address", "host", "server", "addr"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"), "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "phone:", "tel:"),
}
CUE_OF = {w: k for k, kind in enumerate(KINDS) for w in CUES[kind]}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """As leftmost matching of the whole pattern would find: the run before an @ is taken from the last match's end on."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1  # no match crosses this @
        at = text.find("@", done)
    return out


def base(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not NODE.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def bucket(n: int, cuts: tuple[int, ...]) -> int:
    return sum(n >= c for c in cuts)


#: Name, number of values of each feature of a node.
FEATURES = (
    ("bias", 1), ("at", 3), ("plus", 2), ("digits", 8), ("letters", 4), ("dots", 6), ("dashes", 4), ("odd", 2), ("luhn", 2), ("quad", 2), ("cue", 5),
    ("length", 5), ("paren", 2),
)
WIDTH = sum(n for _, n in FEATURES)


def features(word: str, before: str) -> list[int]:
    """One index for each of FEATURES."""
    digits = digits_of(word)
    n = len(digits)
    core = word.strip(".,;:!?()[]<>\"'")
    values = (
        0,
        ("@" in word) + ("@" in word and "." in word.partition("@")[2]),
        word[:1] == "+" or word[1:2] == "+",
        bucket(n, (1, 4, 7, 9, 13, 16, 20)),
        bucket(sum(map(str.isalpha, word)), (1, 4, 12)),
        min(core.count("."), 5),
        min(word.count("-"), 3),
        any(c in word for c in "/:=_%"),
        13 <= n <= 19 and luhn(digits),
        address_like(core) and not over_255(core),
        CUE_OF.get(before.lower().strip(".,;()"), 4),
        bucket(len(word), (4, 8, 14, 24)),
        "(" in word or ")" in word,
    )
    out, at = [], 0
    for (_, size), v in zip(FEATURES, values, strict=True):
        out.append(at + int(v))
        at += size
    return out


def address_like(core: str) -> bool:
    """Four runs of digits between dots."""
    return core.count(".") == 3 and all(p.isascii() and p.isdigit() for p in core.split("."))


def over_255(core: str) -> bool:
    return any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or 0) > 255 for p in core.split("."))


def ruled_out(word: str) -> int:
    """The label (1 + kind) that the word's own digits rule out, or 0."""
    n = sum("0" <= c <= "9" for c in word)
    if 13 <= n <= 19 and not luhn(digits_of(word)):
        return 1 + KINDS.index("card")
    return 1 + KINDS.index("ip") if address_like(word) and over_255(word) else 0


def nodes(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, word, word before) of words with a digit or an @, without punctuation around them."""
    out, before = [], ""
    for m in WORD.finditer(text):
        word = m[0]
        if NODE.search(word):
            left = len(word) - len(word.lstrip("([<\"'#*$%&|"))
            right = len(word) - len(word.rstrip(".,;:!?)]>\"'#*$%&|"))
            if left + right < len(word):
                out.append((m.start() + left, m.end() - right, word[left : len(word) - right], before))
        before = word
    return out


def edges(own: list[tuple[int, int, str, str]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges and skip edges. A form's mentions are linked each to the first, so many mentions give as many edges."""
    chain = [(k, k + 1) for k in range(len(own) - 1) if own[k + 1][0] - own[k][1] <= CHAIN_GAP]
    first: dict = {}
    skip = set()
    for k, (_, _, word, _) in enumerate(own):
        digits = digits_of(word)
        keys = {("form", "".join(c for c in word.lower() if c.isalnum()))} if len(word) >= LEAST_FORM else set()
        if len(digits) >= 7:
            keys.add(("tail", digits[-7:]))
        if "@" in word:
            keys.add(("name", word.lower().partition("@")[0]))
        for key in keys:
            if len(key[1]) >= 4 and (at := first.setdefault(key, k)) != k:
                skip.add((at, k))
    return [e for e in chain if e not in skip], sorted(skip)  # a pair that is both shares the skip potential


@dataclass
class Field:
    """Weights: node (features by labels), chain and skip (labels by labels); label 0 is none."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def empty(cls) -> Field:
        n = len(KINDS) + 1
        return cls(np.zeros((WIDTH, n)), np.zeros((n, n)), np.zeros((n, n)))

    def marginals(
        self, feats: np.ndarray, chain: list, skip: list, clamped: np.ndarray | None = None, rounds: int | None = None, damping: float = DAMPING, never: np.ndarray | None = None
    ) -> np.ndarray:
        """Loopy sum-product in logs. feats: a row of indices for each node; clamped: its known label, or -1; never: a label that
        it can't have, or 0. Exact on trees, if rounds cover them. Unless rounds are given, they end when the messages
        settle; as a message's way is no longer than there are nodes, their bound is twice that number and some."""
        n, k = len(feats), len(KINDS) + 1
        if not n:
            return np.zeros((0, k))
        unary = np.concatenate([self.node[feats[at : at + BLOCK]].sum(axis=1) for at in range(0, n, BLOCK)])
        if never is not None:
            own = np.flatnonzero(never)
            unary[own, never[own]] = NEVER
        if clamped is not None:
            known = np.flatnonzero(clamped >= 0)
            unary[known] = NEVER
            unary[known, clamped[known]] = 0
        if chain or skip:
            pairs, cut = np.array([*chain, *skip], np.int64), len(chain)
            m = len(pairs)
            source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
            ways = ((0, cut, self.chain), (cut, m, self.skip), (m, m + cut, self.chain.T), (m + cut, 2 * m, self.skip.T))
            sent, new = np.zeros((2 * m, k)), np.zeros((2 * m, k))
            total = unary.copy()
            for _ in range(2 * n + 50 if rounds is None else rounds):
                moved = 0.0
                for first, last, table in ways:
                    for at in range(first, last, BLOCK):
                        some = slice(at, min(at + BLOCK, last))
                        back = slice(some.start - m, some.stop - m) if at >= m else slice(some.start + m, some.stop + m)
                        x = total[source[some]] - sent[back]
                        out = np.stack([logsum(x + table[:, j], 1) for j in range(k)], axis=1)
                        out -= logsum(out, 1)[:, None]
                        new[some] = damping * sent[some] + (1 - damping) * out
                        moved = max(moved, float(np.abs(out - sent[some]).max()))
                sent, new = new, sent
                total[:] = unary
                np.add.at(total, target, sent)
                if moved < SETTLED and rounds is None:
                    break
            unary = total
        return np.exp(unary - logsum(unary, 1)[:, None])


def logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def labels_of(own: list, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of each node: 1 + the kind of the first span that covers a part of it, or 0."""
    out, ordered, k = np.zeros(len(own), np.int64), sorted((a, b, kind) for kind, a, b in spans), 0
    for i, (a, b, *_) in enumerate(own):
        while k < len(ordered) and ordered[k][1] <= a:
            k += 1
        j = k
        while j < len(ordered) and ordered[j][0] < b:
            if ordered[j][1] > a:
                out[i] = ordered[j][2] + 1
                break
            j += 1
    return out


def train(samples: list[tuple[np.ndarray, np.ndarray, list, list]], steps: int = 150, rate: float = 0.5, ridge: float = 1e-3) -> Field:
    """Pseudo-likelihood: each node's label given its features and its neighbours' labels; (features, labels, chain, skip) of documents."""
    field, n = Field.empty(), len(KINDS) + 1
    if not samples:
        return field
    offsets = np.cumsum([0, *(len(x[1]) for x in samples)])
    feats, labels = np.concatenate([x[0] for x in samples]), np.concatenate([x[1] for x in samples])
    one = np.eye(n)
    near = []
    for which in (2, 3):
        counts = np.zeros((len(labels), n))
        pairs = np.array([(a + o, b + o) for o, x in zip(offsets, samples, strict=False) for a, b in x[which]], np.int64).reshape(-1, 2)
        np.add.at(counts, pairs[:, 0], one[labels[pairs[:, 1]]])
        np.add.at(counts, pairs[:, 1], one[labels[pairs[:, 0]]])
        near.append(counts)
    drawn = (np.zeros_like(field.node), np.zeros_like(field.chain), CONSISTENT * one)
    field.skip += drawn[2]
    memory = [np.full_like(w, 1e-8) for w in (field.node, field.chain, field.skip)]
    for _ in range(steps):
        x = field.node[feats].sum(axis=1) + near[0] @ field.chain + near[1] @ field.skip
        p = np.exp(x - logsum(x, 1)[:, None])
        error = (one[labels] - p) / len(labels)
        node = np.zeros_like(field.node)
        np.add.at(node, feats.ravel(), np.repeat(error, feats.shape[1], axis=0))
        pulls = (node, *((g + g.T) / 2 for g in (near[0].T @ error, near[1].T @ error)))
        for w, g, m, to in zip((field.node, field.chain, field.skip), pulls, memory, drawn, strict=True):
            g = g - ridge * (w - to)
            m += g * g
            w += rate * g / np.sqrt(m)
    return field


def detect(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the patterns, and of the field beside them: (kind, start, end)."""
    found = base(text)
    own = nodes(text) if NODE.search(text) else []
    if not own:
        return found, []
    known = labels_of(own, found)
    feats = np.array([features(w, b) for _, _, w, b in own], np.int32)
    never = np.array([ruled_out(w) for _, _, w, _ in own])
    p = field.marginals(feats, *edges(own), np.where(known > 0, known, -1), never=never)
    best = p.argmax(axis=1)
    more = [(int(best[k]) - 1, a, b) for k, (a, b, *_) in enumerate(own) if not known[k] and best[k] and p[k, best[k]] >= SURE]
    return found, more


def sampled(docs: DataFrame, bound: int = MAX_SAMPLE, most: int = MAX_NODES) -> DataFrame:
    """doc_id and text of the training sample, each row of docs that it holds once."""
    text = F.col("text").cast("string")
    rows = docs.where(F.col("doc_id").isNotNull() & text.rlike("[0-9@]")).select("doc_id", text.alias("text"), F.xxhash64("doc_id", "text").alias("_h"))
    few = rows.select("_h").distinct().orderBy("_h").limit(bound)
    n = F.regexp_count("text", F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@]")).cast("long")  # begins at words only: linear
    own = rows.join(F.broadcast(few), "_h").groupBy("_h").agg(F.min(F.struct("doc_id", "text")).alias("own"))  # bound rows
    own = stage(own.select("_h", "own.*").withColumn("n", n), "personal-data-sample")
    left, kept = most, []
    for r in own.select("_h", "n").orderBy("_h").collect():  # bound rows of two numbers
        if r["n"] <= left:
            left -= r["n"]
            kept.append((r["_h"],))
    return own.join(F.broadcast(docs.sparkSession.createDataFrame(kept, "_h long")), "_h").select("doc_id", "text")


def fit(docs: DataFrame, bound: int = MAX_SAMPLE) -> Field:
    lists = {"feats": pa.list_(pa.int32()), "labels": pa.list_(pa.int64()), "pairs": pa.list_(pa.int32())}

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column(1).to_pylist():
                own = nodes(text or "")
                chain, skip = edges(own)
                feats = [f for _, _, w, b in own for f in features(w, b)]
                rows.append((feats, labels_of(own, base(text or "")).tolist(), [x for p in (*chain, *skip) for x in p], len(chain)))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((*lists.values(), pa.int32()))]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *lists, "n_chain"])

        return run

    kind = dict(docs.dtypes)["doc_id"]
    rows = map_rows(sampled(docs, bound), make, f"doc_id {kind}, feats array<int>, labels array<long>, pairs array<int>, n_chain int")
    samples = []
    for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["labels"], r["feats"])):  # bound rows, MAX_NODES nodes in all
        if r["labels"]:
            pairs = [tuple(r["pairs"][k : k + 2]) for k in range(0, len(r["pairs"]), 2)]
            samples.append((np.array(r["feats"]).reshape(-1, len(FEATURES)), np.array(r["labels"]), pairs[: r["n_chain"]], pairs[r["n_chain"] :]))
    return train(samples)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs))  # a few hundred numbers

    def make():
        own = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                found, more = detect(text or "", own)
                for k in range(4):
                    cols[k].append(sum(x[0] == k for x in found))
                cols[4].append(hashlib.sha256(joined(found).encode()).hexdigest())
                cols[5].append(joined([*found, *more]))
                cols[6].append(len(more))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

        return run

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return map_rows(docs.select("doc_id", F.col("text").cast("string").alias("text")), make, schema)
