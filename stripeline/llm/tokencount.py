"""Token counts by a compiled finite-state transducer, without encoding.

The tokenizer (byte-level BPE behind a splitting pattern) is a finite-state function of the text. Its transducer is
deterministic and reads characters; a transition carries the change of the token count.

* Splitting: states follow runs of letters, numbers, other characters and white space, the blank that may join a
  run, and the apostrophe that may begin a contraction.
* Merging: BPE of a prefix ends with the one token that may follow the last token of the prefix before it. So a state
  holds, for each suffix that some token begins with, the last token before it and the tokens since; the next
  byte extends the suffixes, and the one that becomes a token which may follow gives the new last token. Suffixes
  are bounded by the longest token, so states are finitely many.

States are made when first reached (lazy subset construction) and kept by each worker, ``MAX_STATES`` at most;
then it starts anew, with the same results, also within a text.

A text is cut into chunks, and each chunk becomes a state map. There are places where every state moves to the same one:
white space after another character, and a change between letters, numbers and other characters. So a chunk's map is
its head (what comes before the first such place, as references to the text, not copies), the count from there to its
end, and the state at its end; a chunk without such a place is all head. Maps compose associatively: the left one's
last state reads the right one's head. A prefix scan composes the maps of a text by pairs, level by level, so each level
is as parallel as it has pairs.

Texts over ``LONG_TEXT`` bytes are cut into rows of their own, dealt over the tasks, and mapped there; their maps meet by
document and are composed. Shorter ones are read in one task, in memory that doesn't grow with them beyond their own size.

Defined cases: null and empty texts have 0 bytes and tokens; null ids and repeated rows stay as they are; an
empty table gives an empty result; the special string inside a text is one token, as the library counts it.
"""

from __future__ import annotations

import json
import pickle
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, partitions

CHUNK = 1 << 14
#: Texts of more bytes are cut into rows of PART characters.
LONG_TEXT, PART = 1 << 20, 1 << 18
MAX_STATES = 250_000
MAX_PAIRS = 400_000
#: Whole words that a worker keeps as single transitions from blank to blank.
MAX_WORDS = 400_000
NEVER = 1 << 60
LIMIT = 512
#: The characters with the White_Space property.
WHITE = frozenset(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: What may follow an apostrophe in a contraction.
SHORT, LONG = frozenset("stmd"), {"r": "e", "v": "e", "l": "l"}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


def kind_of(ch: str) -> str:
    """s: white space, l: letter, n: number, o: other."""
    if ch in WHITE:
        return "s"
    return {"L": "l", "N": "n"}.get(unicodedata.category(ch)[0], "o")


class Merges:
    """The vocabulary, and which token may follow which."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        letters = byte_alphabet()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = [t["content"] for t in model["added_tokens"]]
        special = set(self.special)
        self.tokens = {raw(t) for t in model["model"]["vocab"] if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.begun = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.longer = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.known: dict[tuple[bytes, bytes], bool] = {}
        self.sides: dict = {}

    def encode(self, data: bytes) -> list[bytes]:
        return [t for t, _, _ in self.derived(data)]

    def derived(self, data: bytes) -> list[tuple[bytes, tuple | None, int]]:
        """Tokens, each with the two tokens that it was merged from last, and the rank of that merge."""
        parts: list = [(data[k : k + 1], None, -1) for k in range(len(data))]
        while len(parts) > 1:
            best = min((self.ranks.get((x[0], y[0]), NEVER), k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == NEVER:
                break
            a, b = parts[best[1]][0], parts[best[1] + 1][0]
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and parts[k][0] == a and parts[k + 1][0] == b:
                    out.append((a + b, (parts[k], parts[k + 1]), best[0]))
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def edges(self, token: bytes) -> tuple[list, list] | None:
        """What stands at the left and right edge of the token while it is merged: (piece, rank of the merge that ends it).
        None: BPE never makes this token."""
        out = self.sides.get(token, 0)
        if out == 0:
            made = self.derived(token)
            out = None
            if len(made) == 1:
                out = ([], [])
                for side in (0, 1):
                    node, ends = made[0], NEVER
                    while node is not None:
                        out[side].append((node[0], ends))
                        ends, node = node[2], node[1] and node[1][side]
            self.sides[token] = out
        return out

    def follows(self, before: bytes, token: bytes) -> bool:
        """Whether BPE leaves the two tokens apart: no merge over the seam comes before the pieces there are merged away.
        Of equal ranks the leftmost goes first. Nothing before: whether BPE makes the token at all."""
        key = (before, token)
        out = self.known.get(key)
        if out is None:
            if len(self.known) > MAX_PAIRS:
                self.known.clear()
            own = self.edges(token)
            out = own is not None
            if out and before:
                for right, until in self.edges(before)[1]:
                    for left, ends in own[0]:
                        rank = self.ranks.get((right, left), NEVER)
                        if rank < until and rank <= ends and rank != NEVER:
                            out = False
            self.known[key] = out
        return out


#: Of a run's beginning: no byte yet. A state is the suffixes that some token begins with, longest first: (bytes so far, last token before, tokens since).
EMPTY = ((b"", b"", 0),)
#: After a blank that follows another character.
MET = ("s", EMPTY, " ")


class Transducer:
    def __init__(self, path: str):
        self.merges = Merges(path)
        self.rows: dict[tuple, dict] = {}
        self.kinds: dict[str, str] = {}
        self.words: dict[str, int] = {}
        self.parts: dict = {}
        self.start = self.row(("start", EMPTY, ""))

    def row(self, state: tuple) -> dict:
        out = self.rows.get(state)
        if out is None:
            out = self.rows[state] = {None: state}
        return out

    def fed(self, run: tuple, data: bytes) -> tuple[tuple, int]:
        """The run's state after more bytes, and the change of its count."""
        m, change, one = self.merges, 0, self.parts.setdefault
        for k in range(len(data)):
            b = data[k : k + 1]
            grown = [(s + b, p, c) for s, p, c in run if s + b in m.begun]
            token, count = next((s, c) for s, p, c in grown if s in m.tokens and m.follows(p, s))
            # count: tokens from this suffix's beginning to the old end; the new end is one token after the beginning
            moved = 1 - count
            change += moved
            grown = [(s, p, c + moved) for s, p, c in grown if s in m.longer]
            run = (*(one(x, x) for x in grown), one(x := (b"", token, 0), x))  # equal parts of states are kept once
        return run, change

    def kind(self, ch: str) -> str:
        out = self.kinds.get(ch)
        if out is None:
            out = self.kinds[ch] = kind_of(ch)
        return out

    def step(self, state: tuple, ch: str) -> tuple[tuple, int]:
        """One transition of the machine: the next state and the change of the count."""
        name, run, held = state
        kind = self.kind(ch)
        if name == "quote":  # an apostrophe began a piece; held: what follows so far
            if not held and ch in SHORT or held and LONG[held] == ch:
                return ("start", EMPTY, ""), self.whole("'" + held + ch)
            if not held and ch in LONG:
                return ("quote", EMPTY, ch), 0
            name, run, held, done = ("l", *self.after(EMPTY, held), self.whole("'")) if held else ("o", *self.after(EMPTY, "'"), 0)
            state, more = (name, run, ""), held + done
            out, change = self.step(state, ch)
            return out, change + more
        if name == "s":  # white space, its last character held back
            if kind == "s":
                run, change = self.fed(run, held.encode())
                return ("s", run, ch), change
            if held == " ":
                run, change = self.fed(EMPTY, (" " + ch).encode())
                return (kind, run, ""), change
            out, change = self.step(("start", EMPTY, ""), ch)
            return out, change + self.whole(held)
        if kind == name:
            run, change = self.fed(run, ch.encode())
            return (name, run, ""), change
        if kind == "s":
            return ("s", EMPTY, ch), 0
        if ch == "'":
            return ("quote", EMPTY, ""), 0
        run, change = self.fed(EMPTY, ch.encode())
        return (kind, run, ""), change

    def after(self, run: tuple, text: str) -> tuple[tuple, int]:
        return self.fed(run, text.encode())

    def whole(self, text: str) -> int:
        return self.fed(EMPTY, text.encode())[1]

    def end(self, row: dict) -> int:
        """What the end of the text adds."""
        name, run, held = row[None]
        if name == "quote":
            return self.whole("'") + (self.whole(held) if held else 0)
        return self.fed(run, held.encode())[1] if name == "s" else 0

    def run(self, row: dict, text: str) -> tuple[dict, int]:
        n = 0
        for ch in text:
            try:
                row, change = row[ch]
            except KeyError:
                state, change = self.step(row[None], ch)
                row[ch] = made = (self.row(state), change)
                row = made[0]
            n += change
        return row, n

    def run_words(self, row: dict, text: str) -> tuple[dict, int]:
        """As run(), with whole words between blanks as single transitions."""
        met, words, n = self.row(MET), self.words, 0
        *pieces, last = text.split(" ")
        for piece in pieces:
            if row is met:
                change = words.get(piece)
                if change is None:
                    row, change = self.run(met, piece + " ")
                    if row is met:
                        words[piece] = change
            else:
                row, change = self.run(row, piece + " ")
            n += change
        row, change = self.run(row, last)
        return row, n + change

    def trim(self, row: dict | None = None) -> dict | None:
        """Forgets the states and words if they are too many; the given row goes on as a new one."""
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        if len(self.rows) <= MAX_STATES:
            return row
        state = row and row[None]
        for x in self.rows.values():
            x.clear()  # breaks the cycles between rows
        self.rows.clear()
        self.parts.clear()
        self.start = self.row(("start", EMPTY, ""))
        return state and self.row(state)

    def read(self, state: tuple, pieces) -> tuple[tuple, int]:
        """The state after all pieces of text, and the change of the count."""
        row, n = self.row(state), 0
        for piece in pieces:
            for k in range(0, len(piece), CHUNK):
                row, more = self.run_words(row, piece[k : k + CHUNK])
                n += more
                row = self.trim(row)
        return row[None], n

    def meets(self, before: str, ch: str) -> bool:
        """Whether every state that has read the character before moves to the same one with ch."""
        a, b = self.kind(before), self.kind(ch)
        return a != b and a != "s" and (b == "s" or before != "'" and ch != "'")

    # State maps: (head, count, state). count and state are None where no place in the chunk makes all states meet, and head is all of it.

    def chunk_map(self, text: str) -> tuple[tuple[str, ...], int | None, tuple | None]:
        first = next((k for k in range(1, len(text)) if self.meets(text[k - 1], text[k])), None)
        if first is None:
            return (text,) if text else (), None, None
        ch = text[first]
        met = ("s", EMPTY, ch) if self.kind(ch) == "s" else (self.kind(ch), self.fed(EMPTY, ch.encode())[0], "")
        state, n = self.read(met, (text[first + 1 :],))
        return (text[: first + 1],), n, state

    def composed(self, a: tuple, b: tuple) -> tuple:
        if a[2] is None:
            # The seam may itself be such a place; the head only grows.
            return a[0] + b[0], b[1], b[2]
        state, n = self.read(a[2], b[0])
        return (a[0], a[1] + n, state) if b[2] is None else (a[0], a[1] + n + b[1], b[2])

    def scanned(self, maps: list[tuple], last_only: bool = False) -> list[tuple]:
        """Inclusive prefix scan by pairs: level by level, half the maps each time. last_only: only the last prefix."""
        if len(maps) <= 1:
            return maps
        pairs = [self.composed(maps[k], maps[k + 1]) for k in range(0, len(maps) - 1, 2)]
        if last_only:
            return self.scanned(pairs + maps[len(pairs) * 2 :], True)
        even = self.scanned(pairs)
        out = [maps[0]]
        for k in range(1, len(maps)):
            out.append(even[k // 2] if k % 2 else self.composed(even[k // 2 - 1], maps[k]))
        return out

    def total(self, maps: list[tuple]) -> int:
        """The count of the text whose chunks have these maps, from its beginning to its end."""
        if not maps:
            return 0
        head, n, state = self.scanned(maps, True)[-1]
        own, more = self.read(("start", EMPTY, ""), head)
        return more + (n or 0) + self.end(self.row(state if state is not None else own))

    def count(self, text: str, chunk: int = CHUNK) -> int:
        for special in self.merges.special:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(self.count(p, chunk) for p in parts)
        if len(text) <= chunk:
            row, n = self.run_words(self.start, text)
            return n + self.end(row)
        return self.total([self.chunk_map(text[k : k + chunk]) for k in range(0, len(text), chunk)])


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _short(texts: DataFrame, path: str, kind: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of each row of texts."""

    def make():
        machine = transducer(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = []
            for text in batch.column(2).to_pylist():
                n.append(machine.count(text or ""))
                machine.trim()
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

        return run

    return map_rows(texts, make, f"doc_id {kind}, n_bytes long, n_tokens long")


def _long(texts: DataFrame, path: str, kind: str, part: int) -> DataFrame:
    """The same by state maps of parts, which are dealt over the tasks. A special string is a part of its own, which a map counts as
    one token between two texts: the parts before, between and after are texts of their own."""

    def mapped():
        machine = transducer(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            maps = []
            for text in batch.column("part").to_pylist():
                if text in machine.merges.special:
                    maps.append(None)
                else:
                    maps.append(pickle.dumps(machine.scanned([machine.chunk_map(text[k : k + CHUNK]) for k in range(0, len(text), CHUNK)], True)[-1]))
                machine.trim()
            columns = [batch.column(c) for c in ("doc_id", "n_bytes", "row", "seq")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(maps, pa.binary())], ["doc_id", "n_bytes", "row", "seq", "map"])

        return run

    def composed():
        machine = transducer(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = []
            for own in batch.column("maps").to_pylist():
                total, text = 0, []
                for x in [*(x["map"] for x in own), None]:
                    if x is None:
                        total += 1 + machine.total(text)
                        text = []
                    else:
                        text.append(pickle.loads(x))
                n.append(total - 1)
                machine.trim()
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

        return run

    special = "|".join(re.escape(x) for x in transducer(path).merges.special)
    # Possessive: Java's matcher repeats such a group without recursion.
    pattern = special + "|(?s:(?:(?!" + special + ").){1,%d}+)" % part if special else "(?s:.{1,%d})" % part
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    parts = numbered.select("doc_id", "n_bytes", "row", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("seq", "part"))
    parts = parts.repartition(partitions(texts), "row", "seq")
    maps = map_rows(parts, mapped, f"doc_id {kind}, n_bytes long, row long, seq int, map binary")
    own = maps.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("seq", "map"))).alias("maps"))
    return map_rows(own.select("doc_id", "n_bytes", "maps"), composed, f"doc_id {kind}, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, long: int = LONG_TEXT, part: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    path = tokenizer or default_tokenizer()
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    is_long = F.col("n_bytes") > long
    found = _short(texts.where(~is_long), path, kind)
    if not texts.where(is_long).isEmpty():
        found = found.union(_long(texts.where(is_long), path, kind, part))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
