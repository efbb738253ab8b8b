"""Token ids in a content-addressed store.

Encoding: the tokenizers library encodes. Where the tokenizer's file says that it drops white space and never looks
across it (``BY_WORDS``), each worker keeps the ids of words it has met (bounded), asks the library for new ones, and
the ids of texts are gathered from them; with any other file the library gets whole texts. Each document ends with
``END_ID``.

Cutting: a rolling (buz) hash over 16 ids cuts each document's id stream where its low bits are zero, within
``MIN_CHUNK`` and ``MAX_CHUNK`` ids, so equal passages give equal chunks wherever they stand. A chunk's address is
the 128-bit blake2b digest of its bytes.

Files under one folder:

* ``chunks`` (Parquet): every distinct chunk once (digest, n, payload of little-endian ids of ``width`` bytes), beside
  rows without payload that say where it is used (doc_id, row, seq); one shuffle makes both.
* ``recipes`` (Parquet, in ascending doc_id order over the files and in them): part, doc_id, row, start in the part,
  n_tokens, chunks (digests in order), lens and root, the Merkle root of the digests.
* ``manifest`` (JSON lines): per part its tokens, documents and Merkle root over document roots, then the root of all.

Reading checks every chunk against its digest, every document's chunks against its root, and every part against the
manifest; anything else raises.

Defined cases: null and empty texts hold only the end id; null ids come first, rows with equal ids keep reading order
(partition, then position) and are documents of their own; an empty table gives an empty store.
"""

from __future__ import annotations

import codecs
import gc
import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, map_rows, new_folder, partitions, release, ship

END_ID = 1
MIN_CHUNK, MEAN_BITS, MAX_CHUNK, WINDOW = 64, 8, 1024, 16
#: Words that a worker remembers at most, and as many from before.
MAX_WORDS = 250_000
#: Bytes of a word's tail of punctuation at most, else the word is looked at as a whole; tails that a worker remembers.
TAIL, MAX_TAILS = 8, 10_000
#: Chunks that a task knows to have sent; beyond, it sends some again, and the shuffle drops them.
MAX_SENT = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The steps before the model of tokenizers that can be encoded by words.
BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: ASCII characters that are neither letters nor digits nor blanks: a run of them after letters is a piece of its own.
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Characters that the steps before the model may change beyond lower case, or that take two characters in lower case.
BEYOND = r"[^\x{0}-\x{17f}]|\x{130}"


class Encoder:
    """ids of texts: by words where the tokenizer drops white space and never looks across it, else whole texts by the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        most = max(self.tokenizer.get_vocab().values(), default=0)
        self.width = 2 if most < 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        suffix = steps["model"].get("end_of_word_suffix")
        plain = bool(suffix) and not steps["model"].get("dropout") and all(steps.get(k) == v for k, v in BY_WORDS.items())
        self.by_words = plain and not any(t["normalized"] or t["single_word"] for t in steps["added_tokens"])
        if not self.by_words:
            return
        #: The library's model alone, for words that its other steps would leave as they are; a word's last token has the suffix.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(most + 1, bool)
        self.last[[k for t, k in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        #: The characters that stand for bytes in byte-level vocabularies; a blank stays.
        letters = [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]
        self.letters = "".join([*letters[:32], " ", *letters[33:]])
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[int, bytes] = {}

    def rest(self) -> None:
        """Between tasks: of the words the late ones stay."""
        self.older = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each of texts, which hold no blanks, all its steps included."""
        out = []
        for k in range(0, len(texts), 2000):
            part = texts[k : k + 2000]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, self.kind).tobytes()
            begins = np.array([a for a, _ in found.offsets], np.int64)
            starts = np.cumsum([0, *(len(x) + 1 for x in part)])
            cuts = (np.searchsorted(begins, starts) * self.width).tolist()
            out += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def modelled(self, words: list[str]) -> list[bytes]:
        """The model's ids of each word."""
        out = []
        for k in range(0, len(words), 2000):
            ids = np.array(self.model.encode_batch_fast([" ".join(words[k : k + 2000])], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * self.width).tolist()
            if len(ends) != len(words[k : k + 2000]):
                raise ValueError("the vocabulary has words without a last token")
            flat = ids.tobytes()
            out += [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def learn(self, words: list[bytes]) -> list[bytes]:
        """ids of each word. Letters alone are one piece, lower case, which goes straight to the model: the library's other
        steps would leave it as it is. All other words take all steps."""
        if not words:
            return []
        plain = letters_only(pa.array(words, pa.large_binary()).view(pa.large_string())).tolist()
        low = b" ".join([w for w, p in zip(words, plain, strict=True) if p]).decode().lower()
        if not low.isascii():
            low = codecs.charmap_decode(low.encode(), "strict", self.letters)[0]
        ids = iter(self.modelled(low.split(" ")) if low else ())
        odd = iter(self.whole([w.decode() for w, p in zip(words, plain, strict=True) if not p]))
        return [next(ids) if p else next(odd) for p in plain]

    def tail(self, key: int) -> bytes:
        """ids of a tail of punctuation, from tail_keys()."""
        out = self.tails.get(key)
        if out is None:
            if len(self.tails) > MAX_TAILS:
                self.tails.clear()
            out = self.tails[key] = self.whole([key.to_bytes(TAIL).lstrip(b"\0").decode()])[0]
        return out

    def known(self, words: list[bytes]) -> list[bytes]:
        """ids of each of words; remembers them."""
        found = list(map(self.words.get, words))
        missing = [k for k, x in enumerate(found) if x is None]
        if len(self.words) + len(missing) > MAX_WORDS:  # the words of late stay one generation longer
            self.older, self.words = self.words, {}
        new = []
        for k in missing:
            x = found[k] = self.older.get(words[k])
            if x is None:
                new.append(k)
        for k, x in zip(new, self.learn([words[k] for k in new]), strict=True):
            found[k] = x
        self.words.update((words[k], found[k]) for k in missing)
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """ids of each of texts, little-endian."""
        ids, bounds = self.streams(texts)
        return [ids[a : b - 1].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]

    def streams(self, texts: list[bytes], end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, each followed by end, and where each text's begin (one more: the end)."""
        if not self.by_words:
            found = [np.array([*self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, end], self.kind) for t in texts]
            return np.concatenate([*found, np.empty(0, self.kind)]), np.cumsum([0, *map(len, found)])
        split = pc.ascii_split_whitespace(pa.array([lowered(t) for t in texts], pa.large_binary()).view(pa.large_string()))
        values = split.flatten()
        # A word is letters and a tail of punctuation, which are pieces of their own, or else stands as it is.
        core = pc.ascii_rtrim(values, PUNCTUATION)
        tail = numbers(pc.subtract(pc.binary_length(values), pc.binary_length(core)))
        core = core.dictionary_encode()
        first = numbers(core.indices)
        odd = (tail > 0) & ~letters_only(core.dictionary)[first] | (tail > TAIL)
        whole = values.filter(pa.array(odd)).dictionary_encode()
        tailed = (tail > 0) & ~odd
        keys = pa.array(tail_keys(values, tail, tailed)).dictionary_encode()
        used = np.zeros(len(core.dictionary), bool)
        used[first[~odd]] = True
        cores = np.flatnonzero(used)
        first = (np.cumsum(used, dtype=np.int32) - 1)[first]
        first[odd] = len(cores) + numbers(whole.indices)  # numbers of 32 bits: a batch is one text or a few megabytes
        ids = self.known([*sliced(core.dictionary.filter(pa.array(used))), *sliced(whole.dictionary)])
        second = np.int32(len(ids)) + numbers(keys.indices)
        ids += [*map(self.tail, keys.dictionary.to_pylist()), np.array([end], self.kind).tobytes()]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // self.width
        pool, begins = np.frombuffer(b"".join(ids), self.kind), np.cumsum(sizes, dtype=np.int64) - sizes
        # Numbers of cores, each followed by that of its tail, if it has one; after each text that of the last entry, the end id.
        after = np.cumsum(tailed, dtype=np.int32)
        at = np.arange(len(first), dtype=np.int32) + after - tailed
        each = np.empty(len(first) + (int(after[-1]) if len(after) else 0), np.int32)
        each[at] = first
        each[at[tailed] + 1] = second
        ends = np.cumsum(numbers(split.value_lengths()).astype(np.int64))
        ends += np.concatenate(([0], after))[ends]
        each = np.insert(each, ends, len(ids) - 1)
        lengths = sizes[each]
        upto = np.cumsum(lengths, dtype=np.int64)
        out = np.empty(int(upto[-1]) if len(upto) else 0, self.kind)
        for k in range(0, len(each), 1 << 18):  # in blocks, as a text may be very long
            part, own = each[k : k + (1 << 18)], lengths[k : k + (1 << 18)]
            a, b = int(upto[k] - own[0]), int(upto[min(k + (1 << 18), len(each)) - 1])
            out[a:b] = pool[np.repeat(begins[part] - (np.cumsum(own) - own), own) + np.arange(b - a)]
        return out, np.concatenate(([0], upto[ends + np.arange(len(texts))]))


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def letters_only(words: pa.Array) -> np.ndarray:
    """Whether each word is letters that the steps before the model only lower-case."""
    return numbers(pc.and_not(pc.utf8_is_alpha(words), pc.match_substring_regex(words, BEYOND))).astype(bool)


def tail_keys(words: pa.LargeStringArray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The last bytes of the chosen words, sizes of them (TAIL at most), as numbers."""
    n = sizes[chosen]
    out = np.zeros(len(n), np.uint64)
    if len(n):
        data = np.frombuffer(words.buffers()[2], np.uint8)
        last = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)[1:][chosen] - 1
        for k in range(int(n.max())):
            own = n > k
            out[own] |= data[last[own] - k].astype(np.uint64) << np.uint64(8 * k)
    return out


def sliced(column: pa.LargeStringArray) -> list[bytes]:
    """Bytes of each value of a column without nulls: faster than one by one."""
    if not len(column):
        return []
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset).tolist()
    data = column.buffers()[2].to_pybytes() if column.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def lowered(text: bytes) -> bytes:
    """ASCII letters in lower case, as the tokenizer would make them later; not where a special token's string or a
    combining mark (U+0300 to U+036F) might tell the cases apart."""
    return text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()


@lru_cache(2)
def encoder(path: str) -> Encoder:
    gc.set_threshold(200_000, 50, 50)  # a worker holds many words, which collections walk in vain
    return Encoder(path)


def mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each id (splitmix64)."""
    x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Buzhash of the window that ends at each id, by doubling; window is a power of two."""
    h, w = mixed(ids), 1
    while w < window:
        turned = (h << np.uint64(w)) | (h >> np.uint64(64 - w))
        h = h.copy()
        h[w:] ^= turned[:-w] if w else turned
        w *= 2
    return h


def cuts(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each stream; bounds: starts of the streams in ids, and the end. A cut depends on its own stream alone: MIN_CHUNK covers the window."""
    marks = np.flatnonzero((rolling(ids) & np.uint64((1 << MEAN_BITS) - 1)) == 0) + 1
    at = np.searchsorted(marks, bounds)
    marks = marks.tolist()
    out = []
    for k in range(len(bounds) - 1):
        last, end, own = int(bounds[k]), int(bounds[k + 1]), []
        for m in marks[at[k] : at[k + 1]]:
            if m - last < MIN_CHUNK or m > end:
                continue
            while m - last > MAX_CHUNK:
                last += MAX_CHUNK
                own.append(last)
            if m - last >= MIN_CHUNK:
                own.append(last := m)
        while end - last > MAX_CHUNK:
            last += MAX_CHUNK
            own.append(last)
        if last < end:
            own.append(end)
        out.append(own)
    return out


def address(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary tree of blake2b digests; an odd node moves up as it is; none: digest of nothing."""
    level = leaves or [address(b"")]
    while len(level) > 1:
        level = [address(b"\x01" + b"".join(level[k : k + 2])) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


#: Polynomial of CRC-32, reflected.
CRC_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC_POLY, reflected."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (CRC_POLY if b & 1 else 0)
    return out


@lru_cache(1)
def _shifts(bits: int = 40) -> np.ndarray:
    """Tables [k][byte's place][byte's value]: a CRC times x to the power 8 * 2^k, by the CRC's bytes."""
    out, base = np.zeros((bits, 4, 256), np.uint32), 1 << 23
    for k in range(bits):
        columns = [_times(base, 1 << b) for b in range(32)]
        for place in range(4):
            for value in range(256):
                x = 0
                for b in range(8):
                    if value >> b & 1:
                        x ^= columns[8 * place + b]
                out[k, place, value] = x
        base = _times(base, base)
    return out


def crc_joins(crcs: np.ndarray, lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32 of each concatenation of parts, from their CRCs and lengths in bytes; offsets: where each begins, and the end.
    A part's CRC, shifted by the bytes after it, is what it gives to the whole."""
    out = np.zeros(len(offsets) - 1, np.uint32)
    if not len(crcs):
        return out
    up_to = np.cumsum(lengths)
    sizes = np.diff(offsets)
    after = np.repeat(up_to[np.maximum(offsets[1:] - 1, 0)], sizes) - up_to
    x, tables = crcs.astype(np.uint32), _shifts()
    for k in range(int(after.max()).bit_length()):
        some = np.flatnonzero(after >> k & 1)
        v, t = x[some], tables[k]
        x[some] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
    own = sizes > 0
    out[own] = np.bitwise_xor.reduceat(x, offsets[:-1][own])
    return out


def chunk_rows(docs: DataFrame, tokenizer: str) -> DataFrame:
    """A row for each chunk of each row of docs: doc_id, row, seq, n, digest, payload (null if the task sent it before)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        row = TaskContext.get().partitionId() << 33
        sent: set[bytes] = set()
        for part in gathered(batches):
            ids, bounds = enc.streams(as_bytes(part.column(1)))
            data = ids.tobytes()
            owners, seqs, ns, digests, payloads = [], [], [], [], []
            for d, own in enumerate(cuts(ids, bounds)):
                last = int(bounds[d])
                for seq, at in enumerate(own):
                    payload = data[last * enc.width : at * enc.width]
                    owners.append(d)
                    seqs.append(seq)
                    ns.append(at - last)
                    digests.append(digest := address(payload))
                    payloads.append(None if digest in sent else payload)
                    sent.add(digest)
                    last = at
            owners = np.array(owners, np.int64)
            columns = [part.column(0).take(pa.array(owners)), pa.array(owners + row), pa.array(seqs, pa.int32()), pa.array(ns, pa.int32())]
            columns += [pa.array(digests, pa.binary()), pa.array(payloads, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "seq", "n", "digest", "payload"])
            row += part.num_rows
            if len(sent) > MAX_SENT:
                sent.clear()
            pa.default_memory_pool().release_unused()  # a worker stays, and would keep what its largest batch took
        enc.rest()
        release()

    ship(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, row long, seq int, n int, digest binary, payload binary")


def gathered(batches: Iterator[pa.RecordBatch], most: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about most bytes: the more texts at once, the fewer distinct words."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _first_payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by digest, those with payload first: the first of each digest keeps it."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        digests = batch.column(4)
        before = pa.concat_arrays([pa.array([last], digests.type), digests.slice(0, batch.num_rows - 1)])
        first = pc.fill_null(pc.not_equal(digests, before), True)
        last = digests[-1].as_py()
        payload = pc.if_else(first, batch.column(5), pa.scalar(None, batch.column(5).type))
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], payload], batch.schema.names)


def write(docs: DataFrame, folder: str, tokenizer: str | None = None) -> str:
    """Writes the store of docs (doc_id, text) under folder, and returns folder."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    rows = chunk_rows(docs, tokenizer)
    n = partitions(docs)
    # Payloads meet by digest, at most one from each task; rows without payload may go anywhere, so a chunk that very
    # many documents share doesn't gather in one task.
    place = F.when(F.col("payload").isNotNull(), F.xxhash64("digest")).otherwise(F.xxhash64("row", "seq"))
    (
        rows.withColumn("_place", place).repartition(n, "_place").drop("_place")
        .sortWithinPartitions("digest", F.col("payload").isNull(), "row", "seq").mapInArrow(_first_payload, rows.schema)
        .write.option("compression", "zstd").parquet(f"{folder}/chunks")
    )
    uses = spark.read.schema(rows.schema).parquet(f"{folder}/chunks").select("doc_id", "row", "seq", "n", "digest")
    kind = dict(uses.dtypes)["doc_id"]
    recipes = (
        uses.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "row").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row", "seq")
        .mapInArrow(_recipes, f"part int, doc_id {kind}, row long, start long, n_tokens long, chunks array<binary>, lens array<int>, root binary")
    )
    recipes.write.option("compression", "zstd").parquet(f"{folder}/recipes")
    parts = sorted((r.asDict() for r in _parts(spark.read.schema(recipes.schema).parquet(f"{folder}/recipes")).collect()), key=lambda r: r["part"])  # one row a part
    lines = [{"part": r["part"], "docs": r["docs"], "tokens": r["tokens"], "root": bytes(r["root"]).hex()} for r in parts]
    lines.append({"root": merkle([bytes(r["root"]) for r in parts]).hex(), "width": encoder(tokenizer).width, "end_id": END_ID})
    spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(lines)], "k int, value string").coalesce(1).sortWithinPartitions("k").select("value").write.text(f"{folder}/manifest")
    return folder


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by document and seq: folds them to a row for each document."""
    part, start, own, done = TaskContext.get().partitionId(), 0, None, []

    def flush():
        nonlocal start
        doc, row, chunks, lens = own
        done.append((part, doc, row, start, sum(lens), chunks, lens, merkle(chunks)))
        start += sum(lens)

    def out(schema):
        cols = list(zip(*done, strict=True))
        kinds = [pa.int32(), schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary()]
        done.clear()
        names = ["part", "doc_id", "row", "start", "n_tokens", "chunks", "lens", "root"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names)

    schema = None
    for batch in batches:
        schema = batch.schema
        for doc, row, n, digest in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "row", "n", "digest")), strict=True):
            if own is None or own[1] != row:
                if own is not None:
                    flush()
                own = (doc, row, [], [])
            own[2].append(digest)
            own[3].append(n)
        if done:
            yield out(schema)
    if own is not None:
        flush()
        yield out(schema)


#: What a block of documents, or a part, comes to.
BLOCKS = "part int, block long, docs long, tokens long, root binary"


def _parts(recipes: DataFrame) -> DataFrame:
    """part, docs, tokens, root of each part; a part's rows are gathered as 16-byte roots by 4096 documents."""
    blocks = recipes.select("part", "start", "row", "n_tokens", "root").withColumn("_block", F.shiftright("start", 20))
    own = F.sort_array(F.collect_list(F.struct("start", "row", "root"))).alias("own")
    level = blocks.groupBy("part", "_block").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"), own)
    rooted = map_rows(level.select("part", "_block", "docs", "tokens", F.transform("own", lambda x: x["root"]).alias("roots")), lambda: _root_batch, BLOCKS)
    sums = (F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    top = rooted.groupBy("part").agg(*sums, F.sort_array(F.collect_list(F.struct("block", "root"))).alias("own"))
    roots = F.transform("own", lambda x: x["root"]).alias("roots")
    return map_rows(top.select("part", F.lit(0).cast("long").alias("_block"), "docs", "tokens", roots), lambda: _root_batch, BLOCKS).drop("block")


def _root_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([merkle(x) for x in batch.column(4).to_pylist()], pa.binary())], ["part", "block", "docs", "tokens", "root"])


def manifest(spark: SparkSession, folder: str) -> tuple[list[dict], dict]:
    """Rows of the parts and the last row; one line a part."""
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/manifest").collect()]
    parts = sorted((x for x in lines if "part" in x), key=lambda x: x["part"])
    top = next(x for x in lines if "width" in x)
    if merkle([bytes.fromhex(x["root"]) for x in parts]).hex() != top["root"]:
        raise ValueError("the manifest's root doesn't match its parts")
    return parts, top


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict]:
    """Chunk rows with payload, recipes with the global start, and the manifest's last row; the recipes are held against the manifest."""
    parts, top = manifest(spark, folder)
    recipes = spark.read.parquet(f"{folder}/recipes")
    found = {r["part"]: (r["docs"], r["tokens"], bytes(r["root"]).hex()) for r in _parts(recipes).collect()}
    if found != {x["part"]: (x["docs"], x["tokens"], x["root"]) for x in parts}:
        raise ValueError("recipes don't match the manifest")
    before, offsets = 0, []
    for x in parts:
        offsets.append((x["part"], before))
        before += x["tokens"]
    offsets = spark.createDataFrame(offsets, "part int, offset long")
    recipes = recipes.join(F.broadcast(offsets), "part").withColumn("start", F.col("start") + F.col("offset")).drop("offset")  # a row for each part
    return spark.read.parquet(f"{folder}/chunks").where("payload is not null").select("digest", "n", "payload"), recipes, top


def summary(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files: each stored chunk is read once, checked and
    summed; a document's CRC is joined from its chunks' by CRC arithmetic, so payloads don't move."""
    chunks, recipes, top = _stored(spark, folder)
    width = top["width"]

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        payload = batch.column(2).cast(pa.binary())
        bounds = np.frombuffer(payload.buffers()[1], np.int32, batch.num_rows + 1, 4 * payload.offset).astype(np.int64)
        data = memoryview(payload.buffers()[2]) if payload.buffers()[2] is not None else memoryview(b"")
        if (np.diff(bounds) != width * batch.column(1).to_numpy().astype(np.int64)).any():
            raise ValueError("a chunk has not as many ids as it should")
        wide = memoryview(np.frombuffer(data, f"<u{width}", (int(bounds[-1]) - int(bounds[0])) // width, int(bounds[0])).astype("<u4").tobytes())
        sums, at = [], bounds.tolist()
        low = at[0]
        for digest, a, b in zip(batch.column(0).to_pylist(), at, at[1:], strict=False):
            if address(data[a:b]) != digest:
                raise ValueError(f"chunk {digest.hex()} is damaged")
            sums.append(zlib.crc32(wide[(a - low) * 4 // width : (b - low) * 4 // width]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], ["digest", "crc"])

    sums = map_rows(chunks, lambda: check, "digest binary, crc long")
    kind = dict(recipes.dtypes)["doc_id"]
    uses = recipes.select("row", F.posexplode(F.arrays_zip("chunks", "lens")).alias("seq", "use")).select("row", "seq", F.col("use.chunks").alias("digest"), F.col("use.lens").alias("n"))
    own = uses.join(sums, "digest").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("seq", "n", "crc", "digest"))).alias("own"))
    whole = recipes.select("doc_id", "row", "start", "n_tokens", "root", F.size("chunks").alias("k")).join(own, "row", "left")

    def join(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, roots = batch.column("own"), batch.column("root").to_pylist()
        sizes = pc.fill_null(pc.list_value_length(own), 0).to_numpy().astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        parts = own.flatten()
        digests, at = parts.field("digest").to_pylist(), offsets.tolist()
        for root, k, a, b in zip(roots, batch.column("k").to_pylist(), at, at[1:], strict=False):
            if b - a != k or merkle(digests[a:b]) != root:
                raise ValueError("a document's chunks don't match its root")
        crcs = crc_joins(parts.field("crc").to_numpy(), 4 * parts.field("n").to_numpy().astype(np.int64), offsets)
        columns = [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_rows(whole, lambda: join, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (array of long) of every document, rebuilt from the files and checked."""
    chunks, recipes, top = _stored(spark, folder)
    width = top["width"]
    kind = dict(recipes.dtypes)["doc_id"]
    uses = recipes.select("row", F.posexplode("chunks").alias("seq", "digest"))
    own = uses.join(chunks, "digest").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("seq", "digest", "payload"))).alias("own"))
    whole = recipes.select("doc_id", "row", "start", "n_tokens", "root").join(own, "row", "left")

    def join(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for own, root, n in zip(*(batch.column(c).to_pylist() for c in ("own", "root", "n_tokens")), strict=True):
            if any(address(x["payload"]) != x["digest"] for x in own) or merkle([x["digest"] for x in own]) != root:
                raise ValueError("a document's chunks don't match its root")
            ids = np.frombuffer(b"".join(x["payload"] for x in own), f"<u{width}")
            if len(ids) != n:
                raise ValueError("a document's length doesn't match its recipe")
            out.append(ids.astype(np.int64))
        columns = [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(out, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return map_rows(whole, lambda: join, f"doc_id {kind}, start long, n_tokens long, ids array<long>")


def token_store(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Writes the store (by default in the shared folder) and returns its summary."""
    spark = docs.sparkSession
    return summary(spark, write(docs, folder or new_folder(spark, "tokens"), tokenizer))
