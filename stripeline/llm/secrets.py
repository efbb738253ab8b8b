"""Secret scans with Spark expressions only: patterns, and windowed entropy over candidate strings.

Patterns (leftmost, not overlapping, per kind; matches that are too short are dropped, not tried again): assignments
to password-like names, access key ids, long hex runs. Positions come from splitting a text at the matches:
the lengths of what lies between and of the matches add up.

Entropy: candidates are long runs of base64 or identifier characters with a digit, outside an assignment. Each has a
character class (hex, or base64), which gives the window length and the threshold. The window slides over the
candidate; the counts of its characters are fields of a few bits in an array of numbers, so that a step changes two
fields, and the sum of c log2 c over them is updated for the character that comes and the one that goes. A candidate
whose highest windowed entropy log2(w) - sum / w reaches the threshold is a span of kind "entropy", unless an allow-list
pattern matches it or a pattern's span covers it.

Work is linear in a text: positions are running sums in blocks, long candidates are cut into overlapping pieces, and no
pattern repeats a group, which Java's matcher would do by recursion.

Spans are code points, end exclusive. Defined cases: null and empty texts have no spans; null ids and repeated rows
stay; an empty table gives an empty result. The work of a text is in its own row: long texts need no shuffle.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import bound, running

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Maximal runs of one class, so a longer minimum finds the same runs as filtering them afterwards.
ACCESS_LONG, HEX_LONG = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Assignments come first, so that what they cover is no candidate.
ASSIGNED = "(?i:" + ASSIGN.removeprefix("(?i)") + ")"
CANDIDATE = ASSIGNED + "|" + RUN
#: By class: pattern of the whole candidate, its characters, window, least entropy in bits.
CLASSES = {
    "hex": (r"^[0-9a-fA-F-]+$", string.digits + "abcdefABCDEF-", 20, 2.9),
    "base64": (r".", string.ascii_letters + string.digits + "+/_=-", 20, 3.7),
}
#: Candidates that are no secrets: UUIDs, joined words with or without a number, numbers and dates, placeholders (in
#: a very long candidate their letters may stand by chance).
ALLOW = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[A-Za-z/_=+-]*[A-Za-z][0-9]{0,4}[/_=+-]*$",
    r"^[0-9/_=+-]+$",
    r"(?i)^(?=.{20,200}$).*?(?:example|placeholder|xxxx|0123456789|abcdefgh)",
)
#: Candidates that are spans of a pattern as they stand.
COVERED = r"^(?:AKIA[A-Z0-9]{16,}|[0-9a-f]{24,})$"
#: A long candidate is looked at in pieces of so many characters.
PIECE = 4096


def matches(text: Column, pattern: str) -> Column:
    """array of (start, end, found), of every match."""
    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = running(F.zip_with(gaps, found, lambda gap, x: (F.length(gap) + F.length(x)).cast("long")))
        return F.zip_with(ends, found, lambda end, x: F.struct((end - F.length(x)).alias("start"), end.alias("end"), x.alias("found")))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def some(text: Column, pattern: str, may: Column) -> Column:
    """matches(), only where may holds: most texts have none, and one search tells."""
    return F.when(may, matches(text, pattern)).otherwise(F.array().cast("array<struct<start:long,end:long,found:string>>"))


ASCII = "".join(map(chr, range(128)))


def windowed_entropy(text: Column, window: int, characters: str = ASCII) -> Column:
    """The highest entropy, in bits, of a window of so many characters (or of a shorter whole text), by incremental counts.
    Characters beyond the given ones count as one. Long texts are cut into pieces that overlap by a window less one."""
    bits = window.bit_length()
    each = 63 // bits
    fields = {c: k // each * 64 + k % each * bits for k, c in enumerate(characters)}  # number in the array, and shift, of a character's count
    rest = len(characters) // each * 64 + len(characters) % each * bits
    places = F.array(*(F.lit(fields.get(chr(c), rest)) for c in range(128)))
    f = lambda c: c * math.log2(c) if c > 1 else 0.0
    up, down = (F.array(*(F.lit(f(c + d) - f(c)) for c in range(window + 2))) for d in (1, -1))
    count = lambda counts, field: F.call_function("shiftright", F.get(counts, F.shiftright(field, 6)), field.bitwiseAND(63)).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    one = lambda field, k: F.when(F.shiftright(field, 6) == k, F.call_function("shiftleft", F.lit(1).cast("long"), field.bitwiseAND(63))).otherwise(F.lit(0).cast("long"))

    def least(codes: Column) -> Column:
        """The least sum of c log2 c over the windows."""
        full = F.least(F.lit(window), F.size(codes))

        def slide(state: Column, come: Column) -> Column:
            def moved(go: Column) -> Column:
                counts, same = state["counts"], F.coalesce(come == go, F.lit(False))
                gone = F.when(go.isNotNull(), F.get(down, count(counts, go))).otherwise(0.0)
                total = state["total"] + F.when(same, 0.0).otherwise(F.get(up, count(counts, come)) + gone)
                after = F.when(same, counts).otherwise(F.transform(counts, lambda v, k: v + one(come, k) - F.when(go.isNull(), F.lit(0).cast("long")).otherwise(one(go, k))))
                return F.struct(after.alias("counts"), total.alias("total"), (state["at"] + 1).alias("at"), F.when(state["at"] + 1 >= full, F.least(state["least"], total)).otherwise(state["least"]).alias("least"))

            return bound(F.when(state["at"] >= window, F.get(codes, state["at"] - window)), moved)

        none = F.struct(F.array_repeat(F.lit(0).cast("long"), rest // 64 + 1).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("at"), F.lit(math.inf).alias("least"))
        return F.when(F.size(codes) > 0, F.log2(full.cast("double")) - F.aggregate(codes, none, slide)["least"] / full).otherwise(0.0)

    codes = lambda piece: F.transform(F.split(piece, ""), lambda c: F.coalesce(F.get(places, F.ascii(c)), F.lit(rest)))
    overlapped = lambda pieces: F.transform(pieces, lambda piece, k: F.concat(F.coalesce(F.right(F.get(pieces, k - 1), F.lit(window - 1)), F.lit("")), piece))
    pieces = bound(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % max(PIECE, window)), F.lit(0)), overlapped)
    return F.coalesce(F.array_max(F.transform(pieces, lambda piece: bound(codes(piece), least))), F.lit(0.0))


def odd(found: Column) -> Column:
    """Whether a candidate is random enough for its class."""
    verdict = F.lit(False)
    for pattern, characters, window, least in reversed(CLASSES.values()):
        verdict = F.when(found.rlike(pattern), windowed_entropy(found, window, characters) >= least).otherwise(verdict)
    for pattern in (*ALLOW, COVERED, "^" + ASSIGNED):
        verdict = F.when(found.rlike(pattern), F.lit(False)).otherwise(verdict)
    return F.when(found.rlike("[0-9]"), verdict).otherwise(False)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, assign, access, hex, entropy (arrays of start, end, found) of every row."""
    text = F.col("_t")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    long_value = lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6
    rows = rows.select(
        "doc_id", "_t",
        F.filter(some(text, ASSIGN, text.rlike(ASSIGN)), long_value).alias("assign"),
        some(text, ACCESS_LONG, text.contains("AKIA")).alias("access"),
        some(text, HEX_LONG, text.rlike(HEX_LONG)).alias("hex"),
        some(text, CANDIDATE, text.rlike(r"(?=[A-Za-z+/_=-]{0,19}[0-9])[A-Za-z0-9+/_=-]{20}")).alias("candidates"),
    )
    return rows.select("doc_id", "assign", "access", "hex", F.filter("candidates", lambda c: odd(c["found"])).alias("entropy"))


def joined(found: DataFrame, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans by start, then kind as listed, comma-joined."""
    def named(n: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.concat(*(named(n, kind) for n, kind in enumerate(kinds)))
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    found = spans(docs)
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(joined(found, KINDS), 256).alias("base_sha256"), joined(found, (*KINDS, "entropy")).alias("spans"),
    )
