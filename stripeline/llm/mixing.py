"""Mixing sources to target weights by hierarchical budgeting.

Documents belong to leaves of a domain-language-source tree. A total of tokens (by default words; or what a column
of the documents says) is handed down the tree by weights. What a node can't use (its documents, times ``max_epochs``, hold fewer tokens) goes to its siblings by their
weights; only what all siblings can't use goes up to the parent's siblings. Each leaf then takes its budget as a
prefix, in tokens, of seeded epochs: every epoch is its own pseudo-random order of the leaf's documents, full epochs
come first, then the prefix of the next one, never over the budget.

The prefix needs no sort of a leaf: documents fall into buckets by their place in the order (about ``BUCKET``
documents each), bucket sums are added up, and only the one bucket where the budget ends is sorted. That gives the
leaf's last (place, doc_id); selecting is then a filter of the documents by a table of leaves, without a shuffle of texts.

Up to ``MAX_LEAVES`` leaves are planned on the driver and broadcast. More are planned by the same rule in tables, level by
level: of each node the level of filling is found by rounds of sums over its children; then only leaves that hold over a
thousandth of the documents are broadcast, and the others meet their documents by shuffle.

Defined cases: null domain, language or source is the name "" ; null and empty texts have no tokens and are
taken wherever the prefix reaches them; repeated rows, and rows with null id within a leaf, count as one
document (taken together); an empty table gives an empty result; a token count of null or below zero is zero.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT, join_by, stage

BUCKET = 4096
#: So many leaves at most are planned on the driver and broadcast.
MAX_LEAVES = 100_000
TOKEN = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """Weights by domain, language and source; names that aren't listed weigh ``other``. share: of the tokens there are."""

    domains: dict[str, float] = field(default_factory=dict)
    languages: dict[str, float] = field(default_factory=lambda: {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0})
    sources: dict[str, float] = field(default_factory=dict)
    other: float = 1.0
    share: float = 0.7
    tokens: int | None = None
    max_epochs: int = 2
    seed: int = 17

    def weight(self, level: int, name: str) -> float:
        return (self.domains, self.languages, self.sources)[level].get(name, self.other)


def default_domain(source: str = "source") -> Column:
    """Sources that end with a number form four domains by it; all others are "general"."""
    number = F.regexp_extract(F.col(source), r"([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (F.when(number != "", number).cast("long") % 4).cast("string"))).otherwise("general")


def shared_out(total: float, wanted: dict, weights: dict) -> dict:
    """total by weights, none over what it can use (wanted); what one can't use goes to the others by weight.
    With weight 0 only if all others are full."""
    out, left = dict.fromkeys(wanted, 0.0), float(total)
    for tier in ({k for k in wanted if weights[k] > 0}, {k for k in wanted if weights[k] <= 0}):
        open_ = sorted(tier)
        while open_ and left > 1e-9:
            sum_ = sum(weights[k] if weights[k] > 0 else 1.0 for k in open_)
            each = {k: left * (weights[k] if weights[k] > 0 else 1.0) / sum_ for k in open_}
            full = [k for k in open_ if wanted[k] - out[k] <= each[k] + 1e-9]
            for k in full or open_:
                give = wanted[k] - out[k] if full else each[k]
                out[k] += give
                left -= give
            if not full:
                break
            open_ = [k for k in open_ if k not in full]
    return out


def budgets(available: dict[tuple[str, str, str], int], mix: Mix) -> dict[tuple[str, str, str], int]:
    """Tokens of each leaf. A node's children share what the node got; what a node could use is known beforehand, so shortages meet siblings first."""
    tree: dict = {}
    for (a, b, c), v in available.items():
        tree.setdefault(a, {}).setdefault(b, {})[c] = float(v * mix.max_epochs)
    usable = lambda node: sum(map(usable, node.values())) if isinstance(node, dict) else node

    def down(prefix: tuple, node: dict, total: float) -> dict:
        level = len(prefix)
        wanted = {name: usable(child) for name, child in node.items()}
        given = shared_out(min(total, sum(wanted.values())), wanted, {name: mix.weight(level, name) for name in wanted})
        if level == 2:
            return {(*prefix, name): int(v + 1e-6) for name, v in given.items()}
        return {leaf: v for name, part in given.items() for leaf, v in down((*prefix, name), node[name], part).items()}

    total = mix.tokens if mix.tokens is not None else mix.share * sum(available.values())
    return down((), tree, total) if tree else {}


def weight_column(mix: Mix, level: int) -> Column:
    own = (mix.domains, mix.languages, mix.sources)[level]
    other = F.lit(float(mix.other))
    if not own:
        return other
    return F.coalesce(F.create_map(*(F.lit(x) for name, w in own.items() for x in (name, float(w))))[F.col(LEAF[level])], other)


def shared_out_rows(children: DataFrame, totals: DataFrame, parent: list[str]) -> DataFrame:
    """children (parent columns, wanted, weight and others) with what each gets (got) of its parent's total: shared_out() in tables.
    A child is full where its weight times the level is as much as it wants; a round's level comes from what the children that are
    full leave to the others, and rises until no more are full."""
    tiered = children.withColumn("_tier", (F.col("weight") <= 0).cast("int")).withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0))
    key = [*parent, "_tier"]
    sums = tiered.groupBy(*key).agg(F.sum("wanted").alias("s"), F.sum("weight").alias("w"))
    # The second tier gets what the first can't use.
    before = F.coalesce(F.sum("s").over(Window.partitionBy(*parent).orderBy("_tier").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    groups = sums.join(totals, parent).withColumn("t", F.least(F.greatest(F.col("total") - before, F.lit(0.0)), F.col("s")))
    groups = stage(groups.select(*key, "t", (F.col("t") / F.col("w")).alias("level")), "mixing-levels")
    full, known = F.col("wanted") <= F.col("weight") * F.col("level") + 1e-9, -1
    while True:
        sums = tiered.join(groups, key).groupBy(*key).agg(
            F.first("t").alias("t"), F.first("level").alias("last"), F.coalesce(F.sum(F.when(full, F.col("wanted"))), F.lit(0.0)).alias("s"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("w"), F.sum(full.cast("long")).alias("n"),
        )
        level = F.when(F.col("w") > 0, F.greatest((F.col("t") - F.col("s")) / F.col("w"), F.col("last"))).otherwise(F.lit(float("inf")))
        groups = stage(sums.select(*key, "t", level.alias("level"), "n"), "mixing-levels")
        n = groups.agg(F.sum("n")).first()[0]
        groups = groups.drop("n")
        if n == known:
            break
        known = n
    got = tiered.join(groups, key).withColumn("got", F.when(full, F.col("wanted")).otherwise(F.col("weight") * F.col("level")))
    return got.drop("_tier", "t", "level")


def budget_rows(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves (LEAF, docs, tokens) with their budget: budgets() in tables, level by level."""
    usable = leaves.withColumn("_root", F.lit(0)).withColumn("wanted", (F.col("tokens") * mix.max_epochs).cast("double"))
    total = float(mix.tokens) if mix.tokens is not None else mix.share * float(leaves.agg(F.sum("tokens")).first()[0] or 0)
    totals = leaves.sparkSession.createDataFrame([(0, total)], "_root int, total double")
    for level in range(3):
        parent = ["_root", *LEAF[:level]]
        children = usable.groupBy(*parent, LEAF[level]).agg(F.sum("wanted").alias("wanted")) if level < 2 else usable
        given = shared_out_rows(children.withColumn("weight", weight_column(mix, level)), totals, parent)
        if level < 2:
            totals = stage(given.select(*parent, LEAF[level], F.col("got").alias("total")), "mixing-totals")
    return stage(given.select(*LEAF, "docs", "tokens", F.floor(F.col("got") + 1e-6).cast("long").alias("budget")), "mixing-budgets")


def place(seed: int, epoch: Column, key: str = "doc_id") -> Column:
    """A document's place in an epoch's order, 0 to 2^62."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("int"), F.col(key)), 2)


def _leaf(docs: DataFrame, domain: Column | None) -> list[Column]:
    own = domain if domain is not None else default_domain()
    return [F.coalesce(own, F.lit("")).alias("_domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source")]


LEAF = ["_domain", "_lang", "_source"]


def counted(tokens: str | None) -> Column:
    """Tokens of a row: the named column, or the words of the text."""
    n = F.col(tokens).cast("long") if tokens else F.regexp_count(F.col("text").cast("string"), F.lit(TOKEN)).cast("long")
    return F.greatest(F.coalesce(n, F.lit(0).cast("long")), F.lit(0).cast("long"))


def plan(docs: DataFrame, mix: Mix, domain: Column | None = None, tokens: str | None = None) -> tuple[DataFrame, bool]:
    """A row for each leaf: its names, docs, tokens, budget, full epochs, and the last place and id taken in the epoch after; and whether
    there are MAX_LEAVES of them at most."""
    spark = docs.sparkSession
    counts = stage(docs.select(*_leaf(docs, domain), "doc_id", counted(tokens).alias("n")).groupBy(*LEAF, "doc_id").agg(F.sum("n").alias("n")), "mixing-counts")
    leaves = stage(counts.groupBy(*LEAF).agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")), "mixing-leaves")
    few = leaves.count() <= MAX_LEAVES
    if few:
        rows = leaves.collect()
        got = budgets({tuple(r[:3]): r["tokens"] for r in rows}, mix)
        planned = spark.createDataFrame([(*r, got[tuple(r[:3])]) for r in rows], "_domain string, _lang string, _source string, docs long, tokens long, budget long")
    else:
        planned = budget_rows(leaves, mix)
    full = F.when(F.col("tokens") > 0, F.least(F.floor(F.col("budget") / F.greatest("tokens", F.lit(1))), F.lit(mix.max_epochs))).otherwise(1).cast("int")
    planned = planned.withColumn("full", full).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")).withColumn("buckets", F.ceil(F.col("docs") / BUCKET).cast("long"))
    placed = join_by(counts, planned, LEAF, F.col("docs") * HOT > counts.count(), few)
    placed = placed.where("rest > 0").withColumn("_place", place(mix.seed, F.col("full")))
    wide = (F.lit(1 << 62) / F.col("buckets")).cast("long") + 1
    placed = placed.withColumn("_bucket", F.floor(F.col("_place") / wide).cast("long"))
    sums = placed.groupBy(*LEAF, "_bucket").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"), F.max(F.struct("_place", "doc_id")).alias("last"))
    up_to = Window.partitionBy(*LEAF).orderBy("_bucket")
    sums = stage(sums.withColumn("after", F.sum("n").over(up_to)).withColumn("before", F.col("after") - F.col("n")), "mixing-buckets")
    whole = sums.where("after <= rest").groupBy(*LEAF).agg(F.max("last").alias("last"))
    broken = sums.where("before <= rest and after > rest").select(*LEAF, "_bucket", "before")
    inside = (
        placed.join(F.broadcast(broken) if few else broken, [*LEAF, "_bucket"])  # a row for each leaf; a bucket is no hot key
        .withColumn("after", F.col("before") + F.sum("n").over(Window.partitionBy(*LEAF, "_bucket").orderBy("_place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
        .where("after <= rest").groupBy(*LEAF).agg(F.max(F.struct("_place", "doc_id")).alias("last"))
    )
    last = whole.union(inside).groupBy(*LEAF).agg(F.max("last").alias("last"))
    taken = planned.join(last, LEAF, "left")
    return taken.select(*LEAF, "docs", "tokens", "budget", "full", F.col("last._place").alias("_last_place"), F.col("last.doc_id").alias("_last_id"), F.col("last").isNotNull().alias("_part")), few


def select(docs: DataFrame, mix: Mix | None = None, domain: Column | None = None, tokens: str | None = None) -> DataFrame:
    """_row (the columns of docs), the leaf (_domain, _lang, _source) and _epoch, a row for each time that a document is taken. tokens: a
    column with a document's number of tokens, say from token_counts(); without, its words count."""
    mix = mix or Mix()
    leaves, few = plan(docs, mix, domain, tokens)
    leaves = stage(leaves, "mixing-plan")
    at = place(mix.seed, F.col("full"))
    inside = (at < F.col("_last_place")) | ((at == F.col("_last_place")) & F.coalesce(F.col("doc_id") <= F.col("_last_id"), F.col("doc_id").isNull()))
    times = F.col("full") + F.when(F.col("_part") & F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", *_leaf(docs, domain))  # as a struct, no column clashes with the plan's
    total = 0 if few else leaves.agg(F.sum("docs")).first()[0]
    kept = join_by(rows, leaves, LEAF, F.col("docs") * HOT > total, few).withColumn("_times", times).where("_times > 0")
    epoch = F.lit(0) if mix.max_epochs == 1 else F.explode(F.sequence(F.lit(0), F.col("_times") - 1))
    return kept.select("_row", *LEAF, epoch.alias("_epoch"))


def rows_of(taken: DataFrame) -> DataFrame:
    return taken.select("_row.*")
