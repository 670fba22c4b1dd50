"""Mixing sources to target weights: hierarchical budgeting in DataFrame operations only.

Sources stand in a tree domain - language - source with an integer weight at every node.  A token
budget goes down from the root; at each node the children get shares by weight, and what a child
can't use (its tokens times max_epochs) goes to its siblings by weight.  As a node never gets more
than its whole subtree can use, shortages are settled among siblings before they reach ancestors.

A leaf with a budget of e times its tokens and some more takes e whole epochs, and of one more a
prefix in the order of a seeded hash.  Where that prefix ends is found by two sums over 4,096
hash ranges each and one inside the last range, so no leaf, however large, is ever sorted or
gathered.  Documents then meet a table with one row per leaf and are never shuffled by it unless
that table is too large for Spark to broadcast.

Defined cases: a null domain, language or source is the name 'unknown'.  Documents without tokens
are not selected.  A budget beyond all tokens times max_epochs selects max_epochs of everything.
Shares are rounded down, so that each level may leave less than one token per child.  Rows with
the same id share one place in the order; at the end of the prefix they share what is left.
Weights below one are an error, unnamed nodes weigh default_weight.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.store import written

LEVELS = ("domain", "language", "origin")
_WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 3  # hexadecimal digits of a hash range


@dataclass(frozen=True)
class Weights:
    domains: dict[str, int] = field(default_factory=dict)
    languages: dict[str, int] = field(default_factory=dict)
    sources: dict[str, int] = field(default_factory=dict)
    default: int = 1

    def of(self, level: int, name: Column) -> Column:
        known = (self.domains, self.languages, self.sources)[level]
        if any(w < 1 for w in (*known.values(), self.default)):
            raise ValueError("weights must be positive integers")
        weight = F.lit(self.default)
        if known:
            table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
            weight = F.coalesce(table[name], weight)
        return weight.cast("bigint")


def count_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(_WORD)), F.lit(0)).cast("bigint")


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def share_out(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """nodes (parents, child, capacity, weight, budget of the parent) with `share` of each child.

    Children are filled in the order of capacity by weight: those whose capacity is within their
    share keep it, the others divide the rest by weight.
    """
    big = lambda c: c.cast("decimal(38,0)")
    all_of = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = all_of.orderBy(F.col("capacity") / F.col("weight"), child)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = big(F.col("capacity")) * left <= big(F.col("weight")) * big(F.col("budget") - before)
    nodes = nodes.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(all_of)
    rest = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(all_of)
    nodes = nodes.withColumn("used", used).withColumn("rest", rest)
    part = F.expr("(cast(weight as decimal(38,0)) * cast(budget - used as decimal(38,0))) div rest")
    return nodes.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(part)).drop("full", "used", "rest")


def budgets(leaves: DataFrame, weights: Weights, total: Column, max_epochs: int) -> DataFrame:
    """One row per leaf (LEVELS, tokens) with its token budget."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    known: DataFrame | None = None
    for level, name in enumerate(LEVELS):
        above, here = list(LEVELS[:level]), list(LEVELS[: level + 1])
        nodes = leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weights.of(level, F.col(name)))
        if known is None:
            everything = F.sum("capacity").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("budget", F.least(total.cast("bigint"), everything))
        else:
            nodes = nodes.join(known.withColumnRenamed("share", "budget"), above)
        known = share_out(nodes, above, name).select(*here, "share")
    return leaves.join(known.withColumnRenamed("share", "budget"), list(LEVELS)).drop("capacity")


def _crossing(rows: DataFrame, unit: str, goal: str) -> DataFrame:
    """Per leaf the unit in which the running sum of tokens reaches past the goal, and what the
    goal has left before it."""
    key = list(LEVELS)
    sums = rows.groupBy(*key, goal, unit).agg(F.sum("n_tokens").alias("n"))
    order = Window.partitionBy(*key).orderBy(unit)
    sums = sums.withColumn("before", F.sum("n").over(order) - F.col("n"))
    return sums.where((F.col("before") <= F.col(goal)) & (F.col(goal) < F.col("before") + F.col("n"))).select(
        *key, unit, (F.col(goal) - F.col("before")).alias("left")
    )


def plan(counted: DataFrame, weights: Weights, total: Column, max_epochs: int, seed: int) -> DataFrame:
    """One row per leaf: tokens, budget, epochs taken whole, and cut - the hash up to which one
    more epoch goes -, with `left`, the tokens of the document at the cut.

    counted: LEVELS, doc_id, n_tokens."""
    key = list(LEVELS)
    leaves = counted.where("n_tokens > 0").groupBy(*key).agg(F.sum("n_tokens").alias("tokens"))
    leaves = written(budgets(leaves, weights, total, max_epochs), "mix-budgets")
    leaves = leaves.withColumn("epochs", F.expr("budget div tokens")).withColumn("goal", F.expr("budget % tokens"))
    rows = counted.where("n_tokens > 0").join(leaves.where("goal > 0").select(*key, "epochs", "goal"), key)
    rows = rows.withColumn("hash", _key(seed, F.col("epochs"), F.col("doc_id")))
    for depth in (1, 2):
        rows = rows.withColumn("range", F.substring("hash", 1, _DIGITS * depth))
        found = written(_crossing(rows, "range", "goal"), "mix-ranges")
        rows = rows.join(found, [*key, "range"]).withColumn("goal", F.col("left")).drop("left", "range")
    cut = _crossing(rows, "hash", "goal")
    at = rows.select(*key, "hash").join(cut, [*key, "hash"]).groupBy(*key, "hash", "left").agg(F.count("*").alias("rows"))
    at = at.select(*key, F.col("hash").alias("cut"), F.expr("left div rows").alias("left"))
    return written(leaves.drop("goal").join(at, key, "left"), "mix-plan")


def mix(
    docs: DataFrame, weights: Weights, share: float = 1.0, max_epochs: int = 4, seed: int = 1, text: str = "text",
    domain: Column | None = None, language: Column | None = None, source: Column | None = None, total: int | None = None,
) -> DataFrame:
    """docs, each row once per epoch in which it is taken, with LEVELS, n_tokens, epoch (from 0)
    and taken: how many of its tokens, from the first, belong to the mixture.

    The budget is `total` tokens, or `share` of all tokens.  Columns of the input that have the
    name of a result column are replaced.
    """
    name = lambda c, other: F.coalesce((c if c is not None else F.col(other)).cast("string"), F.lit("unknown"))
    paths = (name(domain if domain is not None else F.lit("all"), ""), name(language, "lang"), name(source, "source"))
    key = list(LEVELS)
    own = ["n_tokens", "epoch", "taken", "hash", *key]
    kept = [c for c in docs.columns if c not in own]
    docs = docs.select(*kept, *[p.alias(k) for p, k in zip(paths, key, strict=True)], count_words(text).alias("n_tokens"))
    counted = written(docs.select("doc_id", *key, "n_tokens"), "mix-counted")
    if total is None:
        tokens = counted.agg(F.sum("n_tokens")).first()[0] or 0
        total = int(tokens * share)
    leaves = plan(counted, weights, F.lit(total), max_epochs, seed).drop("tokens", "budget")
    rows = docs.where("n_tokens > 0").join(leaves, key).withColumn("hash", _key(seed, F.col("epochs"), F.col("doc_id")))
    last = F.when(F.col("hash") < F.col("cut"), F.col("n_tokens")).when(F.col("hash") == F.col("cut"), F.least("left", "n_tokens"))
    rows = rows.withColumn("last", F.coalesce(last, F.lit(0)).cast("bigint"))
    rows = rows.withColumn("times", F.col("epochs") + F.when(F.col("last") > 0, 1).otherwise(0)).where("times > 0")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)))
    taken = F.when(F.col("epoch") < F.col("epochs"), F.col("n_tokens")).otherwise(F.col("last"))
    return rows.select(*kept, *key, "n_tokens", "epoch", taken.alias("taken"))


def prefix(text: str, taken: str = "taken", n_tokens: str = "n_tokens") -> Column:
    """The text as far as it is taken; a cut text's tokens are joined by one space."""
    words = F.regexp_extract_all(F.col(text).cast("string"), F.lit(_WORD), F.lit(0))
    return F.when(F.col(taken) < F.col(n_tokens), F.array_join(F.slice(words, F.lit(1), F.col(taken).cast("int")), " ")).otherwise(F.col(text))
