"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

A tree of levels (domain, language, source) carries integer weights. The total budget
of tokens flows from the root down: each node's budget is split among its children in
proportion to their weights, no child getting more than its subtree can give (its
tokens times ``max_epochs``). What a short child can't take goes to its siblings by
their weights; only if all of them are full does their parent take less, which the level
above has already dealt to the parent's own siblings. One sorted pass a level solves
this exactly (the children that saturate are a prefix in order of capacity over weight).

A leaf's budget then buys whole epochs of its documents and a token-prefix of the next
one, in an order seeded by epoch. The prefix is found without ordering a leaf in one
place: tokens are summed by leaf and key range, the range in which the budget ends is
looked up from running sums of those, and only that range's rows are ordered. Its last
key is the leaf's threshold, so documents are chosen where they are, by a join with one
row a leaf; texts are never shuffled.

Defined results: null or empty text has no tokens; null level values are ``(none)``;
rows of equal id share a key and are chosen together or not at all; weights absent from
the table are ``default_weight``, a weight of 0 gets nothing; budgets are whole tokens,
rounded down at every node; a negative or zero budget or an empty table chooses nothing;
texts of any length are counted whole; extra columns are kept, whatever they are called, but
``mix_<level>``, ``mix_tokens`` and ``mix_epoch`` of the input give way to the results of
``mix`` (another ``prefix`` avoids that; ``choose`` does so itself).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rewardmill.llm.common import SMALL_ROWS, discard, free_name, materialise

WHOLE = "decimal(38,0)"
KEY_DIGITS = 3


def space_tokens(text: Column) -> Column:
    """Space-separated tokens of a text: its spaces plus one."""
    plain = F.coalesce(text, F.lit(""))
    spaces = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(F.length(plain) > 0, spaces + 1).otherwise(0).cast("long")


def _level_weights(level: str, table: dict[str, int], default: int) -> Column:
    cases = [F.when(F.col(level) == k, F.lit(int(w))) for k, w in sorted(table.items())]
    return F.coalesce(*cases, F.lit(int(default))).cast(WHOLE)


def split_budget(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``budget``: each parent's ``_above`` dealt to children by ``_w`` up to ``_cap``."""
    ratio = F.when(F.col("_w") > 0, F.col("_cap").cast("double") / F.col("_w").cast("double"))
    order = Window.partitionBy(*parents).orderBy(F.col("_ratio").asc_nulls_last(), name)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy(*parents)
    zero = F.lit(0).cast(WHOLE)
    seen = (
        children.withColumn("_ratio", ratio)
        .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(upto), zero).cast(WHOLE))
        .withColumn("_w_left", (F.sum("_w").over(all_of) - F.coalesce(F.sum("_w").over(upto), zero)).cast(WHOLE))
        .withColumn("_left", (F.col("_above") - F.col("_cap_before")).cast(WHOLE))
        .withColumn("_full", (F.col("_w") > 0) & (F.col("_cap") * F.col("_w_left") <= F.col("_left") * F.col("_w")))
    )
    full_cap = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(all_of), zero).cast(WHOLE)
    full_w = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_w"))).over(all_of), zero).cast(WHOLE)
    rest_w = (F.sum("_w").over(all_of) - full_w).cast(WHOLE)
    share = F.expr("_w * (_above - _full_cap) div _rest_w")
    return (
        seen.withColumn("_full_cap", full_cap).withColumn("_rest_w", rest_w)
        .withColumn("budget", F.when(F.col("_full"), F.col("_cap")).when(F.col("_w") > 0, F.greatest(F.lit(0), share)).otherwise(0).cast(WHOLE))
        .drop("_ratio", "_cap_before", "_w_left", "_left", "_full", "_full_cap", "_rest_w")
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: dict[str, dict[str, int]], budget: int,
    max_epochs: int, default_weight: int = 1,
) -> DataFrame:
    """(levels..., tokens, budget) of every leaf; ``leaves`` has levels and ``tokens``."""
    above: DataFrame | None = None
    for k, level in enumerate(levels):
        path, parents = list(levels[: k + 1]), list(levels[:k])
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").cast("long").alias("tokens"))
        nodes = nodes.withColumn("_cap", (F.col("tokens").cast(WHOLE) * max_epochs).cast(WHOLE)).withColumn(
            "_w", _level_weights(level, weights.get(level, {}), default_weight)
        )
        if above is None:
            nodes = nodes.withColumn("_above", F.lit(max(0, int(budget))).cast(WHOLE))
        else:
            nodes = nodes.join(above, parents)
        dealt = split_budget(nodes, parents, level)
        above = dealt.select(*path, F.col("budget").alias("_above"))
    return dealt.select(*levels, "tokens", F.col("budget").cast("long").alias("budget"))


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget: int | None = None,
    budget_share: float = 0.6, max_epochs: int = 2, seed: int = 17, default_weight: int = 1,
    tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text", prefix: str = "mix",
) -> DataFrame:
    """Rows of ``docs`` chosen, once for every epoch they are read in (``mix_epoch`` from 0),
    with their leaf (``mix_<level>``) and ``mix_tokens``; ``prefix`` names these columns.

    ``budget`` tokens in all, or ``budget_share`` of what the corpus holds.
    """
    names = [f"{prefix}_{k}" for k in levels]
    count = space_tokens(F.col(text_col)) if tokens is None else tokens
    own = {f"{prefix}_{k}": F.coalesce(c.cast("string"), F.lit("(none)")) for k, c in levels.items()}
    base = docs.withColumns({**own, f"{prefix}_tokens": count})
    rows = materialise(base.select(F.col(id_col).cast("string").alias("_id"), *names, F.col(f"{prefix}_tokens").alias("tokens")))
    leaves = rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    if budget is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total * budget_share)
    named = {f"{prefix}_{k}": v for k, v in weights.items()}
    plan = leaf_budgets(leaves, names, named, budget, max_epochs, default_weight)
    plan = materialise(
        plan.filter("tokens > 0").withColumn("_epochs", F.expr("budget div tokens").cast("int"))
        .withColumn("_rest", F.col("budget") - F.col("_epochs") * F.col("tokens"))
        .select(*names, "_epochs", "_rest")
    )
    # one row a leaf, sent to the rows where they are; no leaf's rows meet in one place
    small = plan.count() <= SMALL_ROWS
    sent = F.broadcast if small else (lambda df: df)

    def key(ident: Column, epochs: str = "_epochs") -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(epochs).cast("string"), F.coalesce(ident, F.lit(""))))

    keyed = rows.join(sent(plan), names).withColumn("_key", key(F.col("_id"))).withColumn(
        "_range", F.substring("_key", 1, KEY_DIGITS)
    )
    sums = keyed.groupBy(*names, "_rest", "_range").agg(F.sum("tokens").alias("_sum"))
    running = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        sums.withColumn("_upto", F.sum("_sum").over(running))
        .filter(F.col("_upto") > F.col("_rest"))  # the first range that doesn't fit whole
        .groupBy(*names).agg(F.min_by(F.struct("_range", (F.col("_upto") - F.col("_sum")).alias("_before")), "_range").alias("_e"))
        .select(*names, F.col("_e._range").alias("_range"), F.col("_e._before").alias("_before"))
    )
    within = Window.partitionBy(*names).orderBy("_key")  # equal keys are peers: all or none
    last = (
        keyed.join(sent(ends), [*names, "_range"])
        .withColumn("_run", F.col("_before") + F.sum("tokens").over(within))
        .filter(F.col("_run") <= F.col("_rest"))
        .groupBy(*names).agg(F.max("_key").alias("_last"))
    )
    limits = materialise(
        plan.join(ends, names, "left").join(last, names, "left").select(
            *names, "_epochs",
            # all keys of earlier ranges, and those up to the last that fits
            F.coalesce("_last", "_range", F.lit("g")).alias("_limit"),
        )
    )
    discard(rows, plan)
    epochs, limit = free_name(base.columns, "_epochs"), free_name(base.columns, "_limit")
    limits = limits.withColumnsRenamed({"_epochs": epochs, "_limit": limit})
    times = F.col(epochs) + (key(F.col(id_col).cast("string"), epochs) <= F.col(limit)).cast("int")
    return (
        base.join(sent(limits), names).filter(times > 0)
        .withColumn(f"{prefix}_epoch", F.explode(F.sequence(F.lit(0), times - 1)))
        .drop(epochs, limit)
    )


def choose(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget_share: float, seed: int = 17, **more) -> DataFrame:
    """The documents that :func:`mix` reads at least once, in their own columns only."""
    prefix = "mix"
    while any(c.lower().startswith(f"{prefix}_") for c in docs.columns):
        prefix = f"_{prefix}"
    return mix(docs, levels, weights, budget_share=budget_share, max_epochs=1, seed=seed, prefix=prefix, **more).select(*docs.columns)


def number_domain(source: Column, names: Sequence[str]) -> Column:
    """Domain of a source: the number in its name, modulo the domains."""
    number = F.coalesce(F.nullif(F.regexp_extract(source, "([0-9]+)", 1), F.lit("")).cast("long"), F.lit(0))
    where = number % len(names)
    return reduce(lambda c, k: c.when(where == k, F.lit(names[k])), range(1, len(names)), F.when(where == 0, F.lit(names[0])))
