"""Operator 4: mixing sources to target weights, in DataFrame operations only.

Documents hang in a tree, such as domain, language, source. A budget of tokens runs
from the root down: each node splits its own among its children by weight, but no
child gets more than its subtree can give in the allowed number of epochs. What
a full child cannot take goes to its siblings; only what a whole family cannot
take is left, at once, to the families beside it, because a family's limit is
known before its parent splits. A leaf takes whole epochs and then the beginning of
one more, whose order is drawn from a seed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlens.llm.rows import unused_name
from commitlens.scratch import stored

# Characters of the order's hexadecimal key that name a bucket: 4096 of them per leaf.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, its value of a document, and a node's weight.

    `value` is an expression over the documents, `weight` a whole number of at
    least 0 as an expression over the names of this level and those above it.
    Null values are a node like others; a null weight is 0 and keeps a node out.
    """

    name: str
    value: Column
    weight: Column


def count_words(text: Column) -> Column:
    """Number of words between white space; 0 for a null."""
    words = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]+")
    return F.size(F.array_remove(words, "")).cast("long")


def draw_key(seed: int, epoch: Column, key: Column) -> Column:
    """Hexadecimal key that orders a leaf's documents in one epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null"))))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def _split(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """`share` of each node: its part of the family's `budget`, by `weight` up to `limit`.

    Children in order of limit for their weight: the first ones fill up, as long as
    an even split of what is left would fill them.
    """
    fill = F.when(F.col("weight") > 0, F.col("limit").cast("double") / F.col("weight"))
    along = Window.partitionBy(*parents).orderBy(fill.asc_nulls_last(), F.col(name).asc_nulls_last())
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    onward = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    to_here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    family = Window.partitionBy(*parents)
    left = F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    full = (F.col("weight") == 0) | (F.col("limit") * F.sum("weight").over(onward) <= left * F.col("weight"))
    open_weight = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    # Rounded along the order, so that the parts add up to what there is.
    upto = F.expr("(budget - filled) * open_to_here div open_weight")
    since = F.expr("(budget - filled) * (open_to_here - own_open) div open_weight")
    return (
        nodes.withColumn("full", full)
        .withColumn("own_open", open_weight)
        .withColumn("filled", F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(family))
        .withColumn("open_weight", F.sum("own_open").over(family))
        .withColumn("open_to_here", F.sum("own_open").over(to_here))
        .withColumn("share", F.when(F.col("full"), F.col("limit")).otherwise(upto - since))
        .drop("full", "own_open", "filled", "open_weight", "open_to_here")
    )


def leaf_budgets(
    leaves: DataFrame, levels: list[Level], budget: int | None, percent: int, max_epochs: int
) -> DataFrame:
    """`(levels..., tokens, share)`: tokens each leaf has and gets.

    `leaves` holds the levels' names and `tokens`. The tree's size is the number of
    its leaves, never that of the documents.
    """
    names = [level.name for level in levels]
    tree = leaves
    for depth, level in enumerate(levels):
        tree = tree.withColumn(f"weight_{depth}", F.greatest(F.coalesce(level.weight.cast("long"), F.lit(0)), F.lit(0)))
    counts = [F.when(F.col(f"weight_{d}") > 0, 1).otherwise(0) for d in range(len(levels))]
    inside = F.expr("1")
    for count in counts:
        inside = inside * count
    # What a subtree can give; nothing below a node that is kept out.
    tree = tree.withColumn("leaf_limit", F.col("tokens") * max_epochs * inside)
    tree = stored(tree)
    tokens, limit = tree.agg(F.sum("tokens"), F.sum("leaf_limit")).first()
    whole = min(tokens * percent // 100 if budget is None else budget, limit) if tokens is not None else 0
    above = None
    for depth in range(len(levels)):
        path, parents = names[: depth + 1], names[:depth]
        nodes = tree.groupBy(*path).agg(F.sum("leaf_limit").alias("limit"), F.max(f"weight_{depth}").alias("weight"))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(whole).cast("long"))
        else:
            joined = nodes.join(above, _same(nodes, above, parents))
            nodes = joined.select(*(nodes[c] for c in path), "limit", "weight", "budget")
        above = stored(_split(nodes, parents, path[-1]).select(*path, F.col("share").alias("budget")))
    return tree.join(above, _same(tree, above, names)).select(
        *(tree[c] for c in names), "tokens", F.col("budget").alias("share")
    )


def draw(
    docs: DataFrame,
    levels: list[Level],
    budget: int | None = None,
    percent: int = 100,
    max_epochs: int = 2,
    seed: int = 17,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """`(light, plan)`: documents with levels and `tokens`, and per leaf what is taken.

    The plan has `epochs`, taken whole, and `last`, the largest order key taken in
    the epoch after them, null for none.
    """
    names = [level.name for level in levels]
    light = stored(
        docs.select(
            F.col(key).alias("__key"),
            count_words(F.col(text)).alias("tokens"),
            *(level.value.cast("string").alias(level.name) for level in levels),
        )
    )
    leaves = light.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    shares = leaf_budgets(leaves, levels, budget, percent, max_epochs)
    plan = stored(
        shares.withColumn("epochs", F.expr("coalesce(share div nullif(tokens, 0), 0)"))
        .withColumn("rest", F.col("share") - F.col("epochs") * F.col("tokens"))
    )
    # Tokens per bucket of the last epoch's order, then the one bucket it ends in.
    open_ = plan.filter("rest > 0").drop("tokens")
    drawn = light.join(open_, _same(light, open_, names)).select(
        *(light[c] for c in names), "tokens", "rest", draw_key(seed, F.col("epochs"), F.col("__key")).alias("order")
    )
    bucket = F.substring("order", 1, BUCKET_DIGITS).alias("bucket")
    sums = drawn.groupBy(*names, bucket).agg(F.sum("tokens").alias("tokens"), F.max("rest").alias("rest"))
    along = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = stored(
        sums.withColumn("before", F.coalesce(F.sum("tokens").over(along), F.lit(0)))
        .filter("before < rest AND before + tokens >= rest")
        .select(*names, "bucket", "before")
    )
    at_cut = drawn.withColumn("bucket", bucket)
    at_cut = at_cut.join(cut, _same(at_cut, cut, [*names, "bucket"]), "inner").select(
        *(at_cut[c] for c in names), "order", "tokens", "rest", "before"
    )
    # Documents that share a key share their place.
    ties = at_cut.groupBy(*names, "order").agg(F.sum("tokens").alias("tokens"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    inside = Window.partitionBy(*names).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        ties.withColumn("start", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .filter("start < rest")
        .groupBy(*names)
        .agg(F.max("order").alias("last"))
    )
    last = stored(last)
    joined = plan.join(last, _same(plan, last, names), "left")
    return light, stored(joined.select(*(plan[c] for c in names), "share", "epochs", "last"))


def _copies(seed: int, key: Column) -> Column:
    """Numbers of the epochs that a document is taken in."""
    more = F.coalesce(draw_key(seed, F.col("epochs"), key) <= F.col("last"), F.lit(False))
    n = F.col("epochs") + more.cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def mix(docs: DataFrame, levels: list[Level], key: str = "doc_id", seed: int = 17, **options) -> DataFrame:
    """`(key, levels..., tokens, epoch)`: one row for each time that a document is taken.

    `options` are those of `draw`: a `budget` in tokens or a `percent` of all
    tokens, and `max_epochs`. A leaf's documents are taken in the order of a seeded
    draw until their tokens before one reach the leaf's share. Tokens are words.

    A null text has no token. Documents that repeat a key, nulls among them, are
    drawn together. An empty table, or weights of 0 all over, give no row. Columns
    that neither levels, key nor text name are not read.
    """
    light, plan = draw(docs, levels, seed=seed, key=key, **options)
    names = [level.name for level in levels]
    joined = light.join(plan, _same(light, plan, names))
    return joined.select(
        F.col("__key").alias(key),
        *(light[c] for c in names),
        "tokens",
        F.explode(_copies(seed, F.col("__key"))).alias("epoch"),
    )


def take_mixed(docs: DataFrame, levels: list[Level], key: str = "doc_id", seed: int = 17, **options) -> DataFrame:
    """The rows of `docs` as often as they are taken, columns unchanged."""
    _, plan = draw(docs, levels, seed=seed, key=key, **options)
    renamed = {level.name: unused_name(docs, f"__{level.name}") for level in levels}
    epoch = unused_name(docs, "__epoch")
    plan = plan.select(*(F.col(c).alias(renamed[c]) for c in renamed), "epochs", "last")
    held = {c: unused_name(docs, f"__{c}") for c in ("epochs", "last")}
    plan = plan.withColumnsRenamed(held)
    own = [F.struct(*(level.value.cast("string").alias(renamed[level.name]) for level in levels)).alias(epoch)]
    rows = docs.select("*", *own)
    match = F.lit(True)
    for name in renamed.values():
        match = match & rows[epoch][name].eqNullSafe(plan[name])
    taken = rows.join(plan, match)
    more = F.coalesce(draw_key(seed, F.col(held["epochs"]), rows[key]) <= F.col(held["last"]), F.lit(False))
    n = F.col(held["epochs"]) + more.cast("int")
    copies = F.when(n > 0, F.array_repeat(F.lit(0), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    once = unused_name(docs, "__copy")
    return taken.select(*(rows[c] for c in docs.columns), F.explode(copies).alias(once)).drop(once)
