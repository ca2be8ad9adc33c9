"""Mixing sources to target weights by hierarchical budgeting, with DataFrame operations only.

A token budget runs down a tree of domain, language and source. Every node splits what it got among its children by
their weights; a child that cannot use its share (its documents, repeated max_epochs times, hold fewer tokens) takes
all it has, and its shortage goes to its siblings by weight. A shortage that a whole family cannot use was seen one
level up, because the capacity of a node is the sum of its leaves. Each leaf then takes whole epochs of its documents
and of the last epoch the longest prefix, in that epoch's seeded order, that fits in the rest of its budget.

The prefix is found from sums over ranges of the order, so only one range per leaf is ever sorted; a leaf that holds
most of the corpus is no longer than any other. Null domain, language or source is the branch '(none)'. Null and empty
texts have no tokens and come with the prefix that they stand in. Rows equal in id share one place in the order: they
are taken or left together. Weights are above zero; a value without a weight weighs 1. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselore.llm.columns import numbered, without
from caselore.session import shared_dir

LEVELS = ("domain", "lang", "source")
MIX_COLUMNS = ("mix_domain", "mix_lang", "mix_source", "mix_tokens", "mix_budget", "mix_epoch")
#: Up to so many leaves their budgets are sent to all tasks.
BROADCAST_LEAVES = 20_000
#: So many documents of the largest leaf are in one range of the order.
RANGE_ROWS = 2000


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    """The weight of a level's value as an expression over the stated ones."""
    found = F.lit(1.0)
    for value, weight in weights.get(level, {}).items():
        found = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(found)
    return found


def _share(nodes: DataFrame, parents: DataFrame | float, family: list[str], level: str, weight: Column) -> DataFrame:
    """Split each parent's budget (the root's is a number) among its children: everyone gets weight x level, but no
    more than its capacity.

    In the order of capacity by weight the children that are filled come first; the water level is what is left for
    the others by their weights.
    """
    key = [*family, level]
    children = nodes.groupBy(*key).agg(F.sum("capacity").alias("capacity")).withColumn("w", weight)
    joined = children.join(parents, family) if family else children.withColumn("budget", F.lit(float(parents)))
    order = Window.partitionBy(*family).orderBy(F.col("capacity") / F.col("w"), level)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(*family)
    level_now = ((F.col("budget") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0.0)))
                 / (F.sum("w").over(rest) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))))
    ranked = joined.select(*key, "capacity", "w", level_now.alias("now"))
    first = F.min(F.when(F.col("now") * F.col("w") <= F.col("capacity"),
                         F.struct(F.col("capacity") / F.col("w"), level, "now"))).over(rest)
    return (ranked.withColumn("water", first["now"])
            .select(*key, F.when(F.col("water").isNull(), F.col("capacity"))
                    .otherwise(F.least(F.col("capacity"), F.col("w") * F.col("water"))).alias("budget")))


def budgets(leaves: DataFrame, total: float, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from leaves (domain, lang, source, tokens); budget is a whole number, and
    the budgets add up to the total or all that there is."""
    nodes = leaves.select(*LEVELS, (F.col("tokens").cast("double") * max_epochs).alias("capacity"))
    whole: DataFrame | float = total
    for k, level in enumerate(LEVELS):
        whole = _share(nodes, whole, list(LEVELS[:k]), level, _weight(level, weights))
    return leaves.join(whole, list(LEVELS)).withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("long"))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], total_share: float = 0.8,
        max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs with mix_domain, mix_lang, mix_source, mix_tokens, mix_budget (of the leaf) and mix_epoch
    (from 0). The budget of the whole is total_share of the tokens there are."""
    shared_dir(docs.sparkSession)
    keys = ["mix_domain", "mix_lang", "mix_source"]
    plain, named = numbered(docs.select("*", domain))
    kept = without(docs, *MIX_COLUMNS)
    names = [f"c{i}" for i in kept]
    place = F.coalesce(F.col(named(id_col)).cast("string"), F.lit(""))
    leaf = [F.coalesce(F.col(c), F.lit("(none)")).alias(k)
            for c, k in zip((f"c{len(docs.columns)}", named("lang"), named("source")), keys, strict=True)]
    tagged = plain.select(*dict.fromkeys([*names, named(id_col)]), *leaf, n_tokens(F.col(named(text_col))).alias("mix_tokens"))
    light = tagged.select(*keys, "mix_tokens", place.alias("place")).checkpoint()
    leaves = (light.groupBy(*keys).agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("n"))
              .withColumnsRenamed(dict(zip(keys, LEVELS, strict=True)))).checkpoint()
    size = leaves.agg(F.sum("tokens"), F.max("n"), F.count("*")).first()
    digits = max(1, math.ceil(math.log((size[1] or 1) / RANGE_ROWS + 1, 16)))
    plan = (budgets(leaves, (size[0] or 0) * total_share, weights, max_epochs)
            .select(*[F.col(x).alias(k) for x, k in zip(LEVELS, keys, strict=True)], F.col("budget").alias("mix_budget"),
                    F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0)
                    .cast("int").alias("full"),
                    F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"))).checkpoint()
    small = size[2] <= BROADCAST_LEAVES

    def with_plan(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(F.broadcast(table) if small else table, keys, how)

    def position(epoch: Column, at: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), at))

    # The range of the last epoch's order in which a leaf's budget ends, then the last place in it that fits.
    placed = with_plan(light, plan).withColumn("position", position(F.col("full"), F.col("place")))
    ranges = (placed.groupBy(*keys, "rest", F.substring("position", 1, digits).alias("range"))
              .agg(F.sum("mix_tokens").alias("tokens")))
    upto = F.sum("tokens").over(Window.partitionBy(*keys).orderBy("range"))
    ends = (ranges.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
            .groupBy(*keys).agg(F.min(F.struct("range", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room")))
                                .alias("end")).select(*keys, "end.range", "end.room"))
    inside = with_plan(placed, ends).filter(F.substring("position", 1, digits) == F.col("range"))
    running = F.sum("mix_tokens").over(Window.partitionBy(*keys).orderBy("position"))
    last = (inside.withColumn("running", running).filter(F.col("running") <= F.col("room"))
            .groupBy(*keys).agg(F.max("position").alias("last")))
    # Below `last` everything fits; without one the cut is the start of the range, without a range nothing is over.
    cuts = (plan.join(ends.select(*keys, "range"), keys, "left").join(last, keys, "left")
            .select(*keys, "mix_budget", "full", F.coalesce("last", "range", F.lit("~")).alias("cut"))).checkpoint()
    epochs = F.when((F.col("full") < max_epochs) & (position(F.col("full"), place) <= F.col("cut")), F.col("full"))
    taken = with_plan(tagged, cuts).withColumn("mix_last", F.coalesce(epochs, F.col("full") - 1))
    return (taken.filter(F.col("mix_last") >= 0)
            .select(*names, *keys, "mix_tokens", "mix_budget",
                    F.explode(F.sequence(F.lit(0), F.col("mix_last"))).alias("mix_epoch"))
            .toDF(*[docs.columns[i] for i in kept], *MIX_COLUMNS))
