"""Mixing sources to target weights by hierarchical budgeting.

Only built-in expressions. The leaves of a tree (domain, language, source) have tokens and each
node a weight among its siblings. A budget of tokens goes down the tree in proportion to the
weights; a node gets no more than its documents give in ``epochs`` passes, and what it lacks
goes to its siblings first. Only what all siblings together lack is left to their parent's.
Each leaf then takes its documents in an order seeded per epoch, whole epochs first and of the
last one the prefix that reaches its share.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.scratch import stored

LEVELS = ("domain", "lang", "source")
#: Tokens of a text: runs of other than white space.
TOKENS = "cast(regexp_count(text, '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+') AS long)"


def share_out(nodes: DataFrame, parent: str, name: str) -> DataFrame:
    """Adds ``share``: whole tokens of the parent's ``total`` for each node, by weight and room.

    Sorted by room per weight, a node is full if its room is within the level that the rest
    could have; the others divide by weight what the full ones leave, rounded down. Weights are
    whole numbers above 0; a weight times the budget has to fit 63 bits.
    """
    same = f"PARTITION BY {parent}" if parent else "PARTITION BY 0"
    order = f"{same} ORDER BY room / weight, {name} ROWS BETWEEN"
    return (
        nodes.selectExpr(
            "*",
            f"coalesce(sum(room) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below",
            f"sum(weight) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest",
        )
        .selectExpr("*", "room * rest <= (total - below) * weight AS full")
        .selectExpr(
            "*",
            f"total - sum(if(full, room, 0)) OVER ({same}) AS remaining",
            f"sum(if(full, 0, weight)) OVER ({same}) AS open",
        )
        .withColumn("share", F.expr("if(full, room, remaining * weight div greatest(open, 1))"))
        .drop("below", "rest", "full", "remaining", "open")
    )


def budgets(leaves: DataFrame, weights: Mapping[str, str], total: int, epochs: int) -> DataFrame:
    """Shares of the leaves (domain, lang, source, tokens), level by level.

    A leaf below a node of weight 0 gets nothing, so it is no room for its parents either.
    """
    for level in LEVELS:
        leaves = leaves.where(f"cast({weights[level]} AS long) > 0")
    upper: DataFrame | None = None
    for depth, level in enumerate(LEVELS):
        own, parent = LEVELS[: depth + 1], LEVELS[:depth]
        nodes = (
            leaves.groupBy(*own)
            .agg((F.sum("tokens") * epochs).alias("room"))
            .withColumn("weight", F.expr(f"cast({weights[level]} AS long)"))
        )
        if upper is None:
            nodes = nodes.withColumn("total", F.lit(total).cast("long"))
        else:
            nodes = nodes.join(upper.select(*parent, F.col("share").alias("total")), list(parent))
        upper = share_out(nodes, ", ".join(parent), level)
    return upper.select(*LEVELS, "share")


def mix(
    docs: DataFrame,
    domain: str,
    weights: Mapping[str, str],
    budget: tuple[int, int] = (3, 5),
    epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with domain, n_tokens and copies: how often each document is taken.

    ``domain`` is an expression over the columns of ``docs``; ``weights`` has one over the names
    of the node and its parents for each of domain, lang and source, whole numbers; nodes of
    weight 0 get nothing. The budget is a fraction of all tokens. Null names count as empty
    ones, null texts have no tokens, and leaves without tokens get nothing. Rows of equal id
    are ordered by text. Columns named like the new ones are replaced; no rows give no rows.
    """
    new = ("domain", "n_tokens", "copies")
    others = [c for c in docs.columns if c.lower() not in new]
    held = docs.selectExpr(
        f"struct({', '.join(f'`{c}`' for c in others)}) AS row",
        f"coalesce(cast({domain} AS string), '') AS domain",
        "coalesce(cast(lang AS string), '') AS lang",
        "coalesce(cast(source AS string), '') AS source",
        "coalesce(cast(doc_id AS string), '') AS id",
        f"coalesce({TOKENS}, 0) AS tokens",
    )
    leaf = list(LEVELS)
    leaves = stored(held.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")), "leaves")
    leaves = leaves.where("tokens > 0")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    shares = stored(
        budgets(leaves, weights, total * budget[0] // budget[1], epochs)
        .join(leaves, leaf)
        .selectExpr(*leaf, "share div tokens AS whole", "share % tokens AS part"),
        "shares",
    )
    # the order of the last epoch: by a digest of seed, epoch and id, cut into 4096 parts
    order = f"md5(concat('{seed}-', whole, '-', id))"
    placed = held.join(shares, leaf, "left").withColumn("place", F.expr(order))
    sums = placed.groupBy(*leaf, F.expr("substring(place, 1, 3)").alias("slot")).agg(
        F.sum("tokens").alias("tokens"), F.first("part").alias("part")
    )
    running = f"PARTITION BY {', '.join(leaf)} ORDER BY slot"
    cuts = stored(
        sums.where("slot IS NOT NULL")
        .selectExpr("*", f"sum(tokens) OVER ({running}) AS until")
        .where("until >= part")
        .groupBy(*leaf)
        .agg(F.min(F.struct("slot", F.expr("until - tokens").alias("before"))).alias("cut")),
        "cuts",
    )
    placed = placed.join(cuts, leaf, "left").withColumn("slot", F.expr("substring(place, 1, 3)"))
    sure = placed.where("slot IS NULL OR slot <> cut.slot").withColumn(
        "taken", F.expr("coalesce(cast(slot < cut.slot AS int), 0)")
    )
    # a slot is a small part of its leaf, so the exact running sum is a small window
    inside = f"PARTITION BY {', '.join(leaf)} ORDER BY place, id, xxhash64(row.text)"
    edge = placed.where("slot = cut.slot").withColumn(
        "taken",
        F.expr(f"cast(cut.before + sum(tokens) OVER ({inside}) - tokens < part AS int)"),
    )
    return sure.unionByName(edge).selectExpr(
        *[f"row.`{c}` AS `{c}`" for c in others],
        "domain",
        "tokens AS n_tokens",
        "cast(coalesce(whole, 0) + taken AS long) AS copies",
    )
