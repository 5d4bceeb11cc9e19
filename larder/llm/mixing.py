"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised. An
exponent of 1 keeps the natural shares, 0 gives equal weights. The exponent is
bisected so that the mixture has the target entropy (a share of the entropy of equal
weights); the repetition limit raises it further if a small source would be read more
than ``max_epochs`` times.

Weights times the token budget are the sources' budgets. The documents of a source are
dealt to ``blocks`` blocks by hash. Each pass over a source is a new permutation of its
blocks and of the documents within; the last, partial pass takes the documents of the
permutation until the budget is spent. A running sum over blocks (at most ``blocks`` rows
a source) finds the block where that happens, and only that block's documents get a
running sum of their own. Joins are on source and block, so a source with a third of all
rows is spread over ``blocks`` keys.

Nulls, edges: a NULL source is a source of its own. NULL and empty texts have no tokens;
they cost nothing and follow their block. A source without tokens has weight 0 and is
not read. Repeated rows count each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import written


@dataclass(frozen=True)
class MixParams:
    """``entropy``: target as a share of the highest (None: no target). ``budget``: tokens (None: those of the input)."""
    entropy: float | None = 0.97
    max_epochs: float = 4.0
    budget: int | None = None
    blocks: int = 2048
    seed: int = 17


_HALVINGS, _PASSES = 4, 9        # halvings of the exponent per pass over the sources


def measures(sources: DataFrame, exponents: list[float], total: int, budget: int) -> list[tuple[float, float]]:
    """(entropy, most epochs of a source) of the mixture for each exponent: one aggregate over the sources."""
    share = F.col("tokens") / F.lit(float(total))
    sums = []
    for i, e in enumerate(exponents):
        power = F.exp(F.log(share) * F.lit(float(e)))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(share)).alias(f"l{i}"),
                 F.max(power / share).alias(f"m{i}")]
    row = sources.agg(*sums).first()
    return [(math.log(row[f"z{i}"]) - e * row[f"l{i}"] / row[f"z{i}"], row[f"m{i}"] / row[f"z{i}"] * budget / total)
            for i, e in enumerate(exponents)]


def bisect_exponent(sources: DataFrame, total: int, budget: int, n_sources: int, params: MixParams) -> float:
    """The exponent that meets the entropy target and the repetition limit (columns: tokens > 0).

    Entropy falls and the most epochs fall as the exponent grows from 0 to 1, so each condition is
    a threshold; ``_HALVINGS`` halvings are evaluated per pass. Without a target, and at
    targets or limits that no exponent meets, the natural shares (1) are the fallback.
    """
    if n_sources < 2:
        return 1.0
    target = None if params.entropy is None else params.entropy * math.log(n_sources)

    def threshold(meets) -> float:
        """Smallest exponent in [0, 1] that meets a condition that holds from some exponent on."""
        low, high = 0.0, 1.0
        first, last = measures(sources, [0.0, 1.0], total, budget)
        if meets(*first):
            return 0.0
        if not meets(*last):
            return 1.0
        for _ in range(_PASSES):
            n = 1 << _HALVINGS
            points = [low + (high - low) * i / n for i in range(1, n)]
            ok = [meets(*m) for m in measures(sources, points, total, budget)]
            at = ok.index(True) if any(ok) else n - 1
            low, high = ([low, *points][at], [*points, high][at])
        return high

    wanted = 1.0 if target is None else threshold(lambda entropy, epochs: entropy <= target)
    allowed = threshold(lambda entropy, epochs: epochs <= params.max_epochs)
    return max(wanted, allowed)


def with_blocks(docs: DataFrame, params: MixParams) -> DataFrame:
    """Adds n_tokens, __src (source key), __blk (block) and __row (row hash)."""
    row = F.xxhash64(F.lit(params.seed), "doc_id", F.coalesce("text", F.lit("")))
    return (docs.withColumn("n_tokens", F.coalesce(F.regexp_count("text", F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint"))
            .withColumn("__src", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
            .withColumn("__row", row).withColumn("__blk", F.pmod("__row", F.lit(params.blocks)).cast("int")))


def block_plan(tokens: DataFrame, params: MixParams) -> DataFrame:
    """(__src, __blk, weight, epochs, state, room): what each block of each source gives.

    ``epochs`` full passes; in the partial pass state 1 takes the block, 0 leaves it,
    2 takes documents while their running sum fits into ``room``.
    """
    blocks = written(tokens.groupBy("__src", "__blk").agg(F.sum("n_tokens").alias("tokens")), "mix-blocks")
    sources = written(blocks.groupBy("__src").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "mix-sources")
    row = sources.agg(F.sum("tokens").alias("total"), F.count("*").alias("n")).first()
    total, n = int(row["total"] or 0), int(row["n"])
    budget = params.budget if params.budget is not None else total
    exponent = bisect_exponent(sources, total, budget, n, params) if total else 1.0
    power = F.exp(F.log(F.col("tokens") / F.lit(float(max(total, 1)))) * F.lit(exponent))
    z = sources.agg(F.sum(power).alias("z")).first()["z"] or 1.0
    share = sources.select("__src", (power / F.lit(float(z))).alias("weight"), F.col("tokens").alias("src_tokens"))
    planned = share.withColumn("__b", F.floor(F.col("weight") * F.lit(float(budget)) + F.lit(1e-6)).cast("bigint")) \
        .withColumn("epochs", F.floor(F.col("__b") / F.col("src_tokens")).cast("int")) \
        .withColumn("rest", F.col("__b") - F.col("epochs") * F.col("src_tokens"))
    order = Window.partitionBy("__src").orderBy(F.xxhash64(F.lit(params.seed), "epochs", "__blk"), "__blk")   # at most ``blocks`` rows
    return (blocks.join(planned, "__src", "left").fillna(0.0, ["weight"]).fillna(0, ["epochs", "rest"])
            .withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("room", F.col("rest") - F.coalesce("before", F.lit(0)))
            .withColumn("state", F.when((F.col("tokens") <= F.col("room")) & (F.col("rest") > 0), 1)
                        .when(F.col("room") > 0, 2).otherwise(0))
            .select("__src", "__blk", "weight", "epochs", "state", "room"))


def plan_rows(keyed: DataFrame, params: MixParams) -> DataFrame:
    """The rows of ``keyed`` (see ``with_blocks``) with weight and n_copies."""
    plan = written(block_plan(keyed.select("__src", "__blk", "n_tokens"), params), "mix-plan")
    joined = keyed.join(plan, ["__src", "__blk"])
    clear = joined.where("state < 2").withColumn("n_copies", F.col("epochs") + F.col("state"))
    order = Window.partitionBy("__src", "__blk").orderBy(
        F.xxhash64(F.lit(params.seed), "epochs", "__row"), "__row", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    partly = joined.where("state = 2").withColumn(
        "n_copies", F.col("epochs") + (F.sum("n_tokens").over(order) <= F.col("room")).cast("int"))   # one block a source
    return clear.unionByName(partly).drop("epochs", "state", "room")


def mixture(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """doc_id, source, n_tokens, weight (of its source), n_copies (how often the document is read) per row."""
    # written once: the plan and the rows read numbers and hashes, no text again
    rows = written(with_blocks(docs.select("doc_id", "text", "source"), params).drop("text"), "mix-rows")
    return plan_rows(rows, params).select("doc_id", "source", "n_tokens", "weight", "n_copies")


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mixture as rows: the columns of ``docs``, mix_epoch and mix_order, one row per reading.

    Sorting by mix_epoch and mix_order gives the permuted blocks of all sources in turn, and
    another permutation of the documents within a block each epoch: the upper 28 bits of
    mix_order are the block's hash, the lower 36 the document's.
    Columns of ``docs`` with these two names are replaced.
    """
    rows = docs.select("doc_id", "text", "source", F.struct(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("mix_epoch", "mix_order")]).alias("__all"))
    planned = plan_rows(with_blocks(rows, params).drop("text", "source"), params)
    copies = planned.where("n_copies > 0").withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    block = F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.lit(params.seed), "__epoch", "__src", "__blk"), 36), 36)
    order = block.bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(params.seed), "__epoch", "__row"), 28))
    return copies.select("__all.*", F.col("__epoch").alias("mix_epoch"), order.alias("mix_order"))
