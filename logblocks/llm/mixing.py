"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Sizes are counted JVM-side; only ``(doc_id, source, size)`` goes on.
2. Targets: the sources share the wanted total by weight; a source stops at ``max_epochs`` times
   its size and the excess is shared again by weight (water filling in closed form, over one row
   per source).
3. Blocks of ``block_words`` words go to the sources by highest quotients target / (2k + 1), then
   each source's blocks to its shards by highest quotients of the shards' sizes. The divisor of the
   exact share bounds where the last quotients can lie, so only about three candidates a party are
   ranked instead of every block. No party gets blocks beyond ``max_epochs`` times its size.
4. Selection: a shard's documents stand in seeded order; its quota is a run of blocks from a seeded
   start, going round. A document takes the words of its range that the run covers.

All of it is DataFrame functions. Shards hold about ``shard_docs`` documents by hash of the id, so a
source with a third of all rows is as many shards. Windows run over one shard or over one row per
source; the quotients of a source's shards, however many, are ranked by a range sort.

A null text has size 0; a null source is a source of its own, last in order. A document of size 0
takes 0. Rows that repeat a doc_id are documents of their own (in the order of their sizes). An empty table gives an empty result.
Only doc_id, text and source are read. The same seed gives the same mix under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logblocks.llm.common import WORD, join_null_safe, whole
from logblocks.operators.ordering import number_rows
from logblocks.operators.staging import broadcast_if_small, materialize

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 32
SHARD_DOCS = 1024
MAX_EPOCHS = 3


def seeded(*columns: Column, seed: int) -> Column:
    """An order that depends on the seed alone: the first 60 bits of an MD5."""
    text = F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """``(source, source_size)`` rows with weight and target."""
    by_name = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    cap = (F.col("source_size") * max_epochs).cast("double")
    placed = sources.withColumn("weight", weight.cast("double")).withColumn("cap", cap)
    total = W.partitionBy(F.lit(1))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    placed = (
        placed.withColumn("wanted", F.sum("source_size").over(total) * F.lit(share))
        .withColumn("all_weight", F.sum("weight").over(total))
        # words a unit of weight gets if all sources before this one stop at their caps
        .withColumn(
            "level",
            (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        )
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("water", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(total))
    )
    level = F.col("water")["level"]
    return placed.select(
        "source",
        "source_size",
        F.col("weight").cast("int").alias("weight"),
        F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight"))).alias("target"),
    )


def apportion(parties: DataFrame, group: list[str], key: str, claim: str, seats: str, most: str) -> DataFrame:
    """Sainte-Lague: ``quota`` of the ``seats`` of each group for every party, at most ``most`` each.

    ``claim`` is a party's share, ``seats`` the group's number of blocks. Sums are aggregates and quotients
    are ranked by a range sort, so a group of any size is many tasks' work. ``parties`` is read twice.
    """
    columns = parties.columns
    if not group:
        # written, so that the joins keep a key that is not folded away
        group, parties = ["_all"], materialize(parties.withColumn("_all", F.lit(0)), "mix-all")

    def per_group(df, *aggregates):
        return broadcast_if_small(materialize(df.groupBy(*group).agg(*aggregates), "mix-totals"))

    totals = per_group(parties, F.sum(claim).alias("_claims"), F.count(F.lit(1)).alias("_n"))
    sums = join_null_safe(parties, totals, group)
    exact = F.when(F.col("_claims") > 0, F.col(claim) / F.col("_claims") * F.col(seats)).otherwise(F.lit(0.0))
    # The final divisor moves a party's exact share by at most n/2 * claim/claims; rounding by 1/2.
    reach = F.when(F.col("_claims") > 0, F.col("_n") / 2 * F.col(claim) / F.col("_claims")).otherwise(F.lit(0.0)) + 1
    sums = sums.withColumn("_sure", F.greatest(F.lit(0), F.least(F.col(most), F.floor(exact - reach))).cast("long"))
    sums = sums.withColumn("_last", F.least(F.col(most), F.ceil(exact + reach)).cast("long"))
    sums = materialize(sums.drop("_claims", "_n"), "mix-parties")
    tries = sums.select(
        *group,
        key,
        claim,
        F.explode(F.when(F.col("_last") > F.col("_sure"), F.sequence("_sure", F.col("_last") - 1)).otherwise(F.array())).alias("_seat"),
    ).withColumn("_quotient", F.col(claim) / (2 * F.col("_seat") + 1))
    order = [F.col(g) for g in group] + [F.desc("_quotient"), F.col(key).isNull(), F.col(key), F.col("_seat")]
    ranked = materialize(number_rows(tries, *order, name="_place"), "mix-ranked")
    left = per_group(sums, (F.first(seats) - F.sum("_sure")).alias("_left"))
    first = per_group(ranked, F.min("_place").alias("_first"))
    ranked = join_null_safe(join_null_safe(ranked, left, group), first, group)
    won = ranked.where(F.col("_place") - F.col("_first") < F.col("_left"))
    more = won.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_won"))
    joined = join_null_safe(sums, more, [*group, key], "left")
    return joined.withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0).cast("long"))).select(*columns, "quota")


def _covered(upto: Column) -> Column:
    """Words that the run takes of a shard's first ``upto`` words, whole rounds left out."""
    start, end, size = F.col("start"), F.col("start") + F.col("rest"), F.col("shard_size")
    first = F.greatest(F.lit(0), F.least(upto, end, size) - start)
    return first + F.greatest(F.lit(0), F.least(upto, end - size))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    max_epochs: int = MAX_EPOCHS,
    share: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every document."""
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("long").alias("size"),
    )
    sized = materialize(sized, "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sources = materialize(sources, "mix-sources")
    plan = targets(sources.drop("n_docs"), weights, max_epochs, share)
    plan = plan.withColumn("blocks", F.round(F.sum("target").over(W.partitionBy(F.lit(1))) / block_words).cast("long"))
    plan = plan.withColumn("most", F.floor(F.col("source_size") * max_epochs / block_words))
    plan = apportion(plan, [], "source", "target", "blocks", "most").withColumnRenamed("quota", "source_blocks")
    counts = sources.select("source", F.ceil(F.col("n_docs") / shard_docs).alias("shards"))
    plan = join_null_safe(plan, counts, ["source"])
    plan = materialize(plan.select("source", "source_size", "target", "source_blocks", "shards"), "mix-plan")

    placed = join_null_safe(sized, broadcast_if_small(plan), ["source"])
    placed = placed.withColumn("shard", F.pmod(seeded(F.col("doc_id"), seed=seed), F.col("shards")))
    shards = placed.groupBy("source", "shard", "source_blocks").agg(F.sum("size").alias("shard_size"))
    shards = shards.withColumn("most", F.floor(F.col("shard_size") * max_epochs / block_words))
    quotas = apportion(materialize(shards, "mix-shards"), ["source"], "shard", "shard_size", "source_blocks", "most")
    words = F.col("quota") * block_words
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block_words))
    quotas = quotas.select(
        "source",
        "shard",
        "shard_size",
        F.floor(words / F.greatest("shard_size", F.lit(1))).alias("rounds"),
        (words % F.greatest("shard_size", F.lit(1))).alias("rest"),
        (F.pmod(seeded(F.col("source"), F.col("shard"), seed=seed + 1), n_blocks) * block_words).alias("start"),
    )
    quotas = materialize(quotas, "mix-quotas")
    joined = join_null_safe(placed, quotas, ["source", "shard"])
    order = W.partitionBy("source", "shard").orderBy(seeded(F.col("doc_id"), seed=seed + 2), "doc_id", "size")
    ends = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    placed = joined.withColumn("end", ends)
    taken = F.col("size") * F.col("rounds") + _covered(F.col("end")) - _covered(F.col("end") - F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
