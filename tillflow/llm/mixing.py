"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks. DataFrame functions only.

Tokens here are words (runs of anything but ASCII white space). Null and empty texts have size 0 and are never taken.
A null source is a source of its own, the last one. An empty table gives an empty result. Rows with the same id, text and
source share one key; which of them a block hits makes no difference to the rows of the result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import WORD, staged

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 64
#: Words of one shard; a source's documents in a shard are summed up in one task.
SHARD_WORDS = 1 << 18
#: Shards that are apportioned together.
FAN = 1024


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """Per document: its id, source, size in words, and a seeded key that orders the blocks."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), "text").cast("binary"))
    return docs.select("doc_id", "source", words.alias("size"), key.alias("key"))


def targets(per_source: DataFrame) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size): weights share all sizes, at most ``MOST_REPEATS`` times a size.

    What is above the limit is shared anew by weight until nobody is above: all others then stand at one level of words
    per weight. In the order of limit per weight the limited sources come first, so running sums find that level.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (position % len(WEIGHTS) + 1).cast("int"))
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_limit), F.lit(0))) / F.sum("weight").over(from_here)
    return (per_source.withColumn("weight", weight).withColumn("cap", MOST_REPEATS * F.col("source_size"))
            .withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("level", level)
            .withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
            .withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double"))))
            .select("source", "source_size", "target"))


def apportion(rows: DataFrame, group: list[str], votes: str, seats: Column, order: list[str], out: str) -> DataFrame:
    """Sainte-Laguë: in each group, ``seats`` go one by one to the highest quotients votes / (2 i + 1); ``out`` counts them.

    Only quotients near the last seat are compared: rounding each share leaves at most as many seats open as there are
    parties, and moving the divisor by as much moves a share by a proportional part.
    """
    whole = Window.partitionBy(*group)
    share = F.when(F.col("_v") > 0, F.col(votes) * F.col("_m") / F.col("_v")).otherwise(F.lit(0.0))
    reach = F.ceil((F.abs(F.col("_m") - F.col("_r")) + F.col("_n")) * F.col("_q") / F.greatest(F.col("_m"), F.lit(1))) + 2
    near = (rows.withColumn("_m", seats.cast("long")).withColumn("_v", F.sum(votes).over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
            .withColumn("_q", share).withColumn("_b", F.floor(F.col("_q") + 0.5))
            .withColumn("_r", F.sum("_b").over(whole)).withColumn("_reach", reach)
            .withColumn("_first", F.greatest(F.col("_b") - F.col("_reach"), F.lit(0)))
            .withColumn("_open", F.col("_m") - F.sum("_first").over(whole)))
    ranked = (near.withColumn("_i", F.explode(F.sequence(F.col("_first"), F.col("_b") + F.col("_reach"))))
              .withColumn("_rank", F.row_number().over(whole.orderBy((F.col(votes) / (2 * F.col("_i") + 1)).desc(), *order, "_i"))))
    taken = F.count_if((F.col("_rank") <= F.col("_open")) & (F.col(votes) > 0))
    return ranked.groupBy(*rows.columns, "_first").agg(taken.alias("_more")).select(*rows.columns, (F.col("_first") + F.col("_more")).alias(out))


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words the mix takes, repeats counted) and its key.

    A source has a shard per ``SHARD_WORDS`` of its own words, so a small one is not torn into parts. The words of a shard, in seeded
    order, are cut into blocks of ``BLOCK_WORDS``. A shard's quota is that many words, at most three times its own: all of the
    shard as often as they allow and then, evenly spaced from a seeded start, as many blocks as the words left over fill.
    """
    every = staged(sizes(docs, seed), "mix-sizes")
    sources = targets(every.groupBy("source").agg(F.sum("size").alias("source_size")))
    total = every.agg(F.sum("size")).first()[0] or 0
    pair = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    every = every.withColumn("pair", pair)
    widths = every.groupBy("pair").agg((1 + F.floor(F.sum("size") / SHARD_WORDS)).alias("shards"))
    every = every.join(widths, "pair").withColumn("shard", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards")).drop("pair", "shards")

    blocks = F.lit(math.ceil(total / BLOCK_WORDS))
    quota = apportion(sources.withColumn("all", F.lit(0)), ["all"], "target", blocks, ["source"], "blocks").drop("all")
    held = every.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).withColumn("fan", F.floor(F.col("shard") / FAN))
    held = held.withColumn("pair", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    named = quota.withColumn("pair", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source")
    fans = apportion(held.groupBy("pair", "fan").agg(F.sum("shard_size").alias("fan_size")).join(named, "pair"),
                     ["pair"], "fan_size", F.col("blocks"), ["fan"], "fan_blocks")
    parts = apportion(held.join(fans, ["pair", "fan"]), ["pair", "fan"], "shard_size", F.col("fan_blocks"), ["shard"], "shard_blocks")
    parts = parts.withColumn("n", F.greatest(F.ceil(F.col("shard_size") / BLOCK_WORDS), F.lit(1)))
    whole, own = F.least(BLOCK_WORDS * F.col("shard_blocks"), MOST_REPEATS * F.col("shard_size")), F.greatest("shard_size", F.lit(1))
    parts = parts.withColumns({"q": whole, "every": F.floor(whole / own), "left": F.floor(whole % own / BLOCK_WORDS + 0.5)})
    parts = staged(parts.select("pair", "shard", "source_size", "target", "n", "every", "left"), "mix-quotas")

    row = Window.partitionBy("pair", "shard").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "pair", "shard").cast("binary")), 1, 8), 16, 10).cast("long")
    placed = (every.withColumn("pair", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
              .withColumn("end", F.sum("size").over(row)).join(parts, ["pair", "shard"])
              .withColumn("turn", start % F.col("n")))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("every") * F.col("size") + _extra(F.col("end")) - _extra(F.col("end") - F.col("size"))).alias("taken"), "key")


def _extra(words: Column) -> Column:
    """How many of the shard's first ``words`` words lie in blocks taken once more: block b is, when (b + turn)·left/n
    passes a whole number in its step."""
    picked = lambda b: F.floor((b + F.col("turn")) * F.col("left") / F.col("n")) - F.floor(F.col("turn") * F.col("left") / F.col("n"))
    block = F.floor(words / BLOCK_WORDS)
    return picked(block) * BLOCK_WORDS + words % BLOCK_WORDS * (picked(block + 1) - picked(block))


def repeated(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents, each as often as the mix takes its words; columns as they were.

    A part of a copy becomes a whole one with that part as its chance, by a seeded hash of the row's key: long documents, whose
    shares are all near their source's, are not all rounded alike, and a source's kept words are expected to be those taken.
    """
    taken = mix(docs, seed).groupBy("key").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("_times"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), "text").cast("binary"))
    chance = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("copies"), "_key").cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    times = (F.floor("_times") + (chance < F.col("_times") - F.floor("_times")).cast("int")).cast("int")
    copies = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    return (docs.withColumn("_key", key).join(taken.withColumnRenamed("key", "_key"), "_key")
            .withColumn("_copy", F.explode(copies)).select(*[F.col(f"`{c}`") for c in docs.columns]))
