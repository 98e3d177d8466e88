"""Operator 1: mixing sources to target weights.

A source's documents fall into blocks by a hash; its target decides how many whole
passes over all blocks the mix takes and how much of one further pass. In each pass
the blocks are in a permuted order, and the further pass takes them in that order
until its words are reached: whole blocks first, then whole sub-blocks of the next
block, then single documents of the next sub-block. The drawn blocks are dealt to
output shards by a splitting tree: at each node the shards are halved, and a
multivariate hypergeometric draw divides the node's blocks of every source
between the halves, so every shard gets its exact number of blocks in fair
proportions. A shard's blocks are disjoint ranges of the permuted order, and its
documents are shuffled locally by a hash.

On the driver: one row per source (``MAX_SOURCES``, checked). Everything else stays
in Spark; each shard walks the tree from the root by itself, with seeded draws.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import cut

#: Sources that may reach the driver, words aimed at in a block, blocks of a source or of a block.
MAX_SOURCES, BLOCK_WORDS, MAX_BLOCKS = 200_000, 1 << 16, 4096
#: Words of a shard, where the number of shards isn't given.
SHARD_WORDS = 1 << 21
#: No document is taken more often.
MOST = 3


def weights(count: int) -> list[int]:
    """1, 2, 3, repeating, for sources in order."""
    return [1 + i % 3 for i in range(count)]


def targets(sizes: list[int], shares: list[int], most: int = MOST) -> list[float]:
    """What each source gives when all sizes are shared by weight and none exceeds ``most`` times its own.

    What a stopped source leaves is shared again by weight among the others,
    until none is above its limit.
    """
    out, total = [0.0] * len(sizes), float(sum(sizes))
    going = set(range(len(sizes)))
    while going:
        weight = sum(shares[i] for i in going)
        over = {i for i in going if total * shares[i] / weight > most * sizes[i]}
        for i in over or going:
            out[i] = float(most * sizes[i]) if over else total * shares[i] / weight
        if not over:
            break
        total -= sum(out[i] for i in over)
        going -= over
    return out


@dataclass
class Source:
    """A source's place in code point order, its words and target, and how the target is drawn."""

    name: str | None
    size: int
    target: float
    passes: int
    rest: int
    blocks: int


def plan(totals: list[tuple[str | None, int]]) -> list[Source]:
    ordered = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [size for _, size in ordered]
    out = []
    for (name, size), target in zip(ordered, targets(sizes, weights(len(sizes))), strict=True):
        passes, rest = divmod(round(target), size) if size else (0, 0)
        out.append(Source(name, size, target, passes, rest, min(MAX_BLOCKS, -(-size // BLOCK_WORDS)) or 1))
    return out


def quotas(drawn: list[int], shards: int, shard: int, seed: int) -> np.ndarray:
    """How many drawn blocks of each source fall into ``shard``: its leaf of the splitting tree."""
    left = np.array(drawn, dtype=np.int64)
    low, high = 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        total = int(left.sum())
        # Block places are dealt evenly: the shards up to s hold total * s / shards of all.
        part = total * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        first = rng.multivariate_hypergeometric(left, part, method="marginals") if total else left * 0
        left, low, high = (first, low, middle) if shard < middle else (left - first, middle, high)
    return left


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    """``_id``, ``_source``, ``_size`` (words) and ``_hash`` of every row, and ``more`` columns."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    key = F.xxhash64(F.lit("mix"), F.col(id_col).cast("string"), F.col(text_col))
    source = F.col(source_col).cast("string").alias("_source")
    return docs.select(F.col(id_col).alias("_id"), source, size.alias("_size"), key.alias("_hash"), *more)


def located(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """The rows with what is known of their source, and their block."""
    block = F.pmod(F.xxhash64(F.lit(seed), F.lit(1), "_hash"), F.col("blocks")).cast("int")
    joined = rows.join(F.broadcast(sources), rows["_source"].eqNullSafe(sources["name"]))
    return joined.withColumn("block", block).drop("_source", "name", "blocks")


def _reached(words: DataFrame, unit: str, salt: int, seed: int, limit: str) -> DataFrame:
    """Units of each source in permuted order: those ``whole`` within ``limit``, and what is ``left`` for the next.

    At most ``MAX_BLOCKS`` rows of a source meet in the window, whatever its size.
    """
    upto = F.expr(
        f"sum(words) OVER (PARTITION BY s ORDER BY xxhash64({seed}, {salt}, s, {unit}), {unit}"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    room = F.col(limit) - F.col("upto") + F.col("words")
    return words.withColumn("upto", upto).withColumns(
        {"whole": F.col("upto") <= F.col(limit), "left": F.when((F.col("upto") > F.col(limit)) & (room > 0), room)}
    )


@dataclass
class Draws:
    """``sources``, and their ``blocks`` with the units drawn and what of a block where a source ends is in the last."""

    sources: DataFrame
    blocks: DataFrame
    shards: int


def draw(rows: DataFrame, shards: int | None, seed: int) -> Draws:
    """What the mix takes of these measured rows, which are read several times."""
    spark = rows.sparkSession
    found = rows.groupBy("_source").agg(F.sum("_size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sources = plan([(row["_source"], row["n"]) for row in found])
    shards = shards or max(1, -(-sum(s.size for s in sources) // SHARD_WORDS))
    table = spark.createDataFrame(
        [(i, s.name, s.size, s.target, s.passes, s.rest, s.blocks) for i, s in enumerate(sources)],
        "s int, name string, source_size long, target double, passes int, rest long, blocks int",
    )

    # Empty documents weigh nothing and take no part in the plan.
    known = located(rows.where("_size > 0"), table, seed)
    sums = known.groupBy("s", "block").agg(
        F.sum("_size").alias("words"), F.first("rest").alias("rest"), F.first("passes").alias("passes")
    )
    subs = F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("words") / BLOCK_WORDS)).cast("int")
    blocks = cut(_reached(sums, "block", 2, seed, "rest").withColumn("subs", subs).drop("upto", "words", "rest"))

    # Every full pass over a block is a unit, and so is what the further pass takes of it.
    taken = F.col("passes") + (F.col("whole") | F.col("left").isNotNull()).cast("int")
    units = blocks.withColumn("taken", taken).where("taken > 0")
    units = units.select("s", "block", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("pass"))
    drawn = {row["s"]: row["n"] for row in units.groupBy("s").agg(F.count("*").alias("n")).collect()}
    counts = [drawn.get(i, 0) for i in range(len(sources))]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                quota = quotas(counts, shards, shard, seed)
                of = np.flatnonzero(quota)
                columns = [pa.array(of, pa.int32()), pa.array([shard] * len(of), pa.int32()), pa.array(quota[of], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["s", "shard", "quota"])

    # A source's drawn units in permuted order, cut into the shards' quotas.
    shares = spark.range(shards).mapInArrow(leaves, "s int, shard int, quota long")
    end = F.expr("sum(quota) OVER (PARTITION BY s ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    places = shares.withColumn("end", end).select(
        "s", "shard", F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("place")
    )
    place = F.expr(f"row_number() OVER (PARTITION BY s ORDER BY xxhash64({seed}, 3, s, pass, block), pass, block) - 1L")
    placed = units.withColumn("place", place).join(places, ["s", "place"])
    units = placed.groupBy("s", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("units"))

    # The block in which a source's further pass ends: whole sub-blocks, then documents of the next.
    ends = known.join(blocks.where("left IS NOT NULL").select("s", "block", "left", "subs"), ["s", "block"])
    ends = ends.withColumn("sub", _sub(seed))
    sums = ends.groupBy("s", "block", "sub").agg(F.sum("_size").alias("words"), F.first("left").alias("room"))
    reached = cut(_reached(sums, "sub", 5, seed, "room").select("s", "block", "sub", "whole", "left"))
    last = ends.drop("left").join(reached.where("left IS NOT NULL"), ["s", "block", "sub"])
    last = last.groupBy("s", "block", "sub", "_hash").agg(F.sum("_size").alias("words"), F.first("left").alias("left"))

    def fitting(group: pd.DataFrame) -> pd.DataFrame:
        # Documents in permuted order; each that still fits is taken.
        room, chosen = int(group["left"].iloc[0]), []
        for key, words in group.sort_values("_hash")[["_hash", "words"]].itertuples(index=False):
            if words <= room:
                chosen.append(key)
                room -= int(words)
        return pd.DataFrame({"s": group["s"].iloc[:1], "block": group["block"].iloc[:1], "sub": group["sub"].iloc[:1], "chosen": [chosen]})

    chosen = last.groupBy("s", "block", "sub").applyInPandas(fitting, "s int, block int, sub int, chosen array<bigint>")
    # One row for each source: at most MAX_BLOCKS whole sub-blocks, and the documents of one sub-block.
    within = reached.where("whole").groupBy("s", "block").agg(F.collect_list("sub").alias("whole_subs"))
    chosen = chosen.withColumnRenamed("sub", "last_sub")
    blocks = blocks.join(units, ["s", "block"], "left").select("s", "block", "left", "subs", "units")
    blocks = blocks.join(within, ["s", "block"], "left").join(chosen, ["s", "block"], "left")
    return Draws(table, blocks, shards)


def _sub(seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(4), "_hash"), F.col("subs")).cast("int")


def placed(rows: DataFrame, drawn: Draws, seed: int) -> DataFrame:
    """Measured rows with ``source_size``, ``target`` and ``units``."""
    known = located(rows, drawn.sources, seed).join(drawn.blocks, ["s", "block"], "left").withColumn("sub", _sub(seed))
    fits = (F.col("sub") == F.col("last_sub")) & F.array_contains("chosen", F.col("_hash"))
    further = F.col("left").isNull() | F.array_contains("whole_subs", F.col("sub")) | fits
    kept = F.when(further, F.col("units")).otherwise(F.expr("filter(units, u -> u.pass < passes)"))
    empty = F.expr("cast(array() AS array<struct<pass:int,shard:int>>)")
    units = F.when(F.col("_size") > 0, F.coalesce(kept, empty)).otherwise(empty)
    return known.withColumn("units", units).drop(
        "s", "block", "sub", "subs", "whole_subs", "last_sub", "chosen", "left", "passes", "rest"
    )


def mix(
    docs: DataFrame, shards: int | None = None, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and ``units`` of every row.

    ``size`` is the number of words (null text: 0), ``target`` the words that the
    row's source should give, ``taken`` the words of this row in the mix, repeats
    counted; ``units`` says which pass took it into which shard, at most three
    times. Without ``shards`` there is one for every ``SHARD_WORDS`` words. A
    source's taken words stay below its target by less than the smallest document
    left out of its last sub-block. A null source is a source, the last in order.
    Documents without words are never taken, and sources without any give nothing.
    Rows are kept as they come, repeated or with a null id; rows that share id
    and text are taken together. Further columns are not read. The same rows
    give the same mix again, however they are partitioned.
    """
    rows = cut(measured(docs, id_col, text_col, source_col))
    out = placed(rows, draw(rows, shards, seed), seed)
    taken = (F.col("_size") * F.size("units")).alias("taken")
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", taken, "units")


def mixed(
    docs: DataFrame, shards: int | None = None, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, shard by shard.

    Texts are read twice, once to count words and once to be dealt out. A shard
    lies in one partition, its rows in an order drawn by hash. Columns are
    those of ``docs``; what ``mix`` says of nulls and repeats holds.
    """
    light = cut(measured(docs, id_col, text_col, source_col))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    drawn = draw(light, shards, seed)
    full = placed(measured(docs, id_col, text_col, source_col, row), drawn, seed)
    copies = full.select("_row", "_hash", F.explode("units").alias("unit"))
    order = F.xxhash64(F.lit(seed), F.lit(6), "_hash", "unit.pass")
    dealt = copies.select("_row", "unit.shard", order.alias("_order")).repartition("shard")
    return dealt.sortWithinPartitions("shard", "_order").select("_row.*")
