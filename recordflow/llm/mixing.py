"""Mixing sources to target weights by a hypergeometric splitting tree.

Each source is cut into blocks of about equal size by a hash of its documents. A source's quota is a
number of block draws: as many whole rounds of its blocks as fit its target, then a part of one more
round in a permuted order. A binary tree over the output shards splits the quotas: at every node the
draws of all sources that go left are a multivariate-hypergeometric sample, so each shard is mixed
like the whole, and the quotas stay exact. Shards then take disjoint runs of each source's draws, and
a shard's documents are ordered by a hash. The last block of a source is drawn in part: whole parts of
it first, then single documents of one part, so the words taken come as near to the target as documents
allow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import WORD, staged

#: A source is never used more often than this.
MOST_USES = 3.0
#: Blocks of all sources together (each source has one at least): the size of the plan.
BLOCKS = 4_096
#: A source's blocks hold this many documents at least, so that its last block can be filled closely.
BLOCK_ROWS = 64
#: The partly drawn block is cut in parts of about so many documents, in this many parts at most.
PART_ROWS, PARTS = 256, 4_096
#: Plans of up to this many sources are sent to all tasks; larger ones are joined.
SENT_SOURCES = 10_000
WEIGHTS = (5.0, 2.0, 1.0)


@dataclass(frozen=True)
class Plan:
    """What the driver holds: a row per source and a row per drawn block."""

    sources: pd.DataFrame  # source, rank, source_size, target, blocks, rounds
    draws: pd.DataFrame  # rank, block, round, shard


def targets(sizes: Sequence[float], weights: Sequence[float], most: float = MOST_USES) -> np.ndarray:
    """Shares of all sizes by weight, none above ``most`` times its source; the excess is reshared."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    while open_.any():
        left = sizes.sum() - out[~open_].sum()
        out[open_] = left * weights[open_] / weights[open_].sum()
        over = open_ & (out > most * sizes)
        if not over.any():
            break
        out[over] = most * sizes[over]
        open_ &= ~over
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """A row per shard: how many draws of each source it takes; columns sum to the quotas."""
    if shards == 1:
        return quotas[None, :]
    total, left_shards = int(quotas.sum()), shards // 2
    # The left half gets its share of all draws; which sources they are of is drawn.
    n_left = round(total * left_shards / shards)
    left = rng.multivariate_hypergeometric(quotas, n_left, method="marginals") if total else quotas
    return np.concatenate([split_quotas(left, left_shards, rng), split_quotas(quotas - left, shards - left_shards, rng)])


def plan_mix(blocks: pd.DataFrame, sources: pd.DataFrame, shards: int, seed: int) -> tuple[Plan, pd.DataFrame]:
    """The plan, and each source's partly drawn block with the words it may still give."""
    rng = np.random.default_rng(seed)
    draws, partial = [], []
    for s in sources.itertuples():
        own = blocks[blocks["rank"] == s.rank].sort_values("block")
        left = s.target - s.rounds * s.source_size
        for r in range(int(s.rounds) + (left > 0)):
            order = own.iloc[rng.permutation(len(own))]
            if r == s.rounds:
                before = order["words"].cumsum().to_numpy()
                whole = int(np.searchsorted(before, left, side="right"))
                if whole < len(order):
                    rest = left - (before[whole - 1] if whole else 0)
                    partial.append((s.rank, int(order["block"].iloc[whole]), r, float(rest)))
                order = order.iloc[: whole + 1]
            draws.append(pd.DataFrame({"rank": s.rank, "block": order["block"].to_numpy(), "round": r}))
    drawn = pd.concat(draws, ignore_index=True) if draws else pd.DataFrame({"rank": [], "block": [], "round": []})
    drawn = drawn.astype("int64")
    quotas = np.bincount(drawn["rank"], minlength=int(sources["rank"].max()) + 1 if len(sources) else 0).astype(np.int64)
    parts = split_quotas(quotas, shards, rng)
    shard = np.zeros(len(drawn), np.int64)
    for rank in range(len(quotas)):
        shard[(drawn["rank"] == rank).to_numpy()] = np.repeat(np.arange(shards), parts[:, rank])
    drawn["shard"] = shard
    return Plan(sources, drawn), pd.DataFrame(partial, columns=["rank", "block", "round", "room"])


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one part that fit its room, in hash order; those that don't are passed over."""
    rows = rows.sort_values(["mark", "size"], ignore_index=True)
    sizes, room = rows["size"].tolist(), float(rows["room"].iloc[0])
    taken = []
    for size in sizes:
        taken.append(size <= room)
        room -= size if taken[-1] else 0
    # One more document if that ends nearer to the target than leaving it out.
    rest = [i for i, t in enumerate(taken) if not t and sizes[i] < 2 * room]
    if rest:
        taken[min(rest, key=lambda i: abs(sizes[i] - room))] = True
    return rows.loc[taken, ["rank", "mark"]]


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = 64, seed: int = 17, keep: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns of ``docs``, or those named), size, source_size, target, ``uses`` of every row.

    ``uses`` lists the draws of the document as (shard, round, place); none if it is left out. Exploded
    and ordered by shard and place, they are the mix. Sources are ranked by code point, null last, and
    weigh ``weights`` in turn. A null or wordless text has size 0; a source without words is left out.
    Rows with equal id and text are drawn together. An empty table gives none. The same rows give the
    same mix. The driver plans with a row per source, per block and per part of a source's last block.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.struct(*(keep or docs.columns)).alias("row"),
        F.col("source").cast("string").alias("source_name"),
        words_of(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text", F.lit(seed)).alias("mark"),
    )
    # Sizes are counted once for the plan; only marks and sizes are read again.
    sized = staged(
        keyed.groupBy("source_name", "mark").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")), "sizes"
    )
    per_source = (
        sized.groupBy("source_name").agg(F.sum("size").alias("source_size"), F.sum("rows").alias("rows")).toPandas()
    )
    names = per_source["source_name"].tolist()
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
    sources = per_source.iloc[order].reset_index(drop=True)
    sources["rank"] = np.arange(len(sources))
    sources["target"] = targets(sources["source_size"], [weights[i % len(weights)] for i in range(len(sources))])
    total = max(1, int(sources["source_size"].sum()))
    fair = BLOCKS * sources["source_size"].astype(float) // total
    sources["blocks"] = np.maximum(1, np.minimum(fair, sources["rows"] // BLOCK_ROWS)).astype("int64")
    sources["parts"] = np.clip(sources["rows"] // sources["blocks"] // PART_ROWS, 1, PARTS).astype("int64")
    rounds = np.floor(sources["target"] / sources["source_size"].clip(lower=1) + 1e-12)
    sources["rounds"] = np.minimum(rounds, MOST_USES).astype("int64")
    sent = F.broadcast if len(sources) <= SENT_SOURCES else (lambda x: x)

    known = sent(
        spark.createDataFrame(
            [
                (names[i], *map(int, x[:4]), float(x[4]))
                for i, x in zip(order, sources[["rank", "source_size", "blocks", "parts", "target"]].itertuples(index=False))
            ],
            "source string, rank long, source_size long, blocks long, parts long, target double",
        )
    )

    def place(rows: DataFrame) -> DataFrame:
        """With the block of each document, and the part of the block."""
        at = F.col("source_name").eqNullSafe(F.col("source"))
        return rows.join(known, at).withColumns(
            {
                "block": F.pmod(F.xxhash64("mark"), F.col("blocks")),
                "part": F.pmod(F.xxhash64("mark", F.lit(1)), F.col("parts")),
            }
        )

    placed = place(sized).select("rank", "block", "part", "mark", "size")
    words = placed.groupBy("rank", "block").agg(F.sum("size").alias("words")).toPandas()
    plan, partial = plan_mix(words, sources, shards, seed)

    # The partly drawn blocks: parts up to a number are drawn whole, one more is filled.
    rooms = sent(
        spark.createDataFrame(
            [(int(r.rank), int(r.block), float(r.room)) for r in partial.itertuples()], "rank long, block long, room double"
        )
    )
    inner = placed.join(rooms, ["rank", "block"])
    by_part = inner.groupBy("rank", "room", "part").agg(F.sum("size").alias("words")).toPandas()
    last = []
    for (rank, room), own in by_part.sort_values("part").groupby(["rank", "room"]):
        before = own["words"].cumsum().to_numpy()
        whole = int(np.searchsorted(before, room, side="right"))
        cut = int(own["part"].iloc[whole]) if whole < len(own) else PARTS
        last.append((int(rank), cut, float(room - (before[whole - 1] if whole else 0))))
    last = sent(spark.createDataFrame(last, "rank long, last long, room double"))
    filled = inner.drop("room").join(last, "rank").where(F.col("part") == F.col("last"))
    filled = filled.select("rank", "mark", "size", "room").groupBy("rank").applyInPandas(_fill, "rank long, mark long")
    filled = sent(staged(filled, "filled").select("rank", "mark", F.lit(True).alias("fits")))

    draws = plan.draws.merge(partial[["rank", "block", "round"]].assign(cut=True), how="left")
    rows = [(int(d.rank), int(d.block), int(d.round), int(d.shard), d.cut is True) for d in draws.itertuples()]
    drawn = spark.createDataFrame(rows, "rank long, block long, round long, shard long, cut boolean")
    listed = sent(
        drawn.groupBy("rank", "block").agg(
            F.collect_list(F.when(~F.col("cut"), F.struct("shard", "round"))).alias("whole"),
            F.max(F.when(F.col("cut"), F.struct("shard", "round"))).alias("some"),
        )
    )
    joined = place(keyed).join(listed, ["rank", "block"], "left").join(last.drop("room"), "rank", "left")
    joined = joined.join(filled, ["rank", "mark"], "left")
    whole = F.coalesce("whole", F.expr("cast(array() as array<struct<shard:bigint,round:bigint>>)"))
    inside = (F.col("part") < F.col("last")) | (F.col("part") == F.col("last")) & F.col("fits")
    taken = F.when(F.col("some").isNotNull() & inside, F.array_append(whole, F.col("some"))).otherwise(whole)
    uses = F.transform(
        taken, lambda d: F.struct(d["shard"].alias("shard"), d["round"].alias("round"), F.xxhash64("mark", d["round"]).alias("place"))
    )
    return joined.select("row", "size", "source_size", "target", uses.alias("uses"))


def mixed_rows(mix_rows: DataFrame) -> DataFrame:
    """The mix itself: the columns of the documents with ``shard`` and ``place``, a row per draw."""
    return mix_rows.select("row", F.inline("uses")).drop("round")
