"""Mixing sources to target weights, by pivotal dependent rounding.

Every document of a source is wanted ``target / source_size`` times. The whole part is certain; the
fraction is settled in pairs: mass (words times probability) moves at random from one document of a
pair to the other until one of the two is certain, so the source's total and every expectation are
kept. Documents of a source are settled in blocks of bounded size, each leaving at most one fraction;
those residuals are combined by a tree of the same step, ``FAN_IN`` at a time, down to one per source,
which is drawn. A source's words therefore miss its target by less than one document.

Targets: sources in code-point order, null last, take the weights in turn. The total is shared by
weight, no source above ``limit`` times its size; the excess is shared again until none is above.

Everything is a DataFrame expression. Randomness is a hash of the row, so reruns agree.
Nulls: a null text has size 0 and takes 0; a null id or source is a value of its own. Repeated rows
(equal id, source and size) are settled as one unit and their copies dealt evenly. An empty table
gives an empty result; other columns are ignored. Small jobs run when called."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstone.llm.common import WORD, written

WEIGHTS, LIMIT = (5.0, 2.0, 1.0), 3.0
BLOCK, FAN_IN = 128, 64
_NEAR = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """(source, source_size) with weight and target."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")))
    cap = F.lit(float(limit)) * F.col("source_size")
    by_ratio = Window.orderBy(cap / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = weighted.withColumn("__level", level)
    held = F.max(F.when(F.col("__level") <= cap / F.col("weight"), F.col("__level"))).over(everything)
    return leveled.select("source", "source_size", "weight", F.least(cap, F.coalesce(held * F.col("weight"), cap)).alias("target"))


def _uniform(seed: Column) -> Column:
    return F.shiftrightunsigned(seed, 11) * F.lit(2.0**-53)


def _settle(units: Column) -> Column:
    """Pairs the units of an array in turn. Gives those settled, and the one left over."""
    first = F.element_at(units, 1)

    def pair(state: Column, other: Column) -> Column:
        one = state["left"]
        x, y = one["size"] * one["p"], other["size"] * other["p"]
        gain, give = F.least(one["size"] - x, y), F.least(x, other["size"] - y)
        moved = F.struct(gain.alias("gain"), give.alias("give"), F.xxhash64(one["h"], other["h"]).alias("h"))

        def move(m: Column) -> Column:
            up = _uniform(m["h"]) * (m["gain"] + m["give"]) < m["give"]
            mass = F.when(up, m["gain"]).otherwise(-m["give"])
            # Whichever bound was met makes that unit certain; the other carries the rest.
            one_settled = F.when(up, m["gain"] < y).otherwise(m["give"] < other["size"] - y) | (F.when(up, one["size"] - x <= y).otherwise(x <= other["size"] - y))
            settled = F.when(one_settled, one.withField("p", F.when(up, F.lit(1.0)).otherwise(F.lit(0.0)))).otherwise(other.withField("p", F.when(up, F.lit(0.0)).otherwise(F.lit(1.0))))
            left = F.when(one_settled, other.withField("p", _part((y - mass) / other["size"]))).otherwise(one.withField("p", _part((x + mass) / one["size"])))
            return F.struct(F.concat(state["settled"], F.array(settled)).alias("settled"), left.alias("left"))

        return let(moved, move)

    empty = F.filter(units, lambda u: F.lit(False))
    return F.aggregate(F.slice(units, 2, F.size(units)), F.struct(empty.alias("settled"), first.alias("left")), pair)


def _part(p: Column) -> Column:
    return F.when(p < _NEAR, 0.0).when(p > 1 - _NEAR, 1.0).otherwise(p)


def mix_sources(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, limit: float = LIMIT, seed: int = 0) -> DataFrame:
    """Per row ``key``, size, source_size, target, taken, copies, source and turn, which
    numbers rows that agree in id, source and size."""
    sized = documents.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"))
    units = written(sized.groupBy("key", "source", "size").agg(F.count("*").alias("rows")), "mix_units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("__units"))
    plan = written(targets(sizes.drop("__units"), weights, limit).join(sizes.select(F.col("source").alias("__s"), "__units"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s"), "mix_targets")

    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(0.0)
    wanted = F.col("rows") * rate
    whole = F.floor(wanted + _NEAR)
    planned = (
        units.join(plan.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
        .withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(F.round(wanted)).cast("long"))
        .withColumn("p", F.when(F.col("size") > 0, F.greatest(_part(wanted - whole), F.lit(0.0))).otherwise(0.0))
        .withColumn("h", F.xxhash64("key", "source", "size", F.lit(seed)))
    )
    fields = ("h", "key", "size", "rows", "whole", "p")
    certain = planned.where("p = 0 or p = 1")
    parts = F.ceil(F.col("__units") / BLOCK)
    open_units = planned.where("p > 0 and p < 1").withColumn("node", F.pmod(F.xxhash64("h", F.lit("block")), parts))
    most = plan.agg(F.max(parts)).first()[0] or 1
    keep = ("source", *fields)
    done = [certain.select(*keep)]
    while True:
        # Largest first, so that what is left over tends to be small; equal ones in the order of a hash.
        ordered = F.struct((-F.col("size")).alias("order"), *fields)
        tree = written(open_units.groupBy("source", "node").agg(F.sort_array(F.collect_list(ordered)).alias("units"))
                       .select("source", "node", _settle(F.col("units")).alias("out")), "mix_level")
        done.append(tree.select("source", F.inline("out.settled")).drop("order"))
        left = tree.select("source", "node", "out.left.*").drop("order")
        if most <= 1:
            drawn = F.when(_uniform(F.xxhash64("h", F.lit("draw"))) < F.col("p"), 1.0).otherwise(0.0)
            done.append(left.withColumn("p", drawn).select(*keep))
            break
        most = -(-most // FAN_IN)
        open_units = left.withColumn("node", F.floor(F.col("node") / FAN_IN))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    total = F.col("whole") + F.col("p").cast("long")
    # Equal rows share their unit's copies as evenly as whole numbers allow.
    dealt = rounded.withColumn("__total", total).withColumn("__turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.floor(F.col("__total") / F.col("rows")) + (F.col("__turn") <= F.col("__total") % F.col("rows")).cast("long")
    return (
        dealt.withColumn("copies", copies).withColumnRenamed("source", "__from")
        .join(plan.select("source", "source_size", "target"), F.col("__from").eqNullSafe(F.col("source")))
        .select(F.col("key").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source", F.col("__turn").alias("turn"))
    )
