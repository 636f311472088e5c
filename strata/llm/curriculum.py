"""Mixing sources to target weights along a time-varying curriculum (operator 11).

Every source has a base weight and a schedule: a piecewise linear rate over training
time 0..1. The targets come from the base weights (``targets``). A source's rate,
integrated from 0, is its cumulative demand; the documents of a source stand one after
another in the order of a hash, and the words before a document, put through the
inverse of that integral, give the time at which the document is trained on. A source
with a target above its size is gone through again, up to ``Plan.most`` times.

All of it is DataFrame expressions. The words before a document are sums of three
levels (source, range of hashes, rows of a range), so that a source with a third of
all rows is many small windows. The texts are read once and never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

#: a run of these characters is a word
WORD = r"[^\x20\x09-\x0D]+"
#: documents of a range of hashes, about; and the most hex digits that one level adds
RANGE_ROWS, LEVEL_DIGITS = 512, 3
BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Plan:
    """``share``: words of the mix over words of all documents, as a fraction. ``weights``
    and ``schedules`` go to the sources in code point order (null last), repeating. A
    schedule is a list of (time, rate) knots from time 0 to 1, with rates above 0.
    ``most``: how often a document may be taken."""

    share: tuple[int, int] = (3, 2)
    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 2
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.0), (0.5, 1.0), (1.0, 0.5)),
        ((0.0, 0.5), (1.0, 1.5)),
        ((0.0, 0.25), (0.75, 0.5), (1.0, 2.0)),
    )

    def __post_init__(self):
        for knots in self.schedules:
            times = [t for t, _ in knots]
            if times[0] != 0 or times[-1] != 1 or times != sorted(set(times)) or min(r for _, r in knots) <= 0:
                raise ValueError(f"a schedule goes from time 0 to 1 with rates above 0: {knots}")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, plan: Plan) -> DataFrame:
    """(source, source_size) with rank, weight, target and demand (the target's whole words).

    A target stops at ``most`` times the source's size; what is over goes to the other
    sources by weight until none is above. In closed form: by size over weight, the
    sources that stop are the first ones, up to the first that has room for its part.
    Integers all through, one division at the end. One row a source: the only window
    over all of them.
    """
    p, q = plan.share
    m, k = plan.most, len(plan.weights)
    lcm = math.lcm(*plan.weights)
    named = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("rank") % len(values) + 1).cast("int"))
    named = named.withColumn("weight", pick(plan.weights)).withColumn("schedule", F.col("rank") % len(plan.schedules))
    size, weight = F.col("source_size").cast(BIG), F.col("weight").cast("decimal(10,0)")
    by_fill = Window.orderBy((F.col("source_size") * (F.lit(lcm) / F.col("weight")).cast("long").cast("decimal(10,0)")), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sums = named.select(
        "*",
        F.sum(F.col("source_size")).over(everything).cast("decimal(24,0)").alias("all"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast("decimal(24,0)").alias("full"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("used"),
        F.row_number().over(by_fill).alias("place"),
    )
    left = (F.col("all") * p - F.col("full") * (q * m)).cast("decimal(27,0)")
    rest = ((F.col("weights") - F.col("used")) * q).cast("decimal(10,0)")
    above = left * weight > F.col("source_size").cast("decimal(20,0)") * m * rest
    level = F.min(F.when(~above, F.struct("place", left.alias("left"), rest.alias("rest")))).over(everything)
    found = sums.withColumn("level", level)
    stops = F.col("level").isNull() | (F.col("place") < F.col("level.place"))
    share = (F.col("level.left") * weight).cast("decimal(38,0)")
    return found.select(
        "source", "source_size", "rank", "weight", "schedule",
        F.when(stops, (size * m).cast("double")).otherwise(share.cast("double") / F.col("level.rest").cast("double")).alias("target"),
        F.when(stops, (size * m).cast("long")).otherwise(F.call_function("div", share, F.col("level.rest"))).alias("demand"),
    )


def moment(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Time at which the integral of the schedule reaches ``share`` (0 to 1) of its whole."""
    areas = [(b[1] + a[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:])]
    whole = sum(areas)
    out, upto = None, whole
    for (t0, r0), (t1, r1), area in reversed([(a, b, s) for (a, b), s in zip(zip(knots, knots[1:]), areas)]):
        upto -= area
        slope = (r1 - r0) / (t1 - t0)
        more = F.greatest(share * F.lit(whole) - F.lit(upto), F.lit(0.0))
        at = F.least(F.lit(t0) + F.lit(2.0) * more / (F.lit(r0) + F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * more, F.lit(0.0)))), F.lit(t1))
        out = at if out is None else F.when(share * F.lit(whole) >= F.lit(upto + area), out).otherwise(at)
    return out


def digits_for(rows: int) -> int:
    """Hex digits of a hash that cut ``rows`` documents into ranges of about RANGE_ROWS."""
    return max(1, math.ceil(math.log(max(rows, 1) / RANGE_ROWS, 16))) if rows > RANGE_ROWS else 1


def mix(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: (id, source, size, source_size, target, taken, position, positions).

    ``taken``: words that the mix takes from it, repeats counted; a source's first
    documents in hash order are taken once more than its last ones, and one document a
    source is cut where the demand ends, so a source's words sum to the whole part of its
    target. ``positions``: training times (0 to 1) at which the document is begun, one a
    time taken; ``position`` is the first, null if it is not taken. Null texts and texts
    without a word have size 0 and are not taken; a null source is a source of its own,
    after all others. Rows equal in id, text and source follow each other. Other
    columns are not read, so their names do not matter. An empty table gives an empty
    table. The order is a hash of id and text, so reruns agree.
    """
    text = docs[text_col]
    order = F.md5(F.concat(F.coalesce(docs[id_col].cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))
    slim = docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), n_words(text).alias("size"), order.alias("order"))
    rows = written(slim.groupBy("id", "source", "size", "order").agg(F.count(F.lit(1)).alias("copies")), "mix-rows")
    rows = rows.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))  # not null, for joins
    fine = digits_for(rows.count())
    coarse = min(fine, LEVEL_DIGITS)
    words = F.col("size") * F.col("copies")

    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("name", "source", F.substring("order", 1, fine).alias("range")).agg(F.sum(words).alias("words"))
    ranges = written(ranges.withColumn("level", F.substring("range", 1, coarse)), "mix-ranges")
    levels = ranges.groupBy("name", "source", "level").agg(F.sum("words").alias("level_words"))
    levels = levels.withColumn("level_start", F.coalesce(F.sum("level_words").over(before(Window.partitionBy("name").orderBy("level"))), F.lit(0)))
    wanted = targets(levels.groupBy("name", "source").agg(F.sum("level_words").alias("source_size")).select("source", "source_size"), plan)
    wanted = wanted.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).drop("source")
    levels = levels.join(wanted, "name").drop("source", "level_words")
    within = before(Window.partitionBy("name", "level").orderBy("range"))
    starts = ranges.drop("source").withColumn("range_start", F.coalesce(F.sum("words").over(within), F.lit(0))).join(levels, ["name", "level"])
    starts = starts.withColumn("range_start", F.col("level_start") + F.col("range_start")).drop("level_start", "level", "words")

    placed = rows.withColumn("range", F.substring("order", 1, fine))
    row_order = Window.partitionBy("name", "range").orderBy("order", F.col("id").asc_nulls_last(), "size")
    placed = placed.withColumn("row_start", F.coalesce(F.sum(words).over(before(row_order)), F.lit(0))).join(starts, ["name", "range"])
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    start = F.col("range_start") + F.col("row_start") + F.col("copy") * F.col("size")
    size, whole, demand = F.col("size"), F.col("source_size"), F.col("demand")
    per_pass = F.greatest(whole, F.lit(1).cast("long"))
    rounds = F.call_function("div", demand, per_pass)
    taken = rounds * size + F.least(F.greatest(demand - rounds * whole - start, F.lit(0).cast("long")), size)
    placed = placed.withColumn("start", start).withColumn("taken", taken)
    passes = F.when(F.col("taken") > 0, F.call_function("div", demand - F.col("start") - 1, per_pass) + 1).otherwise(F.lit(0).cast("long"))

    def at(j: Column) -> Column:
        share = (j * whole + F.col("start")).cast("double") / F.greatest(demand, F.lit(1).cast("long")).cast("double")
        out = moment(share, plan.schedules[0])
        for s, knots in enumerate(plan.schedules[1:], 1):
            out = F.when(F.col("schedule") == s, moment(share, knots)).otherwise(out)
        return out

    passed = F.when(passes > 0, F.sequence(F.lit(0).cast("long"), passes - 1)).otherwise(F.array().cast("array<bigint>"))
    placed = placed.withColumn("positions", F.transform(passed, at))
    return placed.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("position"), "positions", "order",
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """Documents as trained on: a row each time one is begun, range-sorted by position."""
    out = mixed.select("*", F.posexplode("positions").alias("round", "at")).withColumn("position", F.col("at"))
    return out.drop("positions", "at").orderBy("position", "order", "round").drop("order")


def by_first_position(mixed: DataFrame) -> DataFrame:
    """One row a document, range-sorted by its first position; those not taken stand last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), "order").drop("order", "positions")
