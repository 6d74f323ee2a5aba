"""Many-to-many bridges and roll-ups through them."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.casting import total
from rankforge.operators.topn import best_per_key

# Bridge rows that are rolled up in one place.
PLACE_ROWS = 4096
# Periods that are summed side by side, and in 38 digits; a number there is summed as so many parts of so many digits.
SLOTS, WIDE_SLOTS = 16, 8
PARTS, PART_DIGITS = 4, 10


def build_bridge(links: DataFrame, dim: DataFrame, on: str, keys: Sequence[str],
                 order: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """Resolve ``links`` to a dimension by ``on`` and keep one row per ``keys``.

    ``links`` rows whose ``on`` is NULL are dropped before the join.
    """
    l = links.where(F.col(on).isNotNull())
    j = l.join(dim, on, "inner")
    return best_per_key(j, keys, order).select(*cols)


def places(bridge: DataFrame, rows: int = PLACE_ROWS) -> int:
    """Places for :func:`rollup_over_bridge`: one for each ``rows`` bridge rows, at least the configured number of shuffle partitions. A count, so a job."""
    return max(int(bridge.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bridge.count() // rows))


def _parts(c: Column) -> list[Column]:
    """A number of 38 digits as whole numbers of 64 bits, lowest digits first: sums of them never leave 64 bits
    below 9 * 10 ** 8 rows, and cost a fraction of a decimal's."""
    def unit(i: int) -> Column:
        return F.lit(Decimal(10) ** (PART_DIGITS * i))

    out = []
    for i in range(PARTS):
        below = c % unit(i + 1) if i + 1 < PARTS else c
        out.append((F.call_function("div", below, unit(i)) if i else below).cast("bigint"))
    return out


def _whole(rows: DataFrame, parts: Sequence[str], out: str) -> DataFrame:
    """Adds ``out``, the number that :func:`_parts` split, from the columns of its parts or of sums of them."""
    base = F.lit(10 ** PART_DIGITS)
    for low, high in zip(parts, parts[1:]):  # what a sum has beyond its digits goes to the next part
        rows = rows.withColumns({low: F.col(low) % base, high: F.col(high) + F.call_function("div", F.col(low), base)})

    def decimal(*terms: tuple[Column, int]) -> Column:
        return reduce(lambda a, b: (a + b).cast("decimal(38,0)"),
                      ((c.cast("decimal(38,0)") * F.lit(Decimal(10) ** d)).cast("decimal(38,0)") if d else c.cast("decimal(38,0)") for c, d in terms))

    # Two numbers of 64 bits hold all but the largest: decimals are added once, not once for each part.
    r0, r1, r2, r3 = (F.col(c) for c in parts)
    low, high = r0 + (r1 % 10 ** 8) * base, F.call_function("div", r1, F.lit(10 ** 8)) + r2 * 100 + r3 * 10 ** 12
    whole = decimal((high, 18), (low, 0))
    every = decimal(*((c, PART_DIGITS * i) for i, c in reversed([*enumerate((r0, r1, r2, r3))])))
    return rows.withColumn(out, F.when(r3.between(-(10 ** 6), 10 ** 6), whole).otherwise(every))


def rollup_over_bridge(bridge: DataFrame, facts: DataFrame, link_key: str,
                       group_keys: Sequence[str], measure: str, out: str | None = None,
                       hot_degree: int | None = None, wide: bool = False, partitions: int | None = None,
                       periods: DataFrame | None = None) -> DataFrame:
    """Sum a per-(link, ...) measure to (``group_keys``) through a bridge.

    ``facts`` should already be aggregated to one row per link key and
    period, so a link's facts are as many as there are periods. What the join makes is
    (bridge rows x periods), many times what it reads, so it is made where it is summed and never shuffled:
    bridge rows are dealt to places by their group keys, a link's facts travel as one packed row to each place that
    has the link (never more than its bridge rows, and never more than there are places), meet the bridge rows there in a
    window, and are unpacked and summed in the same task. A link with very many bridge rows is so spread over all places.

    Nor is it made row by row: periods are numbered in their order, and a link's facts are packed as rows of ``SLOTS`` periods
    side by side, a column each. Those are summed column by column, one look-up for all of them, and become a row for each
    period only when they are summed; which periods a sum has, a bit mask keeps.

    ``partitions`` is the number of places, by default the configured number of shuffle partitions; :func:`places` gives one that
    keeps each place's share of the result bounded, and without ``partitions``, ``hot_degree`` asks for it with so many rows. With ``partitions=0`` the placing is left to adaptive execution: the same rows, with a shuffle of them.

    ``periods`` are rows with every period of the facts (more do no harm); without them the facts are read for theirs. They are
    numbered in one task: a calendar's worth. ``wide`` sums in 38 digits instead of 64 bits.
    """
    if partitions is None and hot_degree:
        partitions = places(bridge, hot_degree)
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [c for c in group_keys if c in bridge.columns]
    others = [c for c in bridge.columns if c != link_key]
    by_period = [c for c in facts.columns if c != link_key and c != measure and c in group_keys]
    kind = facts.agg(total(measure, wide).alias("v")).schema["v"].dataType
    # A place's rows are few enough for sums of parts; without one, rows of all places meet in a sum.
    split = wide and bool(own)
    slots = WIDE_SLOTS if split else SLOTS

    # Facts by link and block of periods, a column for each period (or, wide, for each part of it).
    f = facts.where(F.col(link_key).isNotNull()).select(link_key, *by_period, F.col(measure).alias("__v"))
    if by_period:
        known = (periods if periods is not None else facts).select(*(F.col(c).alias(f"__{c}") for c in by_period)).distinct()
        one = F.struct(*(F.col(f"__{c}").alias(c) for c in by_period))  # a struct: lists leave out nulls
        number = F.row_number().over(Window.orderBy(*(f"__{c}" for c in by_period))) - 1
        block = Window.partitionBy((F.col("__n") / slots).cast("int")).orderBy("__n")
        known = (known.withColumn("__n", number)
                 .withColumn("__block", F.collect_list(one).over(block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
                 .withColumn("__slot", F.col("__n") % slots))
        if len(by_period) == 1:  # plain values are smaller
            known = known.withColumn("__block", F.col("__block")[by_period[0]])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by_period])
        f = f.join(known, same)
    else:
        slots, f = 1, f.withColumns({"__block": F.array(F.lit(0)), "__slot": F.lit(0)})
    values = _parts(F.col("__v").cast("decimal(38,0)")) if split else [F.col("__v").cast("decimal(38,0)") if wide else F.col("__v")]
    f = f.select(link_key, "__block", "__slot", *(v.alias(f"__v{i}") for i, v in enumerate(values)))
    cells = [[f"__s{s}_{i}" for i in range(len(values))] for s in range(slots)]
    packed = (f.repartition(link_key).groupBy(link_key, "__block")
              .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), "__slot")).alias("__mask"),
                   *(F.sum(F.when(F.col("__slot") == s, F.col(f"__v{i}"))).alias(c) for s, row in enumerate(cells) for i, c in enumerate(row)))
              .groupBy(link_key).agg(F.collect_list(F.struct("__block", "__mask", *(c for row in cells for c in row))).alias("__facts")))

    place = F.pmod(F.xxhash64(*(own or others)), F.lit(n)).cast("int")
    b = bridge.where(F.col(link_key).isNotNull()).withColumn("__place", place)
    sent = b.select(link_key, "__place").distinct().join(packed, link_key)
    rows = (b.withColumn("__bridge", F.lit(True))
            .unionByName(sent.withColumn("__bridge", F.lit(False)), allowMissingColumns=True))
    if partitions != 0:
        rows = rows.repartitionById(n, "__place")
    # One packed row for each link of a place: there is only one to find.
    met = rows.withColumn("__facts", F.first("__facts", ignorenulls=True).over(Window.partitionBy("__place", link_key)))
    made = met.where(F.col("__bridge") & F.col("__facts").isNotNull()).select(*own, "__place", F.inline("__facts"))
    # The place follows from the group keys, so grouping by it too changes nothing and needs no shuffle.
    by = (["__place"] if own else []) + own + ["__block"]
    summed = made.groupBy(*by).agg(F.bit_or("__mask").alias("__mask"), *(F.sum(c).alias(c) for row in cells for c in row))
    each = F.array(*(F.struct((F.col("__mask").bitwiseAND(F.lit(1 << s)) != 0).alias("__is"), F.get("__block", F.lit(s)).alias("__period"),
                              *(F.col(c).alias(f"__v{i}") for i, c in enumerate(row))) for s, row in enumerate(cells)))
    rows = summed.select(*own, F.inline(each)).where("__is")
    if split:
        rows = _whole(rows, [f"__v{i}" for i in range(PARTS)], "__v0")
    period = {c: F.col("__period")[c] if len(by_period) > 1 else F.col("__period") for c in by_period}
    return rows.select(*(period.get(c, F.col(c)).alias(c) for c in group_keys), F.col("__v0").cast(kind).alias(out or measure))
