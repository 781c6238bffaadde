"""Settling ranged rules: every key's axis cut into disjoint segments, each with its winning values.

A key's rules are swept in the order of their bounds.  The rules that are open at a point wait in one
heap per output, ordered by which wins; a rule that has closed is dropped when it reaches the top.  So n
rules take n log n steps however much they overlap.

A rule table too large for that is settled by Spark without any group per key: bounds are ranked by one
range-partitioned sort, every rule is cut into at most two blocks of a power-of-two length per power, the
best rule of each block is one aggregate, and every segment takes the best of the blocks around it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketlake.session import written

#: (rule number, low, high, outputs) and (low, high, position unknown, outputs).
Rule = tuple[int, object, object, tuple]
Segment = tuple[object, object, bool, tuple]


def winners(rules: list[Rule], width: int, last: bool) -> list[list[int | None]]:
    """For each output the rank of every rule that writes it, smaller ranks win."""
    out: list[list[int | None]] = []
    for o in range(width):
        writes = [i for i, r in enumerate(rules) if r[3][o] is not None]
        writes.sort(key=lambda i: (rules[i][0], rules[i][3][o]), reverse=last)
        ranks: list[int | None] = [None] * len(rules)
        for rank, i in enumerate(writes):
            ranks[i] = rank
        out.append(ranks)
    return out


def best_of(rules: list[Rule], width: int, last: bool) -> tuple:
    """The winning value of every output among all of some rules."""
    out = []
    for o in range(width):
        written_by = [(r[0], r[3][o]) for r in rules if r[3][o] is not None]
        out.append((max if last else min)(written_by)[1] if written_by else None)
    return tuple(out)


def sweep(rules: list[Rule], width: int, last: bool) -> list[Segment]:
    """Segments of one key in order, those without a rule left out; the one of unknown positions comes first."""
    open_ended = [r for r in rules if r[1] is None and r[2] is None]
    out: list[Segment] = [(None, None, True, best_of(open_ended, width, last))] if open_ended else []
    rules = [r for r in rules if r[1] is None or r[2] is None or r[1] < r[2]]
    ranks = winners(rules, width, last)
    points = sorted({b for r in rules for b in r[1:3] if b is not None})
    place = {p: i for i, p in enumerate(points)}
    opens: list[list[int]] = [[] for _ in range(len(points) + 1)]  # at -infinity, then at each point
    for i, r in enumerate(rules):
        opens[0 if r[1] is None else place[r[1]] + 1].append(i)
    ends = [len(points) + 1 if r[2] is None else place[r[2]] + 1 for r in rules]
    closing = [0] * (len(points) + 2)
    for end in ends:
        closing[end] += 1
    heaps: list[list[tuple[int, int]]] = [[] for _ in range(width)]
    covering = 0
    previous: Segment | None = None
    for step, starting in enumerate(opens):
        covering += len(starting) - closing[step]
        for i in starting:
            for o, heap in enumerate(heaps):
                if ranks[o][i] is not None:
                    heapq.heappush(heap, (ranks[o][i], i))
        values = []
        for o, heap in enumerate(heaps):
            while heap and ends[heap[0][1]] <= step:
                heapq.heappop(heap)
            values.append(rules[heap[0][1]][3][o] if heap else None)
        low = points[step - 1] if step else None
        high = points[step] if step < len(points) else None
        if not covering:
            previous = None
            continue
        if previous is not None and previous[3] == tuple(values):
            previous = (previous[0], high, False, previous[3])
            out[-1] = previous
        else:
            previous = (low, high, False, tuple(values))
            out.append(previous)
    return out


def settled_by_blocks(
    table: DataFrame, keys: tuple[str, ...], outputs: list[str], last: bool, lo: str = "lo", hi: str = "hi"
) -> DataFrame:
    """(keys, seg_lo, seg_hi, seg_unknown, seg_no, outputs) of a rule table of any size."""
    names = list(keys)
    pick = F.max if last else F.min

    def best(o: str) -> Column:
        """The winning rule's number and value among those that write the output."""
        return pick(F.when(F.col(o).isNotNull(), F.struct("rule_no", o))).alias(o)

    def same(a: str, b: str) -> Column:
        cond = F.lit(True)
        for k in names:
            cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return cond

    known = table
    for k in names:  # a rule without a key fits no row
        known = known.filter(F.col(k).isNotNull())
    bounds = known.select(*names, F.explode(F.array(lo, hi, F.lit(None))).alias("_v")).distinct()
    order = [*names, F.asc_nulls_first("_v")]
    ids = bounds.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ids = written(ids, "rule-bounds").withColumn("_slot", F.shiftright("_id", 33))
    before = W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)  # one row per sorted partition
    slots = ids.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    number = F.col("_skip") + F.col("_id").bitwiseAND((1 << 33) - 1)
    points = written(ids.join(F.broadcast(slots), "_slot").select(*names, "_v", number.alias("_rank")), "rule-points")
    levels = max(1, int(points.count()).bit_length())
    ends = points.groupBy(*names).agg((F.max("_rank") + 1).alias("_end"))

    low = points.select(*names, F.col("_v").alias("_low_v"), F.col("_rank").alias("_l"))
    high = points.select(*names, F.col("_v").alias("_high_v"), F.col("_rank").alias("_r"))
    placed = (
        known.alias("t")
        .join(low.alias("_a"), same("t", "_a") & F.col(f"t.{lo}").eqNullSafe(F.col("_low_v")))
        .join(high.alias("_b"), same("t", "_b") & F.col(f"t.{hi}").eqNullSafe(F.col("_high_v")))
        .join(ends.alias("e"), same("t", "e"))
        .select("t.rule_no", *[f"t.{o}" for o in outputs], "_l", F.when(F.col(f"t.{hi}").isNull(), F.col("_end")).otherwise(F.col("_r")).alias("_r"))
    )
    # The blocks of [l, r): at each power, an odd first and an odd end block that are not part of a larger one.
    steps = placed.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    steps = steps.withColumns({"_a": F.expr("shiftright(_l + shiftleft(1L, _level) - 1, _level)"), "_b": F.expr("shiftright(_r, _level)")})
    first = F.when((F.col("_a") < F.col("_b")) & (F.col("_a") % 2 == 1), F.col("_a"))
    final = F.when((F.col("_a") < F.col("_b")) & (F.col("_b") % 2 == 1), F.col("_b") - 1)
    blocks = steps.withColumn("_block", F.explode(F.array_compact(F.array(first, final))))
    in_block = blocks.groupBy("_level", "_block").agg(*[best(o) for o in outputs])
    around = points.select("_rank", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")).withColumn(
        "_block", F.expr("shiftright(_rank, _level)")
    )
    chosen = around.join(in_block, ["_level", "_block"]).groupBy("_rank").agg(*[pick(o).alias(o) for o in outputs])
    after = points.select((F.col("_rank") - 1).alias("_rank"), *[F.col(k).alias(f"_x_{k}") for k in names], F.col("_v").alias("_next"))
    still = F.lit(True)
    for k in names:
        still = still & F.col(k).eqNullSafe(F.col(f"_x_{k}"))
    segments = (
        points.join(chosen, "_rank")
        .join(after, "_rank", "left")
        .select(
            *names, F.col("_v").alias("seg_lo"), F.when(still, F.col("_next")).alias("seg_hi"),
            F.lit(False).alias("seg_unknown"), F.col("_rank").alias("seg_no"), *[F.col(f"{o}.{o}").alias(o) for o in outputs],
        )
    )
    unknown = (
        known.filter(F.col(lo).isNull() & F.col(hi).isNull())
        .groupBy(*names)
        .agg(*[best(o) for o in outputs])
        .select(
            *names, F.lit(None).cast(table.schema[lo].dataType).alias("seg_lo"), F.lit(None).cast(table.schema[hi].dataType).alias("seg_hi"),
            F.lit(True).alias("seg_unknown"), F.lit(-1).cast("bigint").alias("seg_no"), *[F.col(f"{o}.{o}").alias(o) for o in outputs],
        )
    )
    return segments.unionByName(unknown)
