"""Rule tables: messy label to canonical values.

A rule row has a number, key columns, an optional half-open range ``[lo, hi)`` whose NULL bounds are
open, and output columns.  An output left NULL means "this rule does not write it", so an earlier
rule's value stays.

Conflicts between rules are resolved on the rule table, where each key's axis is cut into disjoint
segments: literal rules in Python when the set is built, tables by Spark.  The fact side then needs left
joins that can match at most once: no row is added or lost, and nothing is grouped on the fact side.  A
few literal rules without a range need no join; many segments of one key are found through pages, so a
row compares itself with a few of them only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions.nulls import ColumnOrName, as_col
from ticketlake.session import written

from . import segments
from .lookup import MAX_BROADCAST_ROWS, small_side

_LO, _HI = "lo", "hi"
_SEGMENT = ("seg_lo", "seg_hi", "seg_unknown", "seg_no")
#: Segments that a row compares itself with at each step of a lookup.
PAGE = 64
#: Literal rows that become a map in the plan.
INLINE = 48
#: Unknown labels whose counts travel as metrics; beyond them they are counted in the written rows.
TRACKED = 1000
# How the texts of literal bounds sort.
_READ = {"double": float, "timestamp_ntz": dt.datetime.fromisoformat, "int": int, "bigint": int}


def _literal(text: str) -> str:
    """A text in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _table(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """Literal rows given as text, cast once; bounded by the code that wrote them: one partition."""
    data = list(zip(*rows, strict=True)) if rows else [[] for _ in columns]
    arrow = pa.table({n: pa.array(c, pa.string()) for n, c in zip(columns, data, strict=True)})
    raw = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    return spark.createDataFrame(arrow, raw).select([F.col(n).cast(t).alias(n) for n, t in columns.items()]).coalesce(1)


@dataclass(frozen=True)
class RuleSet:
    """A named rule table.

    ``outputs`` maps each output column to the value used when no rule matches.  ``conflict`` is
    ``last`` (a later rule overwrites) or ``first`` (the first rule is kept).
    """

    name: str
    table: DataFrame
    keys: tuple[str, ...]
    outputs: dict[str, object]
    ranged: bool = False
    conflict: str = "last"
    rows: int | None = field(default=None)
    #: Settled literal rows: (keys, [segment,] outputs) as text, and the column types.
    settled: tuple[dict[str, str], list[tuple]] | None = field(default=None)

    @classmethod
    def of(
        cls,
        spark: SparkSession,
        name: str,
        rules: list[tuple],
        keys: dict[str, str],
        outputs: dict[str, tuple[str, object]],
        range_type: str | None = None,
        conflict: str = "last",
    ) -> "RuleSet":
        """Build from literal rows ``(keys..., [lo, hi,] outputs...)`` in writing order."""
        columns = {"rule_no": "int", **keys}
        if range_type:
            columns.update({_LO: range_type, _HI: range_type})
        columns.update({n: t for n, (t, _) in outputs.items()})
        texts = [tuple(None if v is None else str(v) for v in (i, *row)) for i, row in enumerate(rules)]
        return cls(
            name,
            _table(spark, columns, texts),
            tuple(keys),
            {n: default for n, (_, default) in outputs.items()},
            range_type is not None,
            conflict,
            len(rules),
            _settle(texts, keys, {n: t for n, (t, _) in outputs.items()}, range_type, conflict == "last"),
        )

    @cached_property
    def _bound(self) -> int:
        if self.rows is not None:
            return self.rows
        return self.table.limit(MAX_BROADCAST_ROWS + 1).count()

    @property
    def _last(self) -> bool:
        return self.conflict == "last"

    def _winner(self, out: str) -> Column:
        best = F.max if self._last else F.min
        return best(F.when(F.col(out).isNotNull(), F.struct("rule_no", out)))[out].alias(out)

    @cached_property
    def resolved(self) -> DataFrame:
        """One row per key, or per key and segment, with conflicts settled."""
        if self.settled is not None:
            return _table(self.table.sparkSession, *self.settled)
        if not self.ranged:
            return self.table.groupBy(*self.keys).agg(*[self._winner(o) for o in self.outputs])
        if self._bound > MAX_BROADCAST_ROWS:
            found = segments.settled_by_blocks(self.table, self.keys, list(self.outputs), self._last)
        else:
            found = self._swept()
        return written(found, f"rules-{self.name}")

    def _swept(self) -> DataFrame:
        """Each key's rules swept in one task; the whole table has a bounded number of rows."""
        keys, outputs, last = list(self.keys), list(self.outputs), self._last
        kinds = {f.name: f.dataType for f in self.table.schema.fields}
        schema = T.StructType(
            [T.StructField(k, kinds[k]) for k in keys]
            + [T.StructField("seg_lo", kinds[_LO]), T.StructField("seg_hi", kinds[_HI])]
            + [T.StructField("seg_unknown", T.BooleanType()), T.StructField("seg_no", T.LongType())]
            + [T.StructField(o, kinds[o]) for o in outputs]
        )

        def run(rules: pa.Table) -> pa.Table:
            columns = {n: rules[n].to_pylist() for n in rules.column_names}
            given = list(zip(columns["rule_no"], columns[_LO], columns[_HI], zip(*[columns[o] for o in outputs], strict=True), strict=True))
            found = segments.sweep(given, len(outputs), last)
            out = {k: [columns[k][0]] * len(found) for k in keys}
            out |= {name: [s[i] for s in found] for i, name in enumerate(("seg_lo", "seg_hi", "seg_unknown"))}
            out["seg_no"] = [-1 if s[2] else i for i, s in enumerate(found)]
            out |= {o: [s[3][i] for s in found] for i, o in enumerate(outputs)}
            types = {n: rules.schema.field(n).type for n in [*keys, *outputs]}
            types |= {"seg_lo": rules.schema.field(_LO).type, "seg_hi": rules.schema.field(_HI).type}
            types |= {"seg_unknown": pa.bool_(), "seg_no": pa.int64()}
            return pa.table({n: pa.array(c, types[n]) for n, c in out.items()})

        return self.table.groupBy(*keys).applyInArrow(run, schema)

    @cached_property
    def _pages(self) -> list[DataFrame]:
        """The segments, and above them pages of ``PAGE`` segments each, until a key has few enough at the top."""
        if self.settled is not None:
            sizes: dict[tuple, int] = {}
            for row in self.settled[1]:
                name = row[: len(self.keys)]
                sizes[name] = sizes.get(name, 0) + 1
            most = max(sizes.values(), default=0)
        else:
            most = self.resolved.groupBy(*self.keys).count().agg(F.max("count")).first()[0] or 0
        levels = [self.resolved]
        size = 1
        while most > PAGE:
            size, most = size * PAGE, -(-most // PAGE)
            page = F.floor(F.col("seg_no") / F.lit(size)).cast("bigint")
            levels.append(
                self.resolved.groupBy(*self.keys, "seg_unknown", page.alias("seg_page")).agg(
                    F.min_by("seg_lo", "seg_no").alias("seg_lo"), F.max_by("seg_hi", "seg_no").alias("seg_hi")
                )
            )
        return levels

    def _condition(self, on: dict[str, ColumnOrName], at: ColumnOrName | None) -> Column:
        cond = None
        for key in self.keys:
            term = as_col(on[key]) == F.col(f"_r_{key}")
            cond = term if cond is None else cond & term
        if self.ranged:
            pos = as_col(at)
            inside = (F.col("_r_seg_lo").isNull() | (pos >= F.col("_r_seg_lo"))) & (
                F.col("_r_seg_hi").isNull() | (pos < F.col("_r_seg_hi"))
            )
            cond = cond & F.when(F.col("_r_seg_unknown"), pos.isNull()).otherwise(pos.isNotNull() & inside)
        return cond

    def _matched(
        self, df: DataFrame, on: dict[str, ColumnOrName], at: ColumnOrName | None, how: str
    ) -> DataFrame:
        """Facts with the one settled row that fits, its columns named ``_r_...``."""
        levels = self._pages if self.ranged else [self.resolved]
        # n rules have at most 2 n cut points, hence as many segments, plus one unknown row per key.
        bound = 3 * self._bound if self.ranged else self._bound
        cond = self._condition(on, at)
        for level in range(len(levels) - 1, -1, -1):
            dim = levels[level]
            here = cond
            if level < len(levels) - 1:
                up = F.lit(PAGE ** (level + 1))
                above = F.col("seg_no") if level == 0 else F.col("seg_page") * F.lit(PAGE**level)
                dim = dim.withColumn("above", F.floor(above / up).cast("bigint"))
                here = (F.col("_page") == F.col("_r_above")) & cond
            dim = dim.withColumnsRenamed({c: f"_r_{c}" for c in dim.columns})
            if level == 0:
                df = df.join(small_side(dim, bound), here, how)
            else:
                kept = [F.col(f"`{c}`") for c in df.columns if c != "_page"]
                df = df.join(small_side(dim, bound), here, "left").select(*kept, F.col("_r_seg_page").alias("_page"))
        return df.drop("_page")

    @cached_property
    def _inline(self) -> dict[str, str] | None:
        """Map expressions of a few literal rows with text keys: one per output, and ``""`` for the keys."""
        if self.settled is None or self.ranged or not 0 < len(self.settled[1]) <= INLINE:
            return None
        columns, rows = self.settled
        if any(columns[k] != "string" for k in self.keys):
            return None
        n = len(self.keys)
        names = [_literal("\u0001".join(row[:n])) for row in rows]
        maps = {"": "map(" + ", ".join(f"{k}, true" for k in names) + ")"}
        for i, out in enumerate(self.outputs):
            values = ["null" if row[n + i] is None else _literal(row[n + i]) for row in rows]
            pairs = ", ".join(f"{k}, cast({v} as {columns[out]})" for k, v in zip(names, values, strict=True))
            maps[out] = f"map({pairs})"
        return maps

    def _hits(
        self, df: DataFrame, on: dict[str, ColumnOrName], at: ColumnOrName | None
    ) -> tuple[DataFrame, dict[str, Column], Column]:
        """Facts, the found value of each output, and whether a rule was found."""
        if self._inline is None:
            joined = self._matched(df, on, at, "left")
            return joined, {o: F.col(f"_r_{o}") for o in self.outputs}, F.col(f"_r_{self.keys[0]}").isNotNull()
        key = F.concat_ws("\u0001", *[as_col(on[k]).cast("string") for k in self.keys])
        for k in self.keys:
            key = F.when(as_col(on[k]).isNotNull(), key)
        values = {o: F.try_element_at(F.expr(self._inline[o]), key) for o in self.outputs}
        return df, values, F.try_element_at(F.expr(self._inline[""]), key).isNotNull()

    def apply(
        self,
        df: DataFrame,
        on: dict[str, ColumnOrName],
        at: ColumnOrName | None = None,
        into: dict[str, str] | None = None,
    ) -> DataFrame:
        """Add the output columns (renamed through ``into``); unmatched rows get the defaults."""
        into = into or {o: o for o in self.outputs}
        joined, hits, _ = self._hits(df, on, at)
        values = {}
        for out, default in self.outputs.items():
            hit = hits[out]
            if default is not None:
                default = default if isinstance(default, Column) else F.lit(default)
                hit = F.coalesce(hit, default)
            values[into[out]] = hit
        return joined.withColumns(values).drop(*[c for c in joined.columns if c.startswith("_r_")])

    def observed(
        self,
        df: DataFrame,
        on: dict[str, ColumnOrName],
        at: ColumnOrName | None = None,
        into: dict[str, str] | None = None,
        metrics: str | Observation = "audit",
    ) -> DataFrame:
        """Like :meth:`apply`, and counts on the way: ``rows``, ``unknown`` ones, and the commonest ``labels``.

        ``labels`` counts unknown labels, and known rows under no label; ``_r_unknown`` is a row's unknown label.
        A name is for streams, whose listeners get the metrics of every batch; an observation is for one action.
        """
        into = into or {o: o for o in self.outputs}
        label = F.concat_ws(" | ", *[as_col(on[k]).cast("string") for k in self.keys])
        known = F.lit(True)
        for k in self.keys:
            known = known & as_col(on[k]).isNotNull()
        joined, hits, found = self._hits(df, on, at)
        values = {into[o]: hits[o] if d is None else F.coalesce(hits[o], d if isinstance(d, Column) else F.lit(d)) for o, d in self.outputs.items()}
        marked = joined.withColumns({"_r_unknown": F.when(known & ~found, label), **values})
        counted = marked.observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            F.count("_r_unknown").alias("unknown"),
            F.expr(f"approx_top_k(_r_unknown, {TRACKED}, {10 * TRACKED})").alias("labels"),
        )
        return counted.drop(*[c for c in marked.columns if c.startswith("_r_") and c != "_r_unknown"])

    def audited(
        self,
        df: DataFrame,
        on: dict[str, ColumnOrName],
        at: ColumnOrName | None = None,
        into: dict[str, str] | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        """The facts with their outputs, written once, and the audit of their unknown labels from the same pass.

        Up to ``TRACKED`` different labels are counted by the pass itself; if there are more, the written
        rows are counted.
        """
        watch = Observation()
        rows = written(self.observed(df, on, at, into, watch), f"audited-{self.name}")
        seen = watch.get["labels"] or []
        if len(seen) < TRACKED:
            counted = [(self.name, r["item"], r["count"]) for r in seen if r["item"] is not None]
            audit = _table(df.sparkSession, {"ruleset": "string", "label": "string", "rows": "bigint"}, [tuple(map(str, r)) for r in counted])
        else:
            audit = (
                rows.filter("_r_unknown is not null")
                .groupBy(F.col("_r_unknown").alias("label"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(self.name).alias("ruleset"), "label", "rows")
            )
        return rows.drop("_r_unknown"), audit

    def audit(
        self, df: DataFrame, on: dict[str, ColumnOrName], at: ColumnOrName | None = None
    ) -> DataFrame:
        """Labels that no rule covers, with their row counts."""
        label = F.concat_ws(" | ", *[as_col(on[k]).cast("string") for k in self.keys])
        known = None
        for k in self.keys:
            term = as_col(on[k]).isNotNull()
            known = term if known is None else known & term
        return (
            self._matched(df.filter(known), on, at, "left_anti")
            .groupBy(label.alias("label"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(self.name).alias("ruleset"), "label", "rows")
        )

    def duplicates(self) -> DataFrame:
        """Keys that more than one rule writes with different values (unranged tables only)."""
        outs = F.struct(*[F.col(o) for o in self.outputs])
        return (
            self.table.groupBy(*self.keys)
            .agg(F.countDistinct(outs).alias("variants"))
            .filter("variants > 1")
        )


def _settle(
    texts: list[tuple], keys: dict[str, str], outputs: dict[str, str], range_type: str | None, last: bool
) -> tuple[dict[str, str], list[tuple]] | None:
    """Literal rules settled in Python: column types and rows as text; None if their bounds cannot be read here."""
    if range_type is not None and range_type not in _READ:
        return None
    n, width = len(keys), len(outputs)
    by_key: dict[tuple, list[segments.Rule]] = {}
    for row in texts:
        name = row[1 : n + 1]
        if None in name:
            continue  # fits no row
        lo, hi = row[n + 1 : n + 3] if range_type else (None, None)
        read = _READ.get(range_type)
        by_key.setdefault(name, []).append(
            (int(row[0]), None if lo is None else read(lo), None if hi is None else read(hi), row[len(row) - width :])
        )
    if range_type is None:
        return {**keys, **outputs}, [(*name, *segments.best_of(rules, width, last)) for name, rules in by_key.items()]
    columns = {**keys, "seg_lo": range_type, "seg_hi": range_type, "seg_unknown": "boolean", "seg_no": "bigint", **outputs}
    rows = []
    for name, rules in by_key.items():
        for i, (lo, hi, unknown, values) in enumerate(segments.sweep(rules, width, last)):
            bounds = [None if v is None else str(v) for v in (lo, hi)]
            rows.append((*name, *bounds, str(unknown).lower(), str(-1 if unknown else i), *values))
    return columns, rows
