"""Ordered scans over groups of any size.

Running totals, row numbers, previous rows and first-N cut-offs all depend on the order of rows. A plain
window sends a whole group to one task, which fails when one group holds a large part of a big table.

``order_rows`` samples the (group, order) keys and picks cut points, so that every slice between two cut
points holds about ``rows_per_slice`` rows. A group that no cut point falls into stays whole; a large group
is cut into many slices. Windows then run inside (group, slice). What a slice needs from the slices before
it is one small row per (cut group, slice): at most two rows per cut point, so it is broadcast.

Cut points only decide where the work is cut. Any choice gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.staging import stage

SLICE = "_slice"
ROWS_PER_SLICE = 1_000_000
MAX_SLICES = 4_096
SAMPLES_PER_SLICE = 20


# --------------------------------------------------------------------------- what a scan computes


@dataclass(frozen=True)
class Scan:
    """One scanned column: ``how`` it accumulates, over ``value``, with or without the current row."""

    how: str
    value: Column
    inclusive: bool = True
    start: int = 0

    def local(self, rows: Window) -> Column:
        upto = rows.rowsBetween(Window.unboundedPreceding, 0 if self.inclusive else -1)
        if self.how == "sum":
            return F.coalesce(F.sum(self.value).over(upto), F.lit(0))
        if self.how == "number":
            return F.row_number().over(rows).cast("bigint")
        if self.how == "previous":
            return F.lag(F.struct(self.value.alias("v"))).over(rows)
        if self.how == "following":
            return F.lead(F.struct(self.value.alias("v"))).over(rows)
        if self.how == "latest":
            return F.last(self.value, ignorenulls=True).over(upto)
        return {"min": F.min, "max": F.max, "any": F.max}[self.how](self.value).over(upto)

    def summary(self, order: Column) -> Column:
        """What one slice passes on."""
        if self.how == "sum":
            return F.coalesce(F.sum(self.value), F.lit(0))
        if self.how == "number":
            return F.count(F.lit(1))
        if self.how == "previous":
            return F.max_by(F.struct(self.value.alias("v")), order)
        if self.how == "following":
            return F.min_by(F.struct(self.value.alias("v")), order)
        if self.how == "latest":
            return F.max_by(self.value, F.when(self.value.isNotNull(), order))
        return {"min": F.min, "max": F.max, "any": F.max}[self.how](self.value)

    def carried(self, passed: Column, slices: Window) -> Column:
        """What a slice receives, from the summaries of the slices around it."""
        before = slices.rowsBetween(Window.unboundedPreceding, -1)
        if self.how in ("sum", "number"):
            return F.sum(passed).over(before)
        if self.how == "previous":
            return F.lag(passed).over(slices)
        if self.how == "following":
            return F.lead(passed).over(slices)
        if self.how == "latest":
            return F.last(passed, ignorenulls=True).over(before)
        return {"min": F.min, "max": F.max, "any": F.max}[self.how](passed).over(before)

    def combine(self, local: Column, carry: Column) -> Column:
        if self.how in ("sum", "number"):
            return local + F.coalesce(carry, F.lit(0))
        if self.how == "min":
            return F.least(local, carry)
        if self.how == "max":
            return F.greatest(local, carry)
        if self.how == "any":
            return F.coalesce(local, F.lit(False)) | F.coalesce(carry, F.lit(False))
        return F.coalesce(local, carry)

    def finish(self, value: Column) -> Column:
        if self.how == "number":
            return value + F.lit(self.start - 1)
        if self.how in ("previous", "following"):
            return value.getField("v")
        if self.how == "any":
            return F.coalesce(value, F.lit(False))
        return value


def running_sum(value: Column | str, inclusive: bool = True) -> Scan:
    return Scan("sum", _col(value), inclusive)


def running_min(value: Column | str, inclusive: bool = True) -> Scan:
    return Scan("min", _col(value), inclusive)


def running_max(value: Column | str, inclusive: bool = True) -> Scan:
    return Scan("max", _col(value), inclusive)


def running_any(value: Column | str, inclusive: bool = True) -> Scan:
    return Scan("any", _col(value), inclusive)


def number(start: int = 1) -> Scan:
    """Row number within the group, counted from ``start``."""
    return Scan("number", F.lit(1), start=start)


def previous(value: Column | str) -> Scan:
    """The value on the row before, null on the first row of the group."""
    return Scan("previous", _col(value))


def following(value: Column | str) -> Scan:
    """The value on the row after, null on the last row of the group."""
    return Scan("following", _col(value))


def latest(value: Column | str, inclusive: bool = True) -> Scan:
    """The last non-null value seen so far."""
    return Scan("latest", _col(value), inclusive)


def order_key(order: Sequence[str]) -> Column:
    """The order columns as one value to compare by."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --------------------------------------------------------------------------- cut points


@dataclass(frozen=True)
class Cuts:
    """Cut points, as sorted (group, order) keys."""

    fields: tuple[T.StructField, ...]
    points: tuple[tuple, ...]
    n_keys: int

    def groups(self) -> list[tuple]:
        """Groups that a cut point falls into."""
        return list(dict.fromkeys(p[: self.n_keys] for p in self.points))

    def position(self) -> Column:
        """Index of the slice a row falls into. Rows of a group that is not cut all have index 0."""
        if self.n_keys != 1:
            return self._search()
        key, cut = F.col(self.fields[0].name), [g[0] for g in self.groups()]
        in_cut = F.coalesce(key.isin([k for k in cut if k is not None]), F.lit(False))
        if None in cut:
            in_cut = in_cut | key.isNull()
        return F.when(in_cut, self._search()).otherwise(F.lit(0))

    def _search(self) -> Column:
        """Number of cut points at or before a row, by binary search."""
        steps, step = [], 1
        while step <= len(self.points):
            steps.insert(0, step)
            step *= 2
        reached = self._reached()
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, s: F.when(reached(at + s - F.lit(1)), at + s).otherwise(at),
        )

    def _reached(self):
        """Whether a row lies at or after the cut point of an index; null, like false, for an index past the end."""
        if any(None in p for p in self.points):
            bounds = F.array(*[_literal(point, self.fields) for point in self.points])
            row = F.struct(*[F.col(f.name) for f in self.fields])
            return lambda i: F.get(bounds, i) <= row
        # Without nulls, one array per column compares much faster than structs. A null in the row sorts first.
        columns = [
            F.array(*[F.lit(p[j]).cast(f.dataType) for p in self.points]) for j, f in enumerate(self.fields)
        ]

        def reached(i: Column) -> Column:
            last = F.get(columns[-1], i) <= F.col(self.fields[-1].name)
            for bounds, f in list(zip(columns, self.fields))[-2::-1]:
                bound, value = F.get(bounds, i), F.col(f.name)
                last = (bound < value) | ((bound == value) & last)
            return last

        return reached


def _literal(point: Sequence, fields: Sequence[T.StructField]) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(point, fields)])


def find_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int) -> Cuts | None:
    """Cut points for slices of about ``rows_per_slice`` rows; None when one slice is enough.

    The driver receives a sample of at most about ``MAX_SLICES * SAMPLES_PER_SLICE`` keys.
    """
    columns = df.select(*keys, *order)
    rows = columns.count()
    if rows <= rows_per_slice:
        return None
    slices = min(MAX_SLICES, -(-rows // rows_per_slice))
    fraction = min(1.0, slices * SAMPLES_PER_SLICE / rows)
    sample = columns.sample(fraction=fraction, seed=11).orderBy(*keys, *order).collect()
    every = max(1, len(sample) // slices)
    points = sorted(set(range(every, len(sample), every)))[: slices - 1]
    chosen = list(dict.fromkeys(tuple(sample[i]) for i in points))
    if not chosen:
        return None
    return Cuts(tuple(columns.schema.fields), tuple(chosen), len(keys))


# --------------------------------------------------------------------------- ordered rows


@dataclass(frozen=True)
class Ordered:
    """A table with an order inside each group, cut into slices of bounded size."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: Cuts | None
    scanned: bool = field(default=False)

    def scan(self, **scans: Scan) -> Ordered:
        """Add one column per named scan."""
        base = self
        if self.cuts is not None and self.scanned:
            base = replace(self, df=stage(self.df, "ordered"))
        rows = Window.partitionBy(*base.keys, SLICE).orderBy(*base.order)
        df = base.df.withColumns({name: scan.local(rows) for name, scan in scans.items()})
        if base.cuts is not None:
            kinds = {name: df.schema[name].dataType for name in scans}
            df = base._receive(df, scans)
            df = df.withColumns(
                {n: s.combine(F.col(n), F.col(f"_in_{n}")).cast(kinds[n]) for n, s in scans.items()}
            ).drop(*[f"_in_{n}" for n in scans])
        df = df.withColumns({name: scan.finish(F.col(name)) for name, scan in scans.items()})
        return replace(base, df=df, scanned=True)

    def _receive(self, df: DataFrame, scans: dict[str, Scan]) -> DataFrame:
        order = order_key(self.order)
        sums = self._cut_rows().groupBy(*self.keys, SLICE).agg(
            *[scan.summary(order).alias(name) for name, scan in scans.items()]
        )
        slices = Window.partitionBy(*self.keys).orderBy(SLICE)
        names = [*self.keys, SLICE]
        carry = sums.select(
            *[F.col(c).alias(f"_at{i}") for i, c in enumerate(names)],
            *[scan.carried(F.col(n), slices).alias(f"_in_{n}") for n, scan in scans.items()],
        )
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(names)]
        )
        # At most two rows per cut point: bounded by MAX_SLICES, not by the data.
        return df.join(F.broadcast(carry), same, "left").drop(*[f"_at{i}" for i in range(len(names))])

    def _cut_rows(self) -> DataFrame:
        """Rows of the groups that a cut point falls into."""
        if not self.keys:
            return self.df
        fields = self.cuts.fields[: len(self.keys)]
        schema = T.StructType([T.StructField(f"_g{i}", f.dataType) for i, f in enumerate(fields)])
        cut = self.df.sparkSession.createDataFrame(self.cuts.groups(), schema)
        same = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(self.keys)]
        )
        return self.df.join(F.broadcast(cut), same, "left_semi")

    def rows(self) -> DataFrame:
        return self.df.drop(SLICE)

    def settled(self) -> DataFrame:
        """The rows for use by several later steps: written to the shared folder when the table is large."""
        return self.rows() if self.cuts is None else stage(self.rows(), "settled")

    def between(self, low: int, high: int) -> DataFrame:
        """Rows of the slices from ``low`` up to ``high`` of a table without groups.

        The bounds on the first order column reach the scan, so files outside of them are not read.
        """
        first, points = F.col(self.order[0]), self.cuts.points
        kind, out = self.cuts.fields[0].dataType, self.df
        if low > 0 and points[low - 1][0] is not None:
            out = out.filter(first >= F.lit(points[low - 1][0]).cast(kind))
        if high <= len(points) and points[high - 1][0] is not None:
            out = out.filter(_up_to(first, F.lit(points[high - 1][0]).cast(kind)))
        return out.filter((F.col(SLICE) >= low) & (F.col(SLICE) < high))


def _up_to(column: Column, bound: Column) -> Column:
    """Nulls come first in every order used here."""
    return column.isNull() | (column <= bound)


def slice_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("tidemark.rowsPerSlice", str(ROWS_PER_SLICE)))


def order_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_slice: int | None = None,
    cuts_from: DataFrame | None = None,
) -> Ordered:
    """Put the rows of ``df`` in ``order`` inside each group of ``keys`` (none: the whole table).

    ``order`` must be unique inside a group. A session setting ``tidemark.rowsPerSlice`` overrides the size. Counting
    and sampling run over ``cuts_from`` when given: a stored table with the same keys that holds at least these rows
    spares running a costly ``df`` twice.
    """
    cuts = find_cuts(df if cuts_from is None else cuts_from, keys, order, rows_per_slice or slice_rows(df))
    position = F.lit(0) if cuts is None else cuts.position()
    return Ordered(df.withColumn(SLICE, position), tuple(keys), tuple(order), cuts)


# --------------------------------------------------------------------------- cut-offs


def keep_until(
    df: DataFrame,
    order: Sequence[str],
    weight: Column | str,
    limit: int,
    rows_per_slice: int | None = None,
    early: bool = True,
) -> DataFrame:
    """Rows, in ``order``, up to and including the one at which the running ``weight`` reaches ``limit``.

    Only the order and weight columns are ordered, and only inside the slice where the limit is reached. The
    result is a filter on the order key, so wide columns such as text are never shuffled.
    """
    last = cutoff_key(df, order, weight, limit, rows_per_slice, early)
    if last is None:
        return df
    if last == ():
        return df.limit(0)
    fields = [df.schema[c] for c in order]
    kept = F.struct(*order) <= _literal(last, fields)
    if last[0] is None:
        return df.filter(kept)
    return df.filter(_up_to(F.col(order[0]), F.lit(last[0]).cast(fields[0].dataType)) & kept)


def cutoff_key(
    df: DataFrame,
    order: Sequence[str],
    weight: Column | str,
    limit: int,
    rows_per_slice: int | None = None,
    early: bool = True,
) -> tuple | None:
    """Order key of the last kept row; None when every row is kept, () when none is.

    Slices are totalled from the front, twice as many each time, until the limit is reached: a small limit on a large
    table reads only its beginning. ``early`` off totals all slices at once, for an order that no file is sorted by.
    """
    if limit <= 0:
        return ()
    narrow = df.select(*order, _col(weight).cast("bigint").alias("_weight"))
    ordered = order_rows(narrow, (), order, rows_per_slice)
    slices = 1 if ordered.cuts is None else len(ordered.cuts.points) + 1
    before, low, step = 0, 0, 1 if early else slices
    while low < slices:
        high = min(slices, low + step)
        part = ordered.df if slices == 1 else ordered.between(low, high)
        totals = {r[0]: r[1] or 0 for r in part.groupBy(SLICE).agg(F.sum("_weight")).collect()}
        for at in sorted(totals):
            if before + totals[at] >= limit:
                inside = ordered.df if slices == 1 else ordered.between(at, at + 1)
                return _key_inside(inside, order, before, limit)
            before += totals[at]
        low, step = high, step * 2
    return None


def _key_inside(inside: DataFrame, order: Sequence[str], before: int, limit: int) -> tuple:
    """Order key at which the limit is reached inside one slice."""
    here = Window.partitionBy(SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("_weight").over(here), F.lit(0)) + F.lit(before)
    kept = inside.withColumn("_before", running).filter(F.col("_before") < limit)
    return tuple(kept.agg(F.max(F.struct(*order))).head()[0])
