"""Statistics reports that are read off one global aggregate.

A report names the row-level inputs it needs, the aggregates over them, and the
rows of its result. Any number of reports can share one scan: ``measure`` builds
a single one-row aggregate for all of them and each report reads its own part.
Nothing is shuffled but one partial row per task, so no key can be hot, and the
rows come out in their declared order without a sort.

Expressions are SQL text, so a report of hundreds of expressions reaches Spark in
a handful of calls.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..checkpoints import pin_partitions
from ..functions.ladders import Ladder
from ..functions.numbers import percent_sql, rounded_sql
from ..functions.text import quoted
from .filters import has_items_sql, has_text_sql

Named = Callable[[str], str]
Layer = Callable[[Named], dict[str, str]]
Row = dict[str, str]


def name(identifier: str) -> str:
    """A column name in SQL."""
    return "`" + identifier.replace("`", "``") + "`"


@dataclass(frozen=True)
class Report:
    """``inputs`` are read from the rows; each further layer is built on the one before.

    Layers keep an expensive value that many expressions use (lower-cased text, a
    keyword count) from being worked out more than once per row.
    """

    title: str
    inputs: dict[str, str]
    measures: Layer
    rows: Callable[[Named], list[Row]]
    layers: tuple[Layer, ...] = ()
    drop_if_zero: str | None = None
    label: str | None = None
    quantiles: tuple[float, ...] = ()      # shares at which ``v`` is read off, as the array measure ``q``

    def named(self, key: str) -> str:
        return name(f"{self.title}__{key}")

    def _aliased(self, expressions: dict[str, str]) -> list[str]:
        return [f"{sql} AS {self.named(key)}" for key, sql in expressions.items()]

    def projections(self, depth: int) -> list[list[str]]:
        """The select lists from the rows to the aggregate's inputs, ``depth`` + 1 of them."""
        steps, keys = [self._aliased(self.inputs)], list(self.inputs)
        for layer in self.layers:
            expressions = layer(self.named)
            steps.append(self._aliased(expressions))
            keys = list(expressions)
        while len(steps) <= depth:
            steps.append([self.named(key) for key in keys])
        return steps

    def aggregates(self) -> list[str]:
        return self._aliased(self.measures(self.named))

    def read(self, measured: DataFrame) -> DataFrame:
        """The report's rows, from a frame made by ``measure``."""
        out = measured.selectExpr(_inline(self.rows(self.named)))
        return out.filter(f"{name(self.drop_if_zero)} > 0") if self.drop_if_zero else out

    def of(self, df: DataFrame) -> DataFrame:
        return self.read(measure(df, [self]))


def _inline(rows: Sequence[Row]) -> str:
    structs = ("struct(" + ", ".join(f"{sql} AS {name(key)}" for key, sql in row.items()) + ")" for row in rows)
    return f"inline(array({', '.join(structs)}))"


def measure(df: DataFrame, reports: Sequence[Report]) -> DataFrame:
    """One row with the measures of all ``reports``, from one scan of ``df``, and one more for each with quantiles."""
    rows = df
    depth = max(len(r.layers) for r in reports)
    for step in zip(*(r.projections(depth) for r in reports)):
        df = df.selectExpr(*[sql for expressions in step for sql in expressions])
    measured = df.selectExpr(*[sql for r in reports for sql in r.aggregates()])
    for r in reports:
        if r.quantiles:
            found = exact_quantiles(rows, r.inputs["v"], r.quantiles, f"{r.title}__q")
            measured = (measured.withColumn("_one", F.lit(1)).join(found.withColumn("_one", F.lit(1)), "_one")
                        .drop("_one"))
    return measured


def exact_quantiles(df: DataFrame, value: str, points: Sequence[float], alias: str) -> DataFrame:
    """One row with an array: for each point, the least value that at least that share of the rows does not exceed.

    Equal values are counted in each task before they meet, then sorted by range. The
    totals of the ranges, one row each, tell in which of them a point lies; only those are
    added up value by value. NULL values count for nothing.
    """
    counted = df.selectExpr(f"{value} AS v").filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    # Sorted once and kept, as the ranges must be the same for both steps.
    placed = pin_partitions(counted.orderBy("v")).select("v", "n", F.spark_partition_id().alias("part"))
    totals = placed.groupBy("part").agg(F.sum("n").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select("part", "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
                           F.sum("rows").over(Window.partitionBy()).alias("total"))
    ranked = ranges.select("part", "before", "rows", F.explode(F.array(*[
        F.struct(F.lit(i).alias("point"), F.greatest(F.ceil(F.lit(float(p)) * F.col("total")), F.lit(1)).alias("rank"))
        for i, p in enumerate(points)])).alias("of"))
    sought = ranked.select("part", "before", "of.*").filter("rank > before").join(
        ranges.select("part", "rows"), "part").filter("rank <= before + rows").drop("rows")
    # As many rows as points.
    reached = placed.join(F.broadcast(sought), "part").withColumn("upto", F.col("before") + F.sum("n").over(
        Window.partitionBy("part", "point").orderBy("v")))
    least = reached.groupBy("point").agg(F.min(F.when(F.col("upto") >= F.col("rank"), F.col("v"))).alias("v"))
    pairs = F.map_from_entries(F.collect_list(F.struct("point", "v")))
    return least.agg(F.array(*[F.try_element_at(pairs, F.lit(i)) for i in range(len(points))]).alias(alias))


# --------------------------------------------------------------- histograms

def histogram(title: str, value: str, ladder: Ladder, label: str, count: str = "book_count",
              share_of_all: bool = False) -> Report:
    """Rows per bucket of ``value`` and their percentage, empty buckets left out.

    The percentage is taken of the rows with a value, or of all rows when
    ``share_of_all`` (rows without a value then count in the denominator only).
    """
    return histogram_of(title, {"value": value}, (), ladder, label, count, share_of_all)


def histogram_of(title: str, inputs: dict[str, str], layers: Sequence[Layer], ladder: Ladder,
                 label: str, count: str = "book_count", share_of_all: bool = False) -> Report:
    """A histogram of ``value``, which ``inputs`` or the last of ``layers`` provides."""
    def place(m):
        return {"bucket": ladder.ordinal(m("value"))}

    def measures(m):
        counts = {f"n{i}": f"count_if({m('bucket')} = {i})" for i in range(len(ladder.labels))}
        return {**counts, "total": "count(1)" if share_of_all else f"count({m('bucket')})"}

    def rows(m):
        return [{label: quoted(text), count: m(f"n{i}"), "percentage": percent_sql(m(f"n{i}"), m("total"))}
                for i, text in enumerate(ladder.labels)]

    return Report(title, inputs, measures, rows, (*layers, place), drop_if_zero=count, label=label)


def histograms_together(df: DataFrame, histograms: Sequence[Report]) -> DataFrame:
    """All ``histograms`` in one scan, as rows (report, bucket, book_count, percentage)."""
    rows = [{"report": quoted(r.title), "bucket": row[r.label], "book_count": row[r.drop_if_zero],
             "percentage": row["percentage"]} for r in histograms for row in r.rows(r.named)]
    return measure(df, histograms).selectExpr(_inline(rows)).filter("book_count > 0")


def _cells(row_ladder: Ladder, col_ladder: Ladder) -> tuple[Layer, Layer]:
    """The layer that places a row, and the counts of all pairs of places."""
    def place(m):
        return {"row": row_ladder.ordinal(m("row")), "col": col_ladder.ordinal(m("col"))}

    def measures(m):
        return {f"n{i}_{j}": f"count_if({m('row')} = {i} AND {m('col')} = {j})"
                for i in range(len(row_ladder.labels)) for j in range(len(col_ladder.labels))}

    return place, measures


def crosstab(title: str, row_value: str, row_ladder: Ladder, row_label: str, col_value: str,
             col_ladder: Ladder, col_label: str, count: str = "book_count") -> Report:
    """Rows per pair of buckets, ordered by the two labels, empty pairs left out."""
    place, measures = _cells(row_ladder, col_ladder)
    ordered = sorted((r, c, f"n{i}_{j}") for i, r in enumerate(row_ladder.labels)
                     for j, c in enumerate(col_ladder.labels))

    def rows(m):
        return [{row_label: quoted(r), col_label: quoted(c), count: m(cell)} for r, c, cell in ordered]

    return Report(title, {"row": row_value, "col": col_value}, measures, rows, (place,), drop_if_zero=count)


def crosstab_matrix(title: str, row_value: str, row_ladder: Ladder, row_label: str, col_value: str,
                    col_ladder: Ladder) -> Report:
    """The dense form: one row per row bucket, one zero-filled column per column bucket."""
    place, measures = _cells(row_ladder, col_ladder)

    def rows(m):
        return [{row_label: quoted(r), **{c: m(f"n{i}_{j}") for j, c in enumerate(col_ladder.labels)}}
                for i, r in enumerate(row_ladder.labels)]

    return Report(title, {"row": row_value, "col": col_value}, measures, rows, (place,))


def profile(title: str, value: str, ladder: Ladder, label: str, averages: dict[str, str],
            count: str = "book_count") -> Report:
    """Rows per bucket with rounded averages; only rows where every input is known."""
    def place(m):
        known = " AND ".join(f"{m(key)} IS NOT NULL" for key in ("value", *averages))
        return {"bucket": f"CASE WHEN {known} THEN {ladder.ordinal(m('value'))} END",
                **{a: m(a) for a in averages}}

    def measures(m):
        out = {}
        for i in range(len(ladder.labels)):
            here = f"{m('bucket')} = {i}"
            out[f"n{i}"] = f"count_if({here})"
            out |= {f"{a}{i}": f"avg(CASE WHEN {here} THEN {m(a)} END)" for a in averages}
        return out

    def rows(m):
        return [{label: quoted(text), count: m(f"n{i}"), **{a: rounded_sql(m(f"{a}{i}")) for a in averages}}
                for i, text in enumerate(ladder.labels)]

    return Report(title, {"value": value, **averages}, measures, rows, (place,), drop_if_zero=count)


# ---------------------------------------------------------------- summaries

def _moment_measures(m: Named) -> dict[str, str]:
    v = m("v")
    return {"mean": f"avg({v})", "std": f"stddev_samp({v})", "min": f"min({v})", "max": f"max({v})"}


def _moment_columns(m: Named, suffix: str) -> Row:
    return {f"mean_{suffix}": rounded_sql(m("mean")), f"std_{suffix}": rounded_sql(m("std")),
            f"min_{suffix}": m("min"), f"max_{suffix}": m("max")}


def moments(title: str, value: str, suffix: str) -> Report:
    """Mean and sample standard deviation (two decimals), minimum and maximum."""
    return Report(title, {"v": value}, _moment_measures, lambda m: [_moment_columns(m, suffix)])


def summary(title: str, value: str, suffix: str) -> Report:
    """The four moments, the three quartiles (exact), and how far the mean lies above the median."""
    def rows(m):
        quartiles = {f"{label}_{suffix}": f"{m('q')}[{i}]" for i, label in enumerate(("q1", "median", "q3"))}
        gap = rounded_sql(f"{rounded_sql(m('mean'))} - {m('q')}[1]")
        return [{**_moment_columns(m, suffix), **quartiles, "mean_median_gap": gap}]

    return Report(title, {"v": value}, _moment_measures, rows, quantiles=(0.25, 0.5, 0.75))


def quantile_report(title: str, value: str, points: Sequence[float]) -> Report:
    """One row per point: the value below which that share of the rows lies."""
    return Report(title, {"v": value}, lambda m: {"n": f"count({m('v')})"},
                  lambda m: [{"quantile": f"{p}D", "value": f"{m('q')}[{i}]"} for i, p in enumerate(points)],
                  quantiles=tuple(points))


def missing(title: str, text: Sequence[str] = (), arrays: Sequence[str] = (),
            plain: Sequence[str] = ()) -> Report:
    """Missing values per column: NULL or '' for text, NULL or empty for arrays, else NULL."""
    absent = {c: f"NOT {has_text_sql(name(c))}" for c in text}
    absent |= {c: f"NOT {has_items_sql(name(c))}" for c in arrays}
    absent |= {c: f"{name(c)} IS NULL" for c in plain}

    def measures(m):
        return {**{c: f"count_if({m(c)})" for c in absent}, "* total": "count(1)"}

    def rows(m):
        return [{"column": quoted(c), "missing": m(c), "percentage": percent_sql(m(c), m("* total"))} for c in absent]

    return Report(title, absent, measures, rows)


def presence(title: str, present: str, with_label: str, without_label: str) -> Report:
    """Two rows: how many records have the thing and how many have not."""
    def measures(m):
        return {"yes": f"count_if({m('has')})", "total": "count(1)"}

    def rows(m):
        return [{"group": quoted(text), "book_count": n, "percentage": percent_sql(n, m("total"))}
                for text, n in ((with_label, m("yes")), (without_label, f"{m('total')} - {m('yes')}"))]

    return Report(title, {"has": present}, measures, rows)


def average(title: str, value: str, label: str) -> Report:
    """The rounded mean of ``value`` over the rows where it is known."""
    return average_of(title, {"value": value}, (), label)


def average_of(title: str, inputs: dict[str, str], layers: Sequence[Layer], label: str) -> Report:
    return Report(title, inputs, lambda m: {"avg": f"avg({m('value')})"},
                  lambda m: [{label: rounded_sql(m("avg"))}], tuple(layers))


def average_size(title: str, array: str, label: str) -> Report:
    """The mean length of the non-empty arrays."""
    return average(title, f"CASE WHEN {has_items_sql(name(array))} THEN size({name(array)}) END", label)


# ------------------------------------------------------ aggregates with a key

def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Row count and number of distinct keys, a NULL key counting as one value."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .selectExpr("coalesce(sum(n), 0) AS total_rows", "count(1) AS distinct_keys"))


def label_counts(df: DataFrame, label: str, count: str = "count") -> DataFrame:
    """Rows per label, ordered by label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(count)).orderBy(label)


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through the points of ``df``: ``y = slope * x + intercept``."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
