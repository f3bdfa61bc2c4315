"""Profiling of a (wide) table: null counts, all-null columns, shape, schema, describe
(A1-A7).

Every profile is one aggregate pass with partial aggregation: each task reduces its rows to
one row of counters, so the shuffle carries one small row per task whatever the table size.
Results come back in long form, one row per column, which is the transposed describe.

Exact percentiles do not use Spark's ``percentile`` aggregate, which keeps a map of every
distinct value of a column in one task. ``exact_quantiles`` is a distributed selection:
each round counts the values of the still-open value band in a fixed number of buckets (one
small aggregate over the table), keeps the bucket that holds the wanted rank, and stops when
the band holds one value or few enough rows to rank them directly. Memory per task is bounded
by the bucket count and by ``final_rows``, never by the table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportwide.operators.wide import col
from reportwide.session import work_path

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def missing(f: T.StructField):
    """Null, or NaN in a floating-point column."""
    e = col(f.name).isNull()
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        e = e | F.isnan(col(f.name))
    return e


def _fields(df: DataFrame, columns: Sequence[str] | None,
            exclude: Sequence[str] = ()) -> list[T.StructField]:
    """Profiled fields. ``exclude`` names row-key columns: a keyed table's index is not one
    of its columns, so it is left out of counts, positions and the column total."""
    fields = list(df.schema.fields) if columns is None else [df.schema[c] for c in columns]
    return [f for f in fields if f.name not in set(exclude)]


def null_count(df: DataFrame, column: str) -> DataFrame:
    """Null (or NaN) count of one column (A1)."""
    f = df.schema[column]
    return df.agg(F.count_if(missing(f)).alias("null_count")).select(
        F.lit(column).alias("column_name"), "null_count")


# Spark compiles one aggregate with hundreds of expressions into code too large to run fast
# (and turns off the vectorised parquet reader past spark.sql.codegen.maxFields columns).
# A table read straight from columnar files is therefore profiled in batches of this many
# columns: each batch scans only its own columns, so every column is still read once.
# Derived inputs (joins, aggregates) are profiled in one pass, so their plan runs once.
PROFILE_BATCH = 50


def _missing_long(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """(position, column_name, dtype, n_rows, null_count) for the fields, one row each."""
    if len(fields) > PROFILE_BATCH and not _is_derived(df):
        batches = [list(range(b, min(b + PROFILE_BATCH, len(fields))))
                   for b in range(0, len(fields), PROFILE_BATCH)]
    else:
        batches = [list(range(len(fields)))]
    parts = []
    for idx in batches:
        row = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(missing(fields[i])).alias(f"__m{i}") for i in idx])
        items = [F.struct(F.lit(i).alias("position"), F.lit(fields[i].name).alias("column_name"),
                          F.lit(fields[i].dataType.simpleString()).alias("dtype"),
                          F.col("__rows").alias("n_rows"), F.col(f"__m{i}").alias("null_count"))
                 for i in idx]
        parts.append(row.select(F.inline(F.array(*items))))
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None,
                exclude: Sequence[str] = ()) -> DataFrame:
    """Null count of every column, one row per column (A2)."""
    return _missing_long(df, _fields(df, columns, exclude)).select(
        "position", "column_name", "null_count")


def all_null_columns(df: DataFrame, threshold: int | None = None,
                     exclude: Sequence[str] = ()) -> DataFrame:
    """Columns whose null count equals the threshold, by default the row count (A3)."""
    want = F.lit(threshold) if threshold is not None else F.col("n_rows")
    return (_missing_long(df, _fields(df, None, exclude))
            .filter(F.col("null_count") == want).select("column_name", "null_count"))


def shape(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Row and column count as one row (A4); key columns in ``exclude`` are not counted."""
    n_cols = len(_fields(df, None, exclude))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(n_cols).cast("bigint").alias("n_cols"))


def schema_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Position, name, non-null count and type of every column (A5)."""
    return _missing_long(df, _fields(df, None, exclude)).select(
        "position", "column_name", (F.col("n_rows") - F.col("null_count")).alias("non_null_count"),
        "dtype")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, v) for every present value of the given columns, NaN and null dropped."""
    items = [F.struct(F.lit(c).alias("column_name"), col(c).cast("double").alias("v"))
             for c in columns]
    out = df.select(F.inline(F.array(*items)))
    return out.filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _is_derived(df: DataFrame) -> bool:
    """True when the plan joins or aggregates, i.e. recomputing it costs more than a scan."""
    jdf = getattr(df, "_jdf", None)
    if jdf is None:
        return True
    plan = jdf.queryExecution().optimizedPlan().toString()
    return "Join" in plan or "Aggregate" in plan


def _pct_name(p: float) -> str:
    return "p" + (f"{p * 100:.10g}").replace(".", "_")


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             probs: Sequence[float] = (0.25, 0.5, 0.75), method: str = "exact",
             digits: int | None = None, accuracy: int = 10_000,
             materialize: bool | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, percentiles, max per numeric column, one row each.

    ``method='exact'`` gives linearly interpolated percentiles equal to a full sort;
    ``method='approx'`` uses ``percentile_approx`` with the given accuracy.
    """
    cols = [c for c in (list(columns) if columns is not None else numeric_columns(df))
            if c not in set(exclude)]
    if not cols:
        raise ValueError("describe needs at least one numeric column")
    names = ["column_name", "count", "mean", "std", "min"] + [_pct_name(p) for p in probs] + ["max"]
    if method == "approx":
        aggs = []
        for i, c in enumerate(cols):
            v = F.when(F.isnan(col(c).cast("double")), F.lit(None)).otherwise(col(c).cast("double"))
            aggs += [F.count(v).alias(f"__n{i}"), F.avg(v).alias(f"__a{i}"),
                     F.stddev_samp(v).alias(f"__s{i}"), F.min(v).alias(f"__lo{i}"),
                     F.max(v).alias(f"__hi{i}"),
                     F.percentile_approx(v, list(probs), accuracy).alias(f"__q{i}")]
        row = df.agg(*aggs)
        items = []
        for i, c in enumerate(cols):
            items.append(F.struct(
                F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                F.col(f"__n{i}").alias("count"), F.col(f"__a{i}").alias("mean"),
                F.col(f"__s{i}").alias("std"), F.col(f"__lo{i}").alias("min"),
                *[F.col(f"__q{i}")[j].alias(_pct_name(p)) for j, p in enumerate(probs)],
                F.col(f"__hi{i}").alias("max")))
        out = row.select(F.inline(F.array(*items))).orderBy("position").select(*names)
    elif method == "exact":
        if materialize is None:
            materialize = _is_derived(df)
        if materialize:
            # A derived input (joins, aggregates) is written once, so that the passes read
            # columns of files instead of computing the plan again.
            path = work_path(df.sparkSession, "describe")
            df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).write.parquet(path)
            plain = df.sparkSession.read.parquet(path)
        else:
            plain = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
        got, q = {}, {}
        for i, (moments, values) in enumerate(column_quantiles(plain, plain.columns, probs)):
            if moments["n"]:
                got[cols[i]] = moments
                q.update({(cols[i], _pct_name(p)): v for p, v in zip(probs, values)})
        data = []
        for c in cols:
            g = got.get(c)
            data.append((c, g["n"] if g else 0, g["a"] if g else None, g["s"] if g else None,
                         g["lo"] if g else None, *[q.get((c, _pct_name(p))) for p in probs],
                         g["hi"] if g else None))
        schema = ", ".join(["column_name string", "count bigint", "mean double", "std double",
                            "min double"] + [f"{_pct_name(p)} double" for p in probs]
                           + ["max double"])
        out = df.sparkSession.createDataFrame(data, schema)
    else:
        raise ValueError(f"unknown method {method!r}")
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) if c not in ("column_name", "count") else c
                           for c in names])
    return out


# ---- exact distributed quantiles -----------------------------------------------------------

def _t(x: float) -> float:
    """Order-preserving compression of magnitudes for bands spanning many decades."""
    return math.copysign(math.log1p(abs(x)), x)


def _between(a: float, b: float, frac: float) -> float:
    """Linear interpolation from a to b; an infinite lower neighbour stays infinite."""
    if not frac or a == b or (math.isinf(a) and not math.isinf(b)):
        return a
    return a + frac * (b - a)


# Size parameter of the sketches: a rank is off by more than RANK_ERROR of the rows with a
# probability well below one in a thousand; a bracket that misses its rank is only moved.
SKETCH_K = 4096
RANK_ERROR = 0.0015
# A bracket with at most this many values inside it is collected and sorted in the aggregate.
FEW = 16_384
# Equal steps of the ranks inside a bracket that is sketched again.
CUTS = 256
# Columns of one aggregate (a pass reads each column once, in the aggregate that has it).
COLUMNS_AT_ONCE = 12


def _sketch_quantiles(v, ranks: Sequence[float]):
    """Values near the given ranks (0 to 1), or null without values."""
    s = F.kll_sketch_agg_double(v, F.lit(SKETCH_K))
    at = F.array(*[F.lit(float(r)) for r in ranks])
    return F.when(F.count(v) > 0, F.kll_sketch_get_quantile_double(s, at))


class _Bracket:
    """Two neighbouring ranks of a column, known to lie among the values from lo to hi."""

    def __init__(self, column: str, k: int, k2: int, lo: float, hi: float, inside: int):
        self.column, self.ranks, self.lo, self.hi, self.inside = column, (k, k2), lo, hi, inside
        self.value: dict[int, float] = {}
        if lo == hi:
            self.value = {k: lo, k2: lo}

    def aggregates(self, i: int) -> list:
        v = col(self.column)
        lo, hi = F.lit(self.lo), F.lit(self.hi)
        within = F.when((v > lo) & (v < hi), v)
        out = [F.count_if(v < lo), F.count_if(v == lo), F.count(within), F.count_if(v == hi), F.min(within), F.max(within)]
        if self.inside <= FEW:
            ordered = F.sort_array(F.collect_list(within))
            place = [F.lit(k) - F.count_if(v <= lo) for k in self.ranks]
            out.append(F.array(*[F.get(ordered, F.when(p >= 0, p).otherwise(F.lit(-1)).cast("int")) for p in place]))
        else:
            out.append(F.array(*[F.lit(None).cast("double")] * 2))
            # The ranks' place among the values inside is only known after this pass: cut them evenly.
            out.append(_sketch_quantiles(within, [j / CUTS for j in range(CUTS + 1)]))
        return [c.alias(f"b{i}_{j}") for j, c in enumerate(out)]

    def narrow(self, i: int, row) -> None:
        below, at_lo, mid, at_hi, first, last, picked = (row[f"b{i}_{j}"] for j in range(7))
        start, end = below + at_lo, below + at_lo + mid
        for k, v in zip(self.ranks, picked):
            if below <= k < start:
                self.value[k] = self.lo
            elif end <= k < end + at_hi:
                self.value[k] = self.hi
            elif start <= k < end and v is not None:
                self.value[k] = v
        open_ = [k for k in self.ranks if k not in self.value]
        if not open_:
            return
        if open_[0] < below:  # the sketch was off: look on the side where the rank is
            self.lo, self.hi, self.inside = -math.inf, self.lo, below
        elif open_[-1] >= end + at_hi:
            self.lo, self.hi, self.inside = self.hi, math.inf, sys.maxsize
        elif self.inside > FEW:
            cuts = [first, *row[f"b{i}_7"], last]
            error = max(1, math.ceil(RANK_ERROR * CUTS))
            a = int((open_[0] - start) / mid * CUTS) + 1 - error
            b = int((open_[-1] - start) / mid * CUTS) + 2 + error
            self.lo, self.hi = cuts[max(a, 0)] if a > 0 else first, cuts[min(b, CUTS + 2)] if b < CUTS + 2 else last
            self.inside = min(mid, round(mid * ((min(b, CUTS + 2) - max(a, 0)) / CUTS + 2 * RANK_ERROR)))
        else:
            self.lo, self.hi, self.inside = first, last, mid


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[tuple[dict, list]]:
    """Moments (n, a, s, lo, hi) and exact interpolated quantiles of each double column.

    One aggregate pass gives the moments and a mergeable sketch of every column. The sketch brackets
    the wanted ranks; the next pass counts what lies below each bracket and sorts the few values
    inside it, which gives the ranks exactly. A bracket that still holds more than ``FEW`` values is
    sketched again inside (each pass divides it by some 60), so a table of two million rows takes two
    passes, one of a trillion six. Values equal to a bracket's ends are counted, not collected, so
    ties of any size take no room. NaN and null do not count.
    """
    out: dict[str, tuple[dict, list]] = {}
    brackets: list[_Bracket] = []
    wanted: dict[str, list[tuple[int, int, float]]] = {}
    # Each wanted rank is sought between the sketch's values a little below and above it.
    around = [min(1.0, max(0.0, p + e)) for p in probs for e in (-RANK_ERROR, RANK_ERROR)]
    clean = df.select(*[F.when(~F.isnan(col(c)), col(c)).alias(c) for c in columns])
    for at in range(0, len(columns), COLUMNS_AT_ONCE):
        here = columns[at:at + COLUMNS_AT_ONCE]
        row = clean.agg(*[e.alias(f"{c}_{x}") for c in here for x, e in (
            ("n", F.count(col(c))), ("a", F.avg(col(c))), ("s", F.stddev_samp(col(c))), ("lo", F.min(col(c))),
            ("hi", F.max(col(c))), ("q", _sketch_quantiles(col(c), around)))]).first()
        for c in here:
            m = {x: row[f"{c}_{x}"] for x in ("n", "a", "s", "lo", "hi")}
            out[c] = (m, [])
            wanted[c] = []
            for j, p in enumerate(probs if m["n"] else ()):
                at_ = p * (m["n"] - 1)
                k = int(math.floor(at_))
                wanted[c].append((k, min(k + 1, m["n"] - 1), at_ - k))
                lo, hi = row[f"{c}_q"][2 * j:2 * j + 2]
                lo, hi = m["lo"] if p <= RANK_ERROR else lo, m["hi"] if p >= 1 - RANK_ERROR else hi
                brackets.append(_Bracket(c, k, wanted[c][-1][1], lo, hi, math.ceil(m["n"] * 4 * RANK_ERROR)))
                if lo == hi and m["lo"] < m["hi"]:
                    brackets[-1].value = {}  # heavy ties here: the next pass counts them
    while True:
        open_ = [b for b in brackets if len(b.value) < len(set(b.ranks))]
        if not open_:
            break
        names = list(dict.fromkeys(b.column for b in open_))
        for at in range(0, len(names), COLUMNS_AT_ONCE):
            here = [b for b in open_ if b.column in set(names[at:at + COLUMNS_AT_ONCE])]
            row = clean.agg(*[a for i, b in enumerate(here) for a in b.aggregates(i)]).first()
            for i, b in enumerate(here):
                b.narrow(i, row)
    found = iter(brackets)
    for c in columns:
        for k, k2, frac in wanted[c]:
            value = next(found).value
            out[c][1].append(_between(value[k], value[k2], frac))
    return [out[c] for c in columns]


def exact_quantiles(values: DataFrame, probs: Sequence[float],
                    stats: Sequence[tuple[str, int, float, float]] | None = None,
                    bins: int = 4096, final_rows: int = 200_000, max_rounds: int = 64,
                    shrink: float = 0.25) -> DataFrame:
    """Exact linear-interpolated quantiles per column from a long (column_name, v) table.

    Returns (column_name, p, p_name, value). Interpolation: with n values sorted ascending
    and r = p * (n - 1), value = x[floor(r)] + (r - floor(r)) * (x[floor(r) + 1] - x[floor(r)]).
    """
    spark: SparkSession = values.sparkSession
    if stats is None:
        stats = [(r["column_name"], r["n"], r["lo"], r["hi"]) for r in values.groupBy("column_name")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                      F.max("v").alias("hi")).collect()]
    stats = [s for s in stats if s[1]]
    current_rows = sum(s[1] for s in stats)
    # targets: (column, 0-based rank) -> state
    state: dict[tuple[str, int], dict] = {}
    want: list[tuple[str, float, int, int, float]] = []
    for name, n, lo, hi in stats:
        for p in probs:
            pos = p * (n - 1)
            k = int(math.floor(pos))
            k2 = min(k + 1, n - 1)
            want.append((name, p, k, k2, pos - k))
            for kk in (k, k2):
                state.setdefault((name, kk), {
                    "lo": lo, "hi": hi, "below": 0, "count": n, "value": None,
                    "log": max(abs(lo), abs(hi)) >= 1e6})
    for s in state.values():
        if s["lo"] == s["hi"]:
            s["value"] = s["lo"]

    for _ in range(max_rounds):
        active = {key: s for key, s in state.items()
                  if s["value"] is None and s["count"] > final_rows}
        if not active:
            break
        bands: dict[tuple, int] = {}
        for (c, _k), s in active.items():
            bands.setdefault((c, s["lo"], s["hi"], s["log"]), len(bands))
        band_rows = []
        for (c, lo, hi, log_mode), bid in bands.items():
            # Buckets span finite values; infinities fall in the first and last bucket.
            flo, fhi = max(lo, -sys.float_info.max), min(hi, sys.float_info.max)
            tlo, thi = (_t(flo), _t(fhi)) if log_mode else (flo, fhi)
            width = (thi / 2 - tlo / 2) * 2
            if not (width > 0) or math.isinf(width):
                width = 0.0
            band_rows.append((bid, c, float(lo), float(hi), bool(log_mode), float(tlo), width))
        bdf = spark.createDataFrame(
            band_rows, "band int, bc string, blo double, bhi double, blog boolean, "
                       "btlo double, bwidth double")
        open_bands = {(c, s["lo"], s["hi"]): s["count"]
                      for (c, _k), s in state.items() if s["value"] is None}
        in_bands = sum(open_bands.values())
        if in_bands < shrink * current_rows:
            # Later rounds only look inside the open bands: keep those values once, written
            # to the checkpoint folder, instead of scanning the whole table again.
            keep = spark.createDataFrame([(c, float(lo), float(hi)) for c, lo, hi in open_bands],
                                         "kc string, klo double, khi double")
            values = values.join(F.broadcast(keep), (F.col("column_name") == F.col("kc"))
                                 & (F.col("v") >= F.col("klo")) & (F.col("v") <= F.col("khi")),
                                 "left_semi").checkpoint(eager=True)
            current_rows = in_bands
        # One pass over the values for all open bands; the band table is bounded by the
        # number of wanted ranks, so broadcasting it is safe.
        j = values.join(F.broadcast(bdf), (F.col("column_name") == F.col("bc"))
                        & (F.col("v") >= F.col("blo")) & (F.col("v") <= F.col("bhi")))
        tv = F.when(F.col("blog"), F.signum("v") * F.log1p(F.abs("v"))).otherwise(F.col("v"))
        b = F.when(F.col("bwidth") > 0, F.floor((tv - F.col("btlo")) / F.col("bwidth") * F.lit(bins))
                   ).otherwise(F.lit(0))
        b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1)).cast("int")
        rows = (j.groupBy("band", b.alias("b"))
                .agg(F.count(F.lit(1)).alias("cnt"), F.min("v").alias("mn"), F.max("v").alias("mx")))
        # Running counts per band (a band has at most ``bins`` buckets), then the bucket that
        # holds each wanted rank; only one row per wanted rank reaches the driver.
        w = Window.partitionBy("band").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("cum_end", F.sum("cnt").over(w))
        tlist = list(active.items())
        tdf = spark.createDataFrame(
            [(i, bands[(c, st["lo"], st["hi"], st["log"])], int(k - st["below"]))
             for i, ((c, k), st) in enumerate(tlist)], "tid int, tband int, local_rank long")
        hit = rows.join(F.broadcast(tdf), (F.col("band") == F.col("tband"))
                        & (F.col("cum_end") - F.col("cnt") <= F.col("local_rank"))
                        & (F.col("local_rank") < F.col("cum_end")))
        found = {r["tid"]: r for r in hit.select("tid", "cnt", "mn", "mx", "cum_end").collect()}
        for i, ((c, k), st) in enumerate(tlist):
            r = found.get(i)
            if r is None:
                raise RuntimeError(f"rank {k} of {c} not found")
            shrunk = r["cnt"] < st["count"] or r["mn"] > st["lo"] or r["mx"] < st["hi"]
            st.update(lo=r["mn"], hi=r["mx"], below=st["below"] + r["cum_end"] - r["cnt"],
                      count=r["cnt"])
            if r["mn"] == r["mx"]:
                st["value"] = r["mn"]
            if not shrunk:
                st["log"] = False

    pending = {key: s for key, s in state.items() if s["value"] is None}
    if pending:
        band_rows = []
        for i, ((c, k), s) in enumerate(pending.items()):
            band_rows.append((i, c, k, float(s["lo"]), float(s["hi"]), int(s["below"])))
        bdf = spark.createDataFrame(
            band_rows, "tid int, column_name string, k long, lo double, hi double, below long")
        # Each band holds at most final_rows values, so one window partition per band is bounded.
        inband = values.join(F.broadcast(bdf), (values.column_name == bdf.column_name)
                             & (values.v >= bdf.lo) & (values.v <= bdf.hi)).select("tid", "k", "below", "v")
        w = Window.partitionBy("tid").orderBy("v")
        # one row per still-open rank reaches the driver
        picked = (inband.withColumn("__rn", F.row_number().over(w))
                  .filter(F.col("below") + F.col("__rn") - 1 == F.col("k"))
                  .select("tid", "v").collect())
        found = {r["tid"]: r["v"] for r in picked}
        for i, key in enumerate(pending):
            state[key]["value"] = found[i]

    out = []
    for c, p, k, k2, frac in want:
        a, b = state[(c, k)]["value"], state[(c, k2)]["value"]
        out.append((c, float(p), _pct_name(p), _between(float(a), float(b), frac)))
    schema = "column_name string, p double, p_name string, value double"
    if not out:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(out, schema)
