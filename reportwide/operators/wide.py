"""Wide join of keyed report tables.

A wide table is a fold of left outer joins on shared key columns. Each right table adds only
the columns the running table does not have yet (sorted by name, case-sensitive, capitals
first), so on overlapping names the earlier table wins.

Plan shape: each report table is hash-partitioned on the keys once; the chain of joins keeps
that partitioning, so N tables cost N exchanges and no intermediate result is re-shuffled.
AQE turns a join into a broadcast join only when the measured shuffle output of a side is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Long chains are cut by checkpoints
(bounded sorters per task) and hot anchor keys are salted across the whole chain, since AQE
can split a skewed partition only in the first join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportwide.session import checkpoint_dir


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column reference that is safe for names holding dots or spaces."""
    return F.col(_q(name))


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} not in {df.columns}")


def check_case_clash(columns: Sequence[str]) -> None:
    """Spark resolves names case-insensitively by default; refuse names that differ by case."""
    seen: dict[str, str] = {}
    for c in columns:
        low = c.lower()
        if low in seen and seen[low] != c:
            raise ValueError(
                f"columns {seen[low]!r} and {c!r} differ only by case; rename one or set "
                "spark.sql.caseSensitive=true")
        seen[low] = c


def new_columns(right_columns: Sequence[str], left_columns: Sequence[str],
                keys: Sequence[str] = ()) -> list[str]:
    """Columns of the right table absent from the left, sorted by code point."""
    have = set(left_columns) | set(keys)
    return sorted(c for c in set(right_columns) if c not in have)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column projection."""
    return df.select(*[col(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns (P3); unknown names are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


def join_left(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_safe: bool = False, unique_right: bool = False) -> DataFrame:
    """Left outer equi-join adding only the right table's new columns.

    Right-only keys are dropped; a key repeated on the right repeats the left row, as the
    row-label join it mirrors does. ``null_safe`` matches null keys to null keys
    (``<=>``), which still plans as a hash or sort-merge join.

    ``unique_right`` states that the right table has one row per key. The right side is then
    grouped by the keys (the exchange the join needs anyway, with map-side combining), which
    tells Catalyst the side is unique: a join none of whose columns are read later is removed
    from the plan.
    """
    check_keys(left, keys)
    check_keys(right, keys)
    add = new_columns(right.columns, left.columns, keys)
    check_case_clash(list(left.columns) + add)
    r = right.select(*[col(k) for k in keys], *[col(c) for c in add])
    if unique_right:
        r = r.groupBy(*[col(k) for k in keys]).agg(*[F.any_value(col(c)).alias(c) for c in add])
    if not null_safe:
        return left.join(r, on=list(keys), how="left")
    renamed = {k: f"__rk_{i}" for i, k in enumerate(keys)}
    r = r.select(*[col(k).alias(renamed[k]) for k in keys], *[col(c) for c in add])
    cond = reduce(lambda a, b: a & b, [left[_q(k)].eqNullSafe(r[renamed[k]]) for k in keys])
    return left.join(r, cond, "left").drop(*renamed.values())


# Sort-merge joins chained in one stage each hold a sorter (with at least one memory page)
# per right table inside every task; past roughly a dozen joins the pages alone exceed a
# task's share of execution memory. The chain is therefore cut every JOINS_PER_STAGE joins
# by checkpointing the running table to the shared checkpoint folder. The checkpoint keeps
# the hash partitioning on the keys, so the next joins need no extra shuffle, and it also
# bounds the lineage a lost executor has to recompute.
JOINS_PER_STAGE = 8


# A key is hot when it holds at least HOT_SHARE of the anchor's rows, or HOT_ROWS rows of the
# anchor or of a right table. At most 1 / HOT_SHARE + rows / HOT_ROWS keys are hot, which bounds
# the broadcast table of hot keys (some 200,000 keys for 10^12 rows).
HOT_SHARE = 0.05
HOT_ROWS = 5_000_000
SALT_BUCKETS = 32


def hot_keys(df: DataFrame, keys: Sequence[str], share: float | None = HOT_SHARE,
             rows: int = HOT_ROWS, least: int = SALT_BUCKETS) -> DataFrame:
    """Key tuples holding at least ``rows`` rows or ``share`` of them (null keys included): a
    partial aggregate per key, then a filter. A share counts from ``least`` rows on: in a small table
    every key holds a large share, and rows that do not fill the salts are not worth copying the
    matching rows of a right table to each."""
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__c"))
    hot = F.col("__c") >= F.lit(rows)
    if share is not None:
        # The total comes from the same per-key counts, so Spark computes the shuffle once and
        # reuses it for the scalar subquery.
        total = counts.agg(F.sum("__c")).scalar()
        hot = hot | ((F.col("__c") >= F.lit(least)) & (F.col("__c") >= F.lit(share) * total))
    return counts.filter(hot).select(*[col(k) for k in keys])


def _flag_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    renamed = {k: f"__hk_{i}" for i, k in enumerate(keys)}
    h = hot.select(*[col(k).alias(renamed[k]) for k in keys], F.lit(True).alias("__hot"))
    cond = reduce(lambda a, b: a & b, [df[_q(k)].eqNullSafe(h[renamed[k]]) for k in keys])
    return df.join(F.broadcast(h), cond, "left").drop(*renamed.values())


def salt_rows(df: DataFrame, keys: Sequence[str], hot: DataFrame, buckets: int,
              name: str = "__salt") -> DataFrame:
    """Spread the rows of hot keys over ``buckets`` salt values (a hash of the whole row, so a
    re-run task assigns the same salt); other rows get salt 0."""
    cols = [col(c) for c in df.columns]
    f = _flag_hot(df, keys, hot)
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*cols), F.lit(buckets))).otherwise(F.lit(0))
    return f.withColumn(name, salt.cast("int")).drop("__hot")


def _all_salts(buckets: int) -> Column:
    return F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(
        F.array(F.lit(0))))


def replicate_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame, buckets: int) -> DataFrame:
    """Copy the rows of hot keys to every salt value so each salted piece finds its match."""
    return _flag_hot(df, keys, hot).withColumn("__salt", _all_salts(buckets)).drop("__hot")


def join_right_hot(left: DataFrame, right: DataFrame, on: Sequence[str], keys: Sequence[str],
                   hot: DataFrame, buckets: int, null_safe: bool = False) -> DataFrame:
    """``join_left`` with a right table in which some keys are hot.

    The right rows of a hot key are spread over the salts and the left rows of that key are
    copied to each. A hot key stands in the right table, so every such left row has a match; its
    copies that meet none belong to a salt without right rows and go.
    """
    copies = _flag_hot(left, keys, hot).withColumn("__rsalt", _all_salts(buckets))
    spread = salt_rows(right, keys, hot, buckets, "__rsalt").withColumn("__met", F.lit(True))
    j = join_left(copies, spread, [*on, "__rsalt"], null_safe)
    return j.filter(F.col("__hot").isNull() | F.col("__met")).drop("__hot", "__met", "__rsalt")


def pack_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The columns as one struct in place of ``name``, which tells whether the row has them. Every join
    of a long chain writes the running row anew: structs are copied whole, plain columns one by one,
    absent ones included."""
    packed = F.when(F.col(name), F.struct(*[col(c) for c in columns])).alias(name)
    return df.select(*[col(c) for c in df.columns if c != name and c not in columns], packed)


def unpack_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fields of the named structs as columns, in place; those of a missing struct are null."""
    out = []
    for f in df.schema.fields:
        out += ([col(f.name).getField(x).alias(x) for x in f.dataType.names] if f.name in names else [col(f.name)])
    return df.select(*out)


def wide_join(tables: Sequence[DataFrame] | Mapping[str, DataFrame], keys: Sequence[str],
              null_safe: bool = False, unique_right: bool = False, strategy: str = "chain",
              joins_per_stage: int = JOINS_PER_STAGE, hot_share: float | None = HOT_SHARE,
              salt_buckets: int = SALT_BUCKETS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Wide table of the report tables on the keys; the first table is the anchor.

    ``strategy="chain"`` folds ``join_left`` over the tables (exact left-join semantics,
    duplicate right keys repeat rows). Anchor keys holding ``hot_rows`` rows or ``hot_share`` of
    them are salted: their rows are spread over ``salt_buckets`` partitions and the matching right
    rows are copied to each, so no single task carries a hot key through the whole chain. Keys
    with ``hot_rows`` rows of a right table are spread in that table's join (``join_right_hot``).
    ``hot_share=None`` turns both off, ``unique_right`` the second; without a hot key the plan is
    the plain chain. ``strategy="merge"`` is for keyed report tables (at
    most one row per key in every table): all tables are unioned and grouped once by the
    keys, one shuffle and one aggregate however many tables there are; a repeated key stops
    the job with an error instead of giving a different answer.
    """
    frames = list(tables.values()) if isinstance(tables, Mapping) else list(tables)
    if not frames:
        raise ValueError("wide_join needs at least one table")
    check_case_clash(frames[0].columns)
    if strategy == "merge":
        return wide_merge(frames, keys, null_safe=null_safe)
    if strategy != "chain":
        raise ValueError(f"unknown strategy {strategy!r}")
    acc, join_keys = frames[0], list(keys)
    hot = None
    if hot_share is not None and not 0 < hot_share <= 1:
        raise ValueError("hot_share must be in (0, 1]")
    checkpoint_dir(acc.sparkSession)
    if hot_share is not None and len(frames) > 1:
        check_keys(acc, keys)
        # A job over the keys finds the hot ones. Salting costs a shuffle on (keys, salt) per
        # table, so it is planned only when a hot key exists.
        found = hot_keys(acc, keys, hot_share, hot_rows, salt_buckets).checkpoint()
        if not found.isEmpty():
            hot = found
            acc = salt_rows(acc, keys, hot, salt_buckets)
            join_keys = list(keys) + ["__salt"]
    names = list(acc.columns)
    pack = len(frames) - 1 > JOINS_PER_STAGE and not unique_right
    for i, t in enumerate(frames[1:]):
        check_keys(t, keys)
        add = new_columns(t.columns, names, keys)
        check_case_clash(names + add)
        names += add
        if pack:
            t = t.select(*[col(c) for c in [*keys, *add]], F.lit(True).alias(f"__r{i}"))
        if i and joins_per_stage and i % joins_per_stage == 0:
            acc = acc.checkpoint(eager=True)
        right_hot = None
        if hot_share is not None and not unique_right:
            found = hot_keys(t, keys, None, hot_rows)
            if not null_safe:  # a null key meets no row
                found = found.dropna()
            found = found.checkpoint()
            right_hot = None if found.isEmpty() else found
        if hot is not None:
            t = replicate_hot(t, keys, hot, salt_buckets)
        if right_hot is not None:
            acc = join_right_hot(acc, t, join_keys, keys, right_hot, salt_buckets, null_safe)
        else:
            acc = join_left(acc, t, join_keys, null_safe, unique_right)
        if pack:
            acc = pack_columns(acc, add, f"__r{i}") if add else acc.drop(f"__r{i}")
    acc = acc.drop("__salt") if hot is not None else acc
    return unpack_columns(acc, [f"__r{i}" for i in range(len(frames) - 1)]) if pack else acc


def wide_merge(frames: Sequence[DataFrame], keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Wide join of tables that are unique on the keys as one union + group-by.

    Every table contributes its new columns (the anchor all of its columns) and nulls for the
    rest; grouping by the keys puts each key's pieces side by side. Only keys present in the
    anchor are kept (left-join semantics). Per-table row counts are checked in the same
    aggregate: a table holding a key twice raises an error at run time.
    """
    for f in frames:
        check_keys(f, keys)
    anchor = frames[0]
    plan: list[list[str]] = [[c for c in anchor.columns if c not in keys]]
    have = set(anchor.columns)
    for t in frames[1:]:
        add = new_columns(t.columns, list(have), keys)
        plan.append(add)
        have |= set(add)
    out_cols = [c for cols in plan for c in cols]
    check_case_clash(list(keys) + out_cols)
    types = {}
    for f, cols in zip(frames, plan):
        for c in cols:
            types[c] = f.schema[c].dataType
    parts = []
    for i, (f, cols) in enumerate(zip(frames, plan)):
        mine = set(cols)
        part = f.select(*[col(k) for k in keys], F.lit(i).alias("__t"),
                        *[(col(c) if c in mine else F.lit(None).cast(types[c])).alias(c)
                          for c in out_cols])
        if i and not null_safe:
            # plain equality never matches a null key
            part = part.filter(reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys]))
        parts.append(part)
    u = reduce(DataFrame.unionByName, parts)
    aggs = [F.count_if(F.col("__t") == i).alias(f"__n{i}") for i in range(len(frames))]
    aggs += [F.first(col(c), ignorenulls=True).alias(c) for c in out_cols]
    g = u.groupBy(*[col(k) for k in keys]).agg(*aggs).filter(F.col("__n0") > 0)
    too_many = reduce(lambda a, b: a | b, [F.col(f"__n{i}") > 1 for i in range(len(frames))])
    check = F.when(too_many, F.raise_error(F.lit(
        "wide_merge: a table holds a key more than once; use strategy='chain'")))
    return g.filter(check.isNull()).select(*[col(k) for k in keys], *[col(c) for c in out_cols])
