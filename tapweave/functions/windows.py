"""Row windows that survive a hot key.

``sliced_window`` gives exactly what plain windows over ``keys`` give, with one
read of its input and one shuffle. Without ``hot`` it is the plain window. The
groups named by ``hot`` (see ``hot_groups``), of which there are few, are cut into
slices. Where they are cut is told by a small table that is made and written
first, from the rows of these groups alone: it also holds the places of the
``reach`` rows before and after every slice, so that each row knows all slices
that have to see it and goes to them in the same shuffle. Rows that a slice only
sees are dropped after the window.

Cuts are rows drawn by a hash, given by their whole order: rows without a time and
rows at one time are cut like others. The hash of the whole row ends the order of
hot groups, so only identical rows stay together. The table has at most about four
rows for every ``rows`` input rows, which bounds its broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapweave.functions.stage import stage

GROUP_ROWS = 1_000_000
# Classes of keys that ``hot_groups`` counts first.
KEY_CLASSES = 4096

_SLICE, _OWN, _TIE, _CUTS, _REST = "__slice", "__own", "__tie", "__cuts", "__rest"

Columns = Callable[[WindowSpec], Mapping[str, Column]]


def left_lookup(df: DataFrame, keys: Sequence[str], table: DataFrame) -> DataFrame:
    """Left join of ``table`` (unique on ``keys``) where null keys match too."""
    return _null_safe(df, keys, table, "left")


def keep_matching(df: DataFrame, keys: Sequence[str], table: DataFrame) -> DataFrame:
    """Rows whose keys occur in ``table``, null keys too."""
    return _null_safe(df, keys, table, "left_semi")


def _null_safe(df: DataFrame, keys: Sequence[str], table: DataFrame, how: str) -> DataFrame:
    named = {k: f"__k_{k}" for k in keys}
    table = table.withColumnsRenamed(named)
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(v)) for k, v in named.items()))
    joined = df.join(table, on, how)
    return joined if how == "left_semi" else joined.drop(*named.values())


def hot_groups(df: DataFrame, keys: Sequence[str], rows: int = GROUP_ROWS) -> DataFrame | None:
    """Keys of more than ``rows`` rows, or None where there are none.

    They are counted at once, from the key columns of a written or given table, combined
    ahead of the shuffle; there is at most one for every ``rows`` rows. Classes of keys are
    counted first: where no class has more rows, no key has, and nothing else is moved.
    """
    classes = df.groupBy(F.pmod(F.hash(*keys), F.lit(KEY_CLASSES)).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    if classes.where(F.col("__n") > rows).isEmpty():
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
    hot = stage(counts.drop("__n"), "hot")
    return None if hot.isEmpty() else hot


def _tie(df: DataFrame) -> Column:
    return F.xxhash64(*df.columns)


def cut_table(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], reach: int, rows: int, hot: DataFrame
) -> DataFrame:
    """``keys`` and ``__cuts`` of the hot groups: the slices with the places where they begin and end, and between which they see rows."""
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], _tie(df).alias("tie"))
    placed = keep_matching(df, keys, F.broadcast(hot)).select(*keys, place.alias("__p"))
    drawn = placed.where(F.pmod("__p.tie", F.lit(max(1, rows // 2))) == 0)
    points = drawn.groupBy(*keys).agg(F.sort_array(F.collect_set("__p")).alias("__points"))
    cut = left_lookup(placed, keys, F.broadcast(points)).withColumn(
        "__part", F.coalesce(F.size(F.filter("__points", lambda p: p <= F.col("__p"))), F.lit(0))
    ).drop("__points")
    inner = Window.partitionBy(*keys, "__part").orderBy("__p")
    size = F.count(F.lit(1)).over(inner.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    at = F.row_number().over(inner)
    # a few rows of every slice; the rows around a cut are among them, however thin slices are
    near = max(1, reach)
    borders = cut.withColumns({"__at": at, "__size": size}).where((F.col("__at") <= near) | (F.col("__size") - F.col("__at") < near))
    over = Window.partitionBy(*keys).orderBy("__p")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = borders.withColumns(
        {
            "__low": F.coalesce(F.lag("__p", reach).over(over), F.min("__p").over(whole)),
            "__high": F.coalesce(F.lead("__p", reach).over(over), F.max("__p").over(whole)),
        }
    )
    slices = seen.groupBy(*keys, "__part").agg(
        F.min("__p").alias("first"), F.max("__p").alias("last"),
        F.min_by("__low", "__p").alias("low"), F.max_by("__high", "__p").alias("high"),
    )
    return slices.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col("__part").alias("slice"), "first", "last", "low", "high")).alias(_CUTS)
    )


def _shown(df: DataFrame, order: Sequence[Column], joined: DataFrame) -> DataFrame:
    """Every row once for each slice that sees it, with ``__slice``, ``__own`` and ``__tie``."""
    is_hot = F.col(_CUTS).isNotNull()
    tied = joined.withColumn(_TIE, F.when(is_hot, _tie(df)).otherwise(F.lit(0).cast("long")))
    here = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(_TIE).alias("tie"))
    seeing = F.filter(_CUTS, lambda c: (c["low"] <= here) & (here <= c["high"]))
    views = F.transform(
        seeing, lambda c: F.struct(c["slice"].alias(_SLICE), ((c["first"] <= here) & (here <= c["last"])).alias(_OWN))
    )
    alone = F.array(F.struct(F.lit(0).alias(_SLICE), F.lit(True).alias(_OWN)))
    return tied.select("*", F.inline(F.when(is_hot, views).otherwise(alone))).drop(_CUTS)


def sliced_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    reach: int,
    steps: Sequence[Columns],
    sums: Mapping[str, Column] | None = None,
    hot: DataFrame | None = None,
    rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add window columns over ``keys`` in the order of ``order``.

    Each of ``steps`` may use the columns of those before; together they look at
    most ``reach`` rows back or ahead. ``sums`` are running sums over the group, up
    to and including the row, of expressions over all of these columns. ``hot`` are
    the keys to cut into slices of about ``rows`` rows; a key too many does no harm.
    """
    sums = dict(sums or {})
    if hot is None:
        plain = Window.partitionBy(*keys).orderBy(*order)
        out = _stepped(df, steps, plain)
        upto = plain.rowsBetween(Window.unboundedPreceding, 0)
        return out.withColumns({n: F.sum(v).over(upto) for n, v in sums.items()}) if sums else out

    cuts = F.broadcast(stage(cut_table(df, keys, order, reach, rows, hot), "cuts"))
    inner = Window.partitionBy(*keys, _SLICE).orderBy(*order, _TIE)
    out = _stepped(_shown(df, order, left_lookup(df, keys, cuts)), steps, inner)
    if not sums:
        return out.where(F.col(_OWN)).drop(_SLICE, _OWN, _TIE)

    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # what the slices before sum up to: one row per slice of a hot group
    of_hot = _stepped(_shown(df, order, _null_safe(df, keys, cuts, "inner")), steps, inner).where(F.col(_OWN))
    carried = of_hot.groupBy(*keys, _SLICE).agg(*[F.sum(v).alias(f"__c_{n}") for n, v in sums.items()])
    carried = carried.select(*keys, _SLICE, *[F.sum(f"__c_{n}").over(before).alias(f"__b_{n}") for n in sums])
    out = out.withColumns({f"__s_{n}": F.sum(F.when(F.col(_OWN), v)).over(upto) for n, v in sums.items()})
    out = left_lookup(out.where(F.col(_OWN)), [*keys, _SLICE], F.broadcast(stage(carried, "carried")))
    totals = {n: F.col(f"__s_{n}") + F.coalesce(F.col(f"__b_{n}"), F.lit(0)) for n in sums}
    return out.withColumns(totals).drop(_SLICE, _OWN, _TIE, *[f"__{x}_{n}" for n in sums for x in "sb"])


def _stepped(df: DataFrame, steps: Sequence[Columns], window: WindowSpec) -> DataFrame:
    for columns in steps:
        df = df.withColumns(dict(columns(window)))
    return df


def over_narrow(df: DataFrame, keep: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step(df)`` for a step that reads and changes no column beside ``keep``; all others go through it in one struct.

    A window writes every row once for its buffer and once more with its result, and a sort moves it too;
    one struct is moved as a whole, where columns are written one by one. The columns keep their order,
    those that the step adds follow. For rows that keep their columns: Spark cannot leave single ones out of the struct.
    """
    kept = {c.lower() for c in keep}  # names are not case-sensitive
    rest = [c for c in df.columns if c.lower() not in kept]
    if not rest:
        return step(df)
    out = step(df.select(*[c for c in df.columns if c not in rest], F.struct(*rest).alias(_REST)))
    there = {c.lower() for c in [*out.columns, *rest]}
    known = [F.col(f"{_REST}.{c}").alias(c) if c in rest else F.col(c) for c in df.columns if c.lower() in there]
    before = {c.lower() for c in [*df.columns, _REST]}
    return out.select(*known, *[c for c in out.columns if c.lower() not in before])


def near_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], reach: int, columns: Columns,
    hot: DataFrame | None = None, rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``reach`` rows back or ahead."""
    return sliced_window(df, keys, order, reach, [columns], None, hot, rows)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str,
    hot: DataFrame | None = None, rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the sum of ``value`` over the group's rows up to and including this one."""
    return sliced_window(df, keys, order, 0, [], {name: value}, hot, rows)
