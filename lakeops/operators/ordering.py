"""Sorts, ordinals, ranks inside groups, top-n and pages.

A row number over the whole output (or a running value over a group that may hold a third of all rows) must
not pull the rows into one task.

* The ordinal in the order of named columns takes bounds from the data once: some rows drawn at random are sorted, and
  every few of them one becomes a bound. From then on a row's piece is a function of the row: the number of bounds
  that are not after it. Counts per piece give each piece its offset, a window its rows their places. Nothing is
  stored, and whatever the bounds are, the result is the same; they only decide how even the pieces are.
* The running aggregates, and the ordinal in the order of expressions, range-sort the rows once, which spreads a hot
  group over many partitions, and checkpoint the sorted rows together with the number of their piece. From then on
  the piece is data: rows, counts per piece and carries from earlier pieces all read the same stored rows, so no
  result depends on how often or in how many tasks Spark sorts.

The table of pieces has a few rows per partition; it is the only thing broadcast.
The order given must be total (add a unique column as the last key) if positions among equal rows matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import ensure_checkpoint_dir

_PID = "_lk_piece"
_MID = "_lk_place"


#: A name, a name with "desc", or any expression to sort by.
Order = str | tuple[str, str] | Column


def _cols(items: Sequence[Order]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else F.col(c[0]).desc() if isinstance(c, tuple) else c for c in items]


def _named(order: Sequence[Order]) -> list[tuple[str, bool]] | None:
    """(name, descending) of every item; None if one is an expression."""
    if any(isinstance(c, tuple) and c[1:] != ("desc",) for c in order):
        raise ValueError('an order is a name, (name, "desc") or an expression')
    return None if any(isinstance(c, Column) for c in order) else [(c, False) if isinstance(c, str) else (c[0], True) for c in order]


def _sorted_pieces(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in ``order`` with the number of the sorted piece a row is in and its place there, stored once."""
    ensure_checkpoint_dir(df.sparkSession)
    s = df.sort(*order).withColumn(_MID, F.monotonically_increasing_id())
    s = s.withColumn(_PID, F.shiftright(F.col(_MID), 33))
    return s.withColumn(_MID, F.col(_MID) - F.shiftleft(F.col(_PID), 33)).checkpoint()


#: Pieces for each shuffle partition (so that a partition gets several, and evens them out), rows drawn for each piece,
#: and the most pieces.
PIECES_EACH, DRAWN, MOST_PIECES = 4, 16, 4096


def draw_bounds(df: DataFrame, order: Sequence[tuple[str, bool]], pieces: int) -> list[tuple]:
    """Up to ``pieces - 1`` bounds in order: of ``DRAWN`` rows a piece, drawn at random in one pass (each task keeps
    that many) and sorted, every so many-th. All bounds are different."""
    names = [name for name, _ in order]
    drawn = df.select(*names).orderBy(F.rand(17)).limit(DRAWN * pieces)
    rows = [tuple(r) for r in drawn.orderBy(*[F.col(n).desc() if down else F.col(n).asc() for n, down in order]).collect()]
    picked = [rows[i * len(rows) // pieces] for i in range(1, pieces)] if rows else []
    return [b for i, b in enumerate(picked) if i == 0 or b != picked[i - 1]]


def piece_of(df: DataFrame, order: Sequence[tuple[str, bool]], bounds: Sequence[tuple]) -> Column:
    """The number of bounds that a row is not before. Bounds are looked up in two steps, among every so many-th and then
    among those from there on, so a row is compared with about twice the root of their number."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def before(bound: Column) -> Column:
        out, equal = F.lit(False), F.lit(True)
        for i, (name, down) in enumerate(order):
            row, at = F.col(name), bound[f"k{i}"]
            # Nulls come first in a rising order, last in a falling one.
            less = F.coalesce(row > at, row.isNotNull() & at.isNull()) if down else F.coalesce(row < at, row.isNull() & at.isNotNull())
            out, equal = out | (equal & less), equal & row.eqNullSafe(at)
        return out

    literal = lambda rows: F.array(*[F.struct(*[F.lit(v).cast(kinds[name]).alias(f"k{i}") for i, ((name, _), v) in enumerate(zip(order, row))]) for row in rows])
    passed = lambda rows: F.size(F.filter(rows, lambda bound: ~before(bound)))
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    group = passed(literal([g[0] for g in groups]))
    inside = passed(F.element_at(F.array(*[literal(g) for g in groups]), F.greatest(group, F.lit(1))))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + inside)


def with_ordinal(df: DataFrame, order: Sequence[Order], name: str = "ordinal", bounds: Sequence[tuple] | None = None) -> DataFrame:
    """1-based position of every row in ``order`` over the whole DataFrame. In the order of named columns the rows are
    dealt by ``bounds`` (drawn from ``df`` if not given), so ``df`` must give the same rows whenever it is read; in the
    order of expressions they are sorted and stored."""
    named = _named(order)
    if named is None:
        s = _sorted_pieces(df, _cols(order))
        place = F.col(_MID) + F.lit(1)
    else:
        if bounds is None:
            pieces = min(MOST_PIECES, PIECES_EACH * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            bounds = draw_bounds(df, named, pieces)
        s = df.withColumn(_PID, piece_of(df, named, bounds))
        place = F.row_number().over(Window.partitionBy(_PID).orderBy(*_cols(order))).cast("long")
    counts = s.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # One row per piece: small by construction, so the broadcast is bounded.
    offsets = counts.select(F.col(_PID).alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    placed = s.withColumn(_MID, place)
    out = placed.join(F.broadcast(offsets), F.col(_PID) == F.col("_of")).withColumn(name, F.col("_off") + F.col(_MID))
    return out.drop(_PID, _MID, "_of", "_off")


RUNNING_KINDS = ("sum", "min", "last")


def with_group_running(df: DataFrame, group: Sequence[str], order: Sequence[Order],
                       aggs: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Running aggregates inside groups, from the first row of the group to the current row in
    ``order`` (a window frame ``unboundedPreceding .. currentRow``), safe for hot groups.

    ``aggs`` holds ``(name, kind, column)`` with kind ``sum``, ``min`` or ``last`` (the last non-null
    value). The range sort splits a hot group over several pieces; a window keyed by (piece, group) runs
    over each, and a carry table brings in the earlier pieces of the same group. Only the first group of a
    piece has earlier pieces, so the carry table has at most one row per piece and is the only thing
    broadcast."""
    group = list(group)
    kinds = {name: kind for name, kind, _ in aggs}
    if any(k not in RUNNING_KINDS for k in kinds.values()):
        raise ValueError(f"kinds must be among {RUNNING_KINDS}")
    # The aggregated values are computed once, before the sort, and stored with the rows.
    s = df.select("*", *[c.alias(f"_v_{n}") for n, _, c in aggs])
    s = _sorted_pieces(s, [*_cols(group), *_cols(order)])
    aggs = [(n, k, F.col(f"_v_{n}")) for n, k, _ in aggs]
    upto = (Window.partitionBy(_PID, *group).orderBy(_MID)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local_fns = {"sum": lambda c: F.sum(c), "min": lambda c: F.min(c),
                 "last": lambda c: F.last(c, ignorenulls=True)}
    local = s.select("*", *[local_fns[k](c).over(upto).alias(f"_l_{n}") for n, k, c in aggs])
    piece_fns = {"sum": lambda c: F.sum(c), "min": lambda c: F.min(c),
                 "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(_MID)))}
    pieces = s.groupBy(_PID, *group).agg(*[piece_fns[k](c).alias(f"_p_{n}") for n, k, c in aggs])
    earlier = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry_fns = {"sum": lambda c: F.sum(c), "min": lambda c: F.min(c),
                 "last": lambda c: F.last(c, ignorenulls=True)}
    carry = (pieces.select(F.col(_PID).alias("_c_pid"), *[F.col(g).alias(f"_c_{g}") for g in group],
                           F.count(F.lit(1)).over(earlier).alias("_c_before"),
                           *[carry_fns[k](F.col(f"_p_{n}")).over(earlier).alias(f"_c_{n}") for n, k, _ in aggs])
             .where(F.col("_c_before") > 0))
    cond = reduce(lambda a, b: a & b,
                  [local[_PID] == carry["_c_pid"]] + [local[g].eqNullSafe(carry[f"_c_{g}"]) for g in group])
    out = local.join(F.broadcast(carry), cond, "left")
    for name, kind, _ in aggs:
        lv, cv = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            value = F.when(lv.isNull() & cv.isNull(), F.lit(None)).otherwise(
                F.coalesce(lv, F.lit(0)) + F.coalesce(cv, F.lit(0)))
        elif kind == "min":
            value = F.least(lv, cv)
        else:
            value = F.coalesce(lv, cv)
        out = out.withColumn(name, value)
    helpers = [_PID, _MID, "_c_pid", "_c_before", *[f"_c_{g}" for g in group]]
    helpers += [f"_{x}_{n}" for n, _, _ in aggs for x in ("l", "c", "v")]
    return out.drop(*helpers)


def with_group_row_number(df: DataFrame, group: Sequence[str], order: Sequence[Order],
                          name: str = "rn") -> DataFrame:
    """``row_number()`` over ``partitionBy(group).orderBy(order)``, safe for hot groups: a running
    count (see :func:`with_group_running`)."""
    return with_group_running(df, group, order, [(name, "sum", F.lit(1))])


#: Up to this many rows a group, Spark cuts groups before the shuffle (its own limit for the partial step).
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def first_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Order], n: int, name: str = "rn") -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1 (``name``). Every task keeps at most ``n`` rows
    a group before the shuffle (the planner's group limit), so a group with a third of all rows is ``n`` rows a task;
    no row is numbered that is not kept. Beyond the planner's limit the rows are numbered by
    :func:`with_group_row_number`, which spreads hot groups."""
    _check_positive("n", n)
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT_CONF)):
        return with_group_row_number(df, group, order, name).where(F.col(name) <= F.lit(n))
    place = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(place)).where(F.col(name) <= F.lit(n))


DEEP_PAGE_ROWS = 100_000


def top_n(df: DataFrame, order: Sequence[Order], n: int, name: str = "rank",
          deep_page_rows: int | None = None) -> DataFrame:
    """The first ``n`` rows in ``order`` with their rank: a per-partition top-n, then one merge of
    ``n x partitions`` rows (Spark's TakeOrderedAndProject). Beyond ``deep_page_rows`` the rows are cut
    from the global ordinal instead, so no task holds ``n`` rows."""
    _check_positive("n", n)
    if n > (DEEP_PAGE_ROWS if deep_page_rows is None else deep_page_rows):
        return with_ordinal(df, order, name).where(F.col(name) <= F.lit(n))
    top = df.orderBy(*_cols(order)).limit(n)
    w = Window.orderBy(*_cols(order))
    return top.withColumn(name, F.row_number().over(w).cast("long"))


def page_slice(df: DataFrame, order: Sequence[Order], page: int = 1, per_page: int = 10,
               name: str = "position", deep_page_rows: int = DEEP_PAGE_ROWS) -> DataFrame:
    """Rows ``(page-1)*per_page + 1 .. page*per_page`` in ``order`` with their position.

    Early pages are a per-partition top-n (``offset + limit``). A page beyond ``deep_page_rows`` would
    make every task keep that many rows, so it is cut from the global ordinal instead (a range sort;
    the order must then be total)."""
    _check_positive("page", page)
    if not 1 <= per_page <= 50:
        raise ValueError("per_page must be between 1 and 50")
    start = (page - 1) * per_page
    if start + per_page > deep_page_rows:
        numbered = with_ordinal(df, order, name)
        return numbered.where((F.col(name) > F.lit(start)) & (F.col(name) <= F.lit(start + per_page)))
    sliced = df.orderBy(*_cols(order)).offset(start).limit(per_page)
    w = Window.orderBy(*_cols(order))
    return sliced.withColumn(name, (F.row_number().over(w) + F.lit(start)).cast("long"))


def page_count(total: Column, per_page: int) -> Column:
    if not 1 <= per_page <= 50:
        raise ValueError("per_page must be between 1 and 50")
    return F.ceil(total / F.lit(per_page)).cast("long")


def _check_positive(label: str, value: int) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or value < 1:
        raise ValueError(f"{label} must be a positive integer, got {value!r}")
