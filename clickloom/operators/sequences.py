"""Alerts and event sequences in key and time order, for tables.

``order`` columns start with the time and end with something unique, so that every key's rows have
one order. Durations compare with ``<`` where a pattern must end within a span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordered import HOT_ROWS, Ordered, over_preceding, running
from clickloom.operators.topn import top_n_per_group
from clickloom.session import checkpointed
from clickloom.times import interval, micros, position

# Longest chain of failures that is folded as one array.
FOLD_ROWS = 1_000
# The setting that names the ranks up to which the optimizer limits groups before the shuffle.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def rolling_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    folds: dict[str, tuple[str, Column]],
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each record with the running sums, minima or maxima of its key so far."""
    return running(df, keys, order, folds, max_rows=max_rows)


def jump_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, threshold: float, max_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Rows whose value is more than ``threshold`` away from the key's previous one."""
    seen = over_preceding(df, keys, order, 1, lambda w: {"previous": F.lag(val).over(w)}, max_rows=max_rows)
    return seen.filter(F.abs(F.col(val) - F.col("previous")) > threshold)


def rise_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, span: str, max_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Alerts when a key's value has not fallen for ``span`` since it rose.

    A rise arms a timer, if none is armed; a fall up to its end clears it. The timer fires ``span``
    after the rise, whether or not another reading comes, and the next rise behind it arms it again.
    ``start_ts`` is the rise and ``alert_ts`` the moment of the alert. The first reading is no rise, and
    one beside a missing value is neither rise nor fall.
    """
    rest = [c for c in order if c not in keys]
    ordered = Ordered.of(df.select(*keys, *rest, val), keys, order, max_rows)
    seen = ordered.look_back(1, lambda w: {"_prev": F.lag(val).over(w)}).table()
    moved = seen.filter(F.col(val) != F.col("_prev")).select(*keys, *rest, (F.col(val) > F.col("_prev")).alias("_rise"))
    # A window of rises that no fall clears is a timer that fires. Where no key was hot none of its moves is.
    fired = burst_alert(moved, keys, order, F.col("_rise"), 1, span, max_rows if ordered.split else None)
    return fired.select(*keys, "start_ts", (F.col("start_ts") + interval(micros(span))).alias("alert_ts"))


def strict_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Column],
    within: str,
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Consecutive rows of a key that meet the steps in turn, the last within the span of the first.

    The result has the keys and, per step, a struct ``step_1``, ``step_2``, ... of the row.
    """
    ts = order[0]
    rest = [c for c in df.columns if c not in keys]
    count = len(steps)
    tagged = df.withColumns({f"_is_{i}": F.coalesce(s, F.lit(False)) for i, s in enumerate(steps)})
    # Looking back from the last step: row i of the pattern lies count-1-i rows earlier.
    seen = over_preceding(
        tagged.withColumn("_row", F.struct(*rest)),
        keys,
        order,
        count - 1,
        lambda w: {
            f"step_{i + 1}": F.lag(F.when(F.col(f"_is_{i}"), F.col("_row")), count - 1 - i).over(w)
            for i in range(count)
        },
        max_rows=max_rows,
    )
    found = F.col("step_1").isNotNull()
    for i in range(1, count):
        found = found & F.col(f"step_{i + 1}").isNotNull()
    close = F.col(f"step_{count}")[ts] < F.col("step_1")[ts] + interval(micros(within))
    return seen.filter(found & close).select(*keys, *[f"step_{i + 1}" for i in range(count)])


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Column,
    then: Column,
    within: str,
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Each row that is ``first`` with the next row of its key that is ``then``, other rows skipped.

    ``first_row`` and ``then_row`` are structs; ``then_row`` is null when none came within the span,
    which is a timeout. A ``then`` without a ``first`` before it gives nothing.
    """
    ts = order[0]
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    row = F.struct(*rest)
    slim = df.withColumns({"_first": F.coalesce(first, F.lit(False)), "_then": F.coalesce(then, F.lit(False))})
    slim = slim.filter(F.col("_first") | F.col("_then"))
    # The next row is the least one behind, since a struct compares by its order columns first.
    seen = running(
        slim,
        keys,
        order,
        {"then_row": ("min", F.when(F.col("_then"), row))},
        reverse=True,
        inclusive=False,
        max_rows=max_rows,
    )
    in_time = F.col("then_row")[ts] < F.col(ts) + interval(micros(within))
    return seen.filter(F.col("_first")).select(
        *keys, row.alias("first_row"), F.when(in_time, F.col("then_row")).alias("then_row")
    )


def marker_watermark(
    df: DataFrame, order: Sequence[str], ts: str, marker: Column, delay: str, max_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add the watermark that only marker rows advance, and whether a row came too late.

    ``order`` is the order of arrival; ``watermark`` is the greatest marker time so far less the
    delay, null before the first marker.
    """
    seen = running(df, [], order, {"_top": ("max", F.when(marker, F.col(ts)))}, max_rows=max_rows)
    seen = seen.withColumn("watermark", F.col("_top") - interval(micros(delay))).drop("_top")
    return seen.withColumn("late", F.coalesce(F.col(ts) <= F.col("watermark"), F.lit(False)))


def daily_cap(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cap: int, max_rows: int | None = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(passed, alerts): the first ``cap`` rows per key and day, and the one row that broke the cap.

    Only the first ``cap + 1`` rows of a key and day matter. Up to the optimizer's limit of ranks, that is
    all each task passes on; for higher caps rows are numbered with hot keys split.
    """
    day = F.date_trunc("day", F.col(order[0])).cast(df.schema[order[0]].dataType)
    dated, group = df.withColumn("day", day), [*keys, "day"]
    if cap < int(df.sparkSession.conf.get(GROUP_LIMIT)):
        first = top_n_per_group(dated, group, [F.col(c) for c in order], cap + 1, rank="_nth")
    else:
        first = running(dated, group, order, {"_nth": ("sum", F.lit(1))}, max_rows=max_rows)
    passed = first.filter(F.col("_nth") <= cap).drop("_nth", "day")
    alerts = first.filter(F.col("_nth") == cap + 1).drop("_nth")
    return passed, alerts


def burst_alert(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    is_fail: Column,
    n: int,
    span: str,
    max_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Windows of ``span`` from a key's failure on, with at least ``n`` failures and no success.

    A window opens at the first failure after a success or after the last window closed; a success
    up to its end clears it. The result has the keys, the opening failure's time and the count.

    Failures with no success between them and gaps of at most ``span`` form a chain. A chain always
    opens a window at its start, so chains are independent. One no longer than the span is one
    window. A longer one is folded row by row, or, above ``FOLD_ROWS``, by ``_greedy_windows``.
    """
    ts, us = order[0], micros(span)
    rest = [c for c in order if c not in keys]
    slim = df.select(*keys, *rest, position(df, ts).alias("_us"), F.coalesce(is_fail, F.lit(False)).alias("_fail"))
    success = F.when(~F.col("_fail"), F.col("_us"))
    opens = F.col("_last").isNull() | (F.col("_us") - F.col("_last") > us)
    chained = (
        Ordered.of(slim, keys, order, max_rows)
        .running({"_ok": ("min", success)}, reverse=True, inclusive=False)
        .look_back(1, lambda w: {"_last": F.lag(F.when(F.col("_fail"), F.col("_us"))).over(w)})
        .filter("_fail")
        .running({"_chain": ("sum", opens.cast("long"))})
        .table()
    )
    # Failures of the same time are one node with a count; a chain has one success behind it.
    nodes = checkpointed(
        chained.groupBy(*keys, "_chain", "_us").agg(
            F.count("*").alias("_n"), F.min(ts).alias("start_ts"), F.min("_ok").alias("_ok")
        )
    )
    chain = [*keys, "_chain"]
    chains = nodes.groupBy(*chain).agg(
        F.sum("_n").alias("n_fails"),
        F.min("start_ts").alias("start_ts"),
        F.min("_us").alias("_us"),
        F.max("_us").alias("_end"),
        F.min("_ok").alias("_ok"),
        F.count("*").alias("_nodes"),
    )
    alert = (F.col("n_fails") >= n) & (F.col("_ok").isNull() | (F.col("_ok") > F.col("_us") + us))
    result = [*keys, "start_ts", "n_fails"]
    is_long = F.col("_end") - F.col("_us") > us
    short = chains.filter(~is_long).filter(alert).select(*result)
    long_chains = chains.filter(is_long).select(*chain, "_nodes")
    few = nodes.join(long_chains.filter(F.col("_nodes") <= FOLD_ROWS), chain, "left_semi")
    found = short.unionByName(_folded_windows(few, chain, us).filter(alert).select(*result))
    many_chains = long_chains.filter(F.col("_nodes") > FOLD_ROWS)
    if many_chains.isEmpty():
        return found
    many = nodes.join(many_chains, chain, "left_semi")
    return found.unionByName(_greedy_windows(many, chain, us, max_rows).filter(alert).select(*result))


def _folded_windows(nodes: DataFrame, group: list[str], us: int) -> DataFrame:
    """As ``_greedy_windows``, for groups small enough to be one array each."""
    row = F.struct("_us", "start_ts", "_ok", F.col("_n").alias("n_fails"))
    arrays = nodes.groupBy(*group).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    kind = arrays.schema["_rows"].dataType.elementType
    none_yet = F.struct(F.slice("_rows", 1, 0).alias("closed"), F.lit(None).cast(kind).alias("open"))

    def add(so_far: Column, x: Column) -> Column:
        last = so_far["open"]
        same = last.isNotNull() & (x["_us"] <= last["_us"] + us)
        grown = F.struct(last["_us"], last["start_ts"], last["_ok"], (last["n_fails"] + x["n_fails"]).alias("n_fails"))
        # The array grows when a window closes, not with every row.
        closed = F.when(same | last.isNull(), so_far["closed"]).otherwise(F.concat(so_far["closed"], F.array(last)))
        return F.struct(closed.alias("closed"), F.when(same, grown).otherwise(x).alias("open"))

    done = F.aggregate("_rows", none_yet, add, lambda d: F.concat(d["closed"], F.array(d["open"])))
    return arrays.select(*group, F.inline(done))


def _greedy_windows(nodes: DataFrame, group: list[str], us: int, max_rows: int) -> DataFrame:
    """Windows of length ``us`` laid one after the other over each group's nodes, with row counts.

    ``nodes`` has one row per group and time ``_us``, with ``_n``, ``start_ts`` and ``_ok``. Each node
    points at the first node behind its own window; the windows are what is reached from the group's
    first node. Doubling the pointers finds them in a few rounds of joins on unique keys, so that a
    group of any length is spread over all tasks.
    """
    # A probe stands where a node's window ends; the next node behind it opens the next window.
    # At equal times the node sorts before the probe, since the window includes its end.
    marks = F.array(
        F.struct(F.col("_us").alias("_at"), F.lit(0).alias("_kind")),
        F.struct((F.col("_us") + us).alias("_at"), F.lit(1).alias("_kind")),
    )
    lined = nodes.select(*group, "_us", "_n", "start_ts", "_ok", F.inline(marks))
    at_node = F.col("_kind") == 0
    upto = (
        Ordered.of(lined, group, ["_at", "_kind"], max_rows)
        .running({"_next": ("min", F.when(at_node, F.col("_us")))}, reverse=True, inclusive=False)
        .running({"_sum": ("sum", F.when(at_node, F.col("_n")).otherwise(F.lit(0)))})
        .table()
    )
    # From the probe row: everything up to the window's end; less what came before the window opened.
    per_node = checkpointed(
        upto.groupBy(*group, "_us").agg(
            F.min("start_ts").alias("start_ts"),
            F.min("_ok").alias("_ok"),
            F.max(F.when(~at_node, F.col("_next"))).alias("_jump"),
            F.max(F.when(~at_node, F.col("_sum"))).alias("_upto"),
            F.max(F.when(at_node, F.col("_sum") - F.col("_n"))).alias("_before"),
        )
    )
    starts = per_node.groupBy(*group).agg(F.min("_us").alias("_us"))
    jumps = per_node.filter(F.col("_jump").isNotNull()).select(*group, "_us", "_jump")
    while not jumps.isEmpty():
        # After a round ``starts`` holds twice as many windows of each group and a jump skips twice as many.
        reached = starts.join(jumps, [*group, "_us"]).select(*group, F.col("_jump").alias("_us"))
        starts = checkpointed(starts.unionByName(reached))
        far = jumps.select(*group, F.col("_us").alias("_jump"), F.col("_jump").alias("_far"))
        jumps = checkpointed(
            jumps.join(far, [*group, "_jump"]).select(*group, "_us", F.col("_far").alias("_jump"))
        )
    opened = per_node.join(starts, [*group, "_us"], "left_semi")
    return opened.withColumn("n_fails", F.col("_upto") - F.col("_before"))
