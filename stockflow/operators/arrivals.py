"""The days on which arrivals of a key come, with what they offer, as a tree of maxima.

A list of days in order, and for each policy one level per day, the maxima of runs of `RUN`
levels, and the maxima of runs of those. The first later day on which a level is reached is
found by halving the days, and by going up the tree and down again, `RUN` entries at a step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.functions.columns import count_up_to

# entries under one entry of the level above
RUN = 64

# What arrivals offer, from the rows of a day's arrivals. `netted`: stock after one of them, which
# is its own quantity where stock was owed before it, else the total. `clamped`: the total.
LEVELS = {"netted": "greatest(_end, bigint(_most))", "clamped": "_end"}


def _maxima(entries: str) -> str:
    """SQL for the maxima of each `RUN` entries of an array."""
    runs = f"if(size({entries}) = 0, array(), sequence(0, (size({entries}) - 1) div {RUN}))"
    return f"transform({runs}, r -> array_max(slice({entries}, int(r) * {RUN} + 1, {RUN})))"


def arrival_entries() -> Column:
    """Of rows of a key's day, direction and block: the days with arrivals and their levels, in order.

    The rows have their largest move `_most` and the total `_end` after them. A day that lies in
    several blocks has an entry for each of them; the list is bounded by the calendar and the
    blocks, not by the number of events.
    """
    entry = F.struct(F.col("scheduled_date").alias("day"), *[F.expr(level).alias(name) for name, level in LEVELS.items()])
    return F.sort_array(F.collect_list(F.when(F.col("event_priority") == 0, entry)))


def with_arrivals(lists: DataFrame) -> DataFrame:
    """`_entries` as `arrivals`: the days and the trees of their levels."""
    trees = lists.withColumns({"days": F.col("_entries.day"), **{f"{n}_0": F.col(f"_entries.{n}") for n in LEVELS}})
    for height in (1, 2):
        trees = trees.withColumns({f"{n}_{height}": F.expr(_maxima(f"{n}_{height - 1}")) for n in LEVELS})
    columns = ["days", *[f"{n}_{height}" for n in LEVELS for height in range(3)]]
    return trees.withColumn("arrivals", F.struct(*columns)).drop("_entries", *columns)


def _let(name: str, value: str, body: str) -> str:
    """SQL for `body` with a name for `value`, which so stands in the plan once.

    As columns of their own the steps would be copied into every filter above, one inside the other.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _first(entries: str, start: str, stop: str, need: str) -> str:
    """SQL for the index of the first entry from `start` to before `stop` that reaches `need`, or null."""
    enough = f"transform(slice({entries}, {start} + 1, greatest({stop} - {start}, 0)), x -> x >= {need})"
    return _let("at", f"int(array_position({enough}, true))", f"if(at > 0, {start} + at - 1, null)")


def first_cover(policy: str, need: str, missing: str = "missing_pallets") -> Column:
    """The first later day of `arrivals` on which the policy's level reaches `need`; null if nothing is missing."""
    level = f"arrivals.{policy}"

    def up(run: str) -> str:
        return f"int({run} div {RUN} + 1)"

    def inside(entries: str, run: str) -> str:
        return _first(entries, f"{run} * {RUN}", f"({run} + 1) * {RUN}", need)

    # up: the rest of the run of runs, then the runs of runs after that; and down again
    above = _let("g", _first(f"{level}_2", up("r"), f"size({level}_2)", need), f"if(g IS NULL, null, {inside(f'{level}_1', 'g')})")
    run = _let("b", _first(f"{level}_1", "r", f"{up('r')} * {RUN}", need), f"coalesce(b, {above})")
    later = _let("r", up("f"), _let("q", run, f"if(q IS NULL, null, {inside(f'{level}_0', 'q')})"))
    # the rest of the run in which the later days begin
    entry = _let("e", _first(f"{level}_0", "f", f"{up('f')} * {RUN}", need), f"coalesce(e, {later})")
    found = _let("f", count_up_to("arrivals.days", "scheduled_date"), f"get(arrivals.days, {entry})")
    return F.expr(f"CASE WHEN {missing} > 0 THEN {found} END")
