from tallyspan.operators.asof import asof_join
from tallyspan.operators.coverage import interval_union
from tallyspan.operators.gaps import regular_grid
from tallyspan.operators.grouping import rollup_totals, top_per_group
from tallyspan.operators.intervals import overlap_join
from tallyspan.operators.ordered import count_within, moving, previous, with_lookback
from tallyspan.operators.percentiles import exact_percentile
from tallyspan.operators.ranges import range_join
from tallyspan.operators.runs import islands, sessions
from tallyspan.operators.segments import find_cuts
from tallyspan.operators.sets import except_all, intersect_distinct

__all__ = [
    "asof_join", "count_within", "except_all", "exact_percentile", "find_cuts",
    "intersect_distinct", "interval_union", "islands", "moving", "overlap_join", "previous", "range_join", "regular_grid",
    "rollup_totals", "sessions", "top_per_group", "with_lookback",
]
