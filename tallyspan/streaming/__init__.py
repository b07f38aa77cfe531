from tallyspan.streaming.dedupe import first_deliveries
from tallyspan.streaming.joins import join_within
from tallyspan.streaming.run import run_available
from tallyspan.streaming.windows import session_counts, window_counts

__all__ = ["first_deliveries", "join_within", "run_available", "session_counts", "window_counts"]
