from tallyspan.functions.clock import as_instant, as_wall_clock, day_number
from tallyspan.functions.money import amount, cents, discounted, exact_sum
from tallyspan.functions.vectors import squared_length

__all__ = [
    "amount", "as_instant", "as_wall_clock", "cents", "day_number", "discounted", "exact_sum",
    "squared_length",
]
