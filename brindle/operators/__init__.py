"""Relational operators that Spark has no syntax for, as compositions of its own."""

from brindle.operators.events import deduplicated_latest, gap_filled, sessions
from brindle.operators.joins import as_of_join, range_join, salted_join, sized_join
from brindle.operators.layout import clustered, interleaved
from brindle.operators.ordered import globally_ordered
from brindle.operators.ranking import exact_quantiles, top_per_group, weighted_sample

__all__ = [
    "as_of_join", "clustered", "deduplicated_latest", "exact_quantiles", "gap_filled", "globally_ordered", "interleaved", "range_join", "salted_join", "sessions", "sized_join", "top_per_group", "weighted_sample",
]
