"""Column functions that Spark lacks, as expressions of built-in ones; aggregates and table functions of a user's own."""

from brindle.functions.aggregates import folded, longest_streak
from brindle.functions.columns import cosine, dot, exact_share, jaro, norm
from brindle.functions.tables import Funnel, register_tables

__all__ = ["Funnel", "cosine", "dot", "exact_share", "folded", "jaro", "longest_streak", "norm", "register_tables"]
