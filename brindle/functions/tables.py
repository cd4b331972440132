"""Table functions: row streams in, rows out, by partitions of a table argument."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import Row


@udtf(returnType="user_id bigint, view_id bigint, click_id bigint, purchase_id bigint")
class Funnel:
    """Each purchase with the last click before it that followed a view, and the last view before that click.

    Takes rows (user_id, event_id, event_type) of one user in order of time and keeps three ids, however
    many rows there are.
    """

    def __init__(self):
        self.view = self.click = self.viewed = None

    def eval(self, row: Row) -> Iterator[tuple]:
        kind = row["event_type"]
        if kind == "view":
            self.view = row["event_id"]
        elif kind == "click" and self.view is not None:
            self.click, self.viewed = row["event_id"], self.view
        elif kind == "purchase" and self.click is not None:
            yield row["user_id"], self.viewed, self.click, row["event_id"]


def register_tables(spark: SparkSession) -> None:
    """Makes the table functions known to SQL."""
    spark.udtf.register("funnel", Funnel)
