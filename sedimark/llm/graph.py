"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.llm.tables import remove, stored_with

SALTS = 16


def _smallest_neighbour(edges: DataFrame, key: str, other: str) -> DataFrame:
    """`edges` with `least`, the smallest `other` of its `key`.

    The minimum is combined before the shuffle; it meets the edges on (key, salt), so the edges of a
    node with very many neighbours spread over several tasks.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    least = (
        edges.groupBy(key)
        .agg(F.min(other).alias("least"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    return salted.join(least, [key, "salt"]).drop("salt")


def connected(edges: DataFrame, label: str = "edges", max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node it reaches. Runs jobs.

    `edges` has two bigint columns a, b. Alternating large-star and small-star rounds: each attaches the
    neighbours of a node to its smallest neighbour, until all components are stars. Every round is a
    written table, so a lost executor repeats at most one round; the table before it is deleted.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    measures = {
        "rows": F.count(F.lit(1)),
        "sum": F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)),
    }
    current, state = stored_with(ordered, label, **measures)
    for _ in range(max_rounds):
        if state["rows"] == 0:
            break
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        large = _smallest_neighbour(both, "u", "v").where("v > u")
        large = large.select(F.col("v").alias("hi"), F.least("least", "u").alias("lo")).distinct()
        small = _smallest_neighbour(large, "hi", "lo").select(
            F.explode(
                F.array(
                    F.struct(F.col("hi"), F.col("least").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")),
                )
            ).alias("e")
        )
        after, reached = stored_with(small.select("e.hi", "e.lo").where("hi <> lo").distinct(), label, **measures)
        remove(current)
        current, same, state = after, reached == state, reached
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


class Forest:
    """Union-find over small integers, for the members of one bounded bucket."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent.setdefault(x, x)
        while up != self.parent[up]:
            self.parent[up] = self.parent[self.parent[up]]
            up = self.parent[up]
        self.parent[x] = up
        return up

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def links(self) -> list[tuple[int, int]]:
        """(member, smallest member of its set), without the smallest itself."""
        return [(x, r) for x in self.parent if (r := self.root(x)) != x]
