"""Connected components of a table of links, by joins and groupings until nothing changes.

Every task first unites the links it reads, so that it names each node once, with the least node it knows of its part.
Then two steps alternate: a node's several heads are linked to the least of them, and nodes pass on to the head of their
head.  Links become stars around the least node of each component.  No node's neighbours are ever gathered in one row,
only its heads, of which it has one a task; links never reach the driver; each round is written to the shared folder.

Each round costs the driver plans, some jobs and a record of every task, whatever the number of links.  So a round shuffles
three times, and one grouping tells whether there are stars only, instead of one more round that changes nothing.  Links are
written before they are united: a task then reads whole splits, and never feeds one Python worker from another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, map_batches
from twinledger.sources.storage import stored

#: Nodes that a task unites at once; it passes on what it has before it takes more.
HELD = 1 << 18


def _united(links: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) of each node but the least ones, to the least node that its task's links connect it with."""
    most = HELD

    def work(batches):
        up = {}

        def find(x):
            up.setdefault(x, x)
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        def stars():
            nodes = [x for x in up if up[x] != x]
            return {"a": nodes, "b": [find(x) for x in nodes]}

        for batch in batches:
            for a, b in zip(*columns_of(batch, "a", "b")):
                a, b = find(a), find(b)
                up[max(a, b)] = min(a, b)
            if len(up) >= most:
                yield stars()
                up.clear()
        yield stars()

    return map_batches(links.select("a", "b"), work, "a long, b long")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one head and no head has another."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("below")), F.struct(F.col("b").alias("node"), F.lit(0).alias("below")))
    nodes = links.select(F.explode(ends).alias("end")).groupBy("end.node").agg(F.sum("end.below").alias("heads"), F.count("*").alias("n"))
    return not nodes.agg(F.max((F.col("heads") > 1) | (F.col("heads") > 0) & (F.col("n") > F.col("heads")))).first()[0]


def _nearer(links: DataFrame) -> DataFrame:
    """A node's heads are linked to the least of them, then every node to its head's head."""
    heads = links.groupBy("a").agg(F.collect_set("b").alias("heads")).withColumn("b", F.array_min("heads"))
    others = F.filter("heads", lambda x: x != F.col("b"))
    down = heads.select(F.explode(F.concat(F.array("a"), others)).alias("a"), "b")
    above = down.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("above"))
    return down.join(above, "b", "left").select("a", F.coalesce("above", "b").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """From links (``a``, ``b``) to rows (``node``, ``root``) for every node but the roots; the root is the least node.

    Links of a node with itself and links with a null end say nothing; no links, no rows.
    """
    found = _united(stored(links.where("a <> b"), "links"))
    while not _are_stars(found := stored(found, "stars")):
        found = _united(stored(_nearer(found), "links"))
    return found.select(F.col("a").alias("node"), F.col("b").alias("root"))
