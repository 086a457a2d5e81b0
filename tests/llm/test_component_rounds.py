"""Components cost the driver few jobs, and tasks that unite links part by part find the same ones."""

import random

from twinledger.llm import components


def brute(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def some_links():
    """Stars whose centres form chains, a path, links of one pair both ways, and a large star."""
    random.seed(5)
    links = [(random.randrange(400), 1000 + random.randrange(1200)) for _ in range(1200)]
    links += [(i + 1, i) for i in range(3000, 3060)] + [(7001, 7000), (7000, 7001), (-5, 9)]
    links += [(5000, 5000 + i) for i in range(1, 500)]
    random.shuffle(links)
    return links


def jobs_of(spark, work):
    """The result, and the number of jobs that Spark ran for it."""
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)


def test_few_jobs_for_many_links(spark):
    links = some_links()
    table = spark.createDataFrame(links, "a long, b long").repartition(6)
    found, jobs = jobs_of(spark, lambda: components.components(table).collect())
    assert {r.node: r.root for r in found} == brute(links) and len(found) == len(brute(links))
    assert jobs <= 20


def test_links_united_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(components, "HELD", 3)
    monkeypatch.setattr("twinledger.llm.common.BATCH_ROWS", 2)
    links = some_links()[:700]
    rows = [*links, (None, 1), (2, None), (3, 3)]
    table = spark.createDataFrame(rows, "a long, b long").repartition(4)
    found = components.components(table).collect()
    assert {r.node: r.root for r in found} == brute(links) and len(found) == len(brute(links))
