"""The hierarchy expansion against edge-set fixpoints, on random graphs with cycles."""

import random

from lakeops.operators.hierarchy import expand_hierarchy


def levels(edges, boxes, root):
    """Depth of every node below ``root``: level by level, the edges that leave the boxes reached so far, until no
    level adds a node."""
    depth, sources, level = {}, {root}, 0
    while True:
        level += 1
        new = {c for p, c in edges if p in sources} - depth.keys()
        if not new:
            return depth
        depth |= dict.fromkeys(new, level)
        sources = (new & boxes) - {root}


def test_hierarchy_matches_model_on_random_graphs(spark):
    rnd = random.Random(21)
    rows, expected = [], {}
    for g in range(4):
        nodes = list(range(50))
        boxes = {n for n in nodes if rnd.random() < 0.6} | {0}
        edges = {(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(90)} | {(0, 0)}
        expected[g] = levels(edges, boxes, 0)
        rows += [(g, p, c, c in boxes) for p, c in edges]
    df = spark.createDataFrame(rows, "g int, parent int, child int, is_box boolean")
    for g in range(4):
        got = {r.node: r.depth for r in expand_hierarchy(df.where(df.g == g), 0, expandable="is_box").collect()}
        assert got == expected[g], g
