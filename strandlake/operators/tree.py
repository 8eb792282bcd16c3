"""Trees as tables ``node, parent, label, edge_length``; relations by recursive joins, re-rooting on the driver (trees are small)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.runtime import cut


def depths(tree: DataFrame, max_levels: int = 10_000) -> DataFrame:
    """``node, depth, distance`` from the root, level by level."""
    level = tree.where("parent is null").select("node", F.lit(0).alias("depth"), F.lit(0.0).alias("distance"))
    out = level
    for _ in range(max_levels):
        step = tree.join(level.select(F.col("node").alias("parent"), "depth", "distance"), "parent")
        level = cut(step.select("node", (F.col("depth") + 1).alias("depth"), (F.col("distance") + F.coalesce("edge_length", F.lit(0.0))).alias("distance")))
        if not level.limit(1).count():
            return out
        out = out.union(level)
    raise RuntimeError("the tree has a cycle or too many levels")


def clades(tree: DataFrame) -> DataFrame:
    """``node, parent, tips``: the labels of the tips below every node (a tip is below itself)."""
    inner = tree.select(F.col("parent").alias("node")).where("node is not null").distinct()
    up = tree.join(inner, "node", "left_anti").select(F.col("label").alias("tip"), "node")
    out = up
    while True:
        up = cut(up.join(tree.select("node", "parent"), "node").where("parent is not null").select("tip", F.col("parent").alias("node")))
        if not up.limit(1).count():
            break
        out = out.union(up)
    return out.groupBy("node").agg(F.array_sort(F.collect_set("tip")).alias("tips")).join(tree.select("node", "parent"), "node")


def _adjacency(rows: list) -> dict[int, list[tuple[int, float]]]:
    near: dict[int, list[tuple[int, float]]] = {}
    for r in rows:
        near.setdefault(r.node, [])
        if r.parent is not None:
            near[r.node].append((r.parent, r.edge_length or 0.0))
            near.setdefault(r.parent, []).append((r.node, r.edge_length or 0.0))
    return near


def _rooted_on(rows: list, a: int, b: int, from_a: float) -> list[tuple[int, int | None, str, float | None]]:
    """The tree with a new root on the edge a-b, ``from_a`` from a."""
    near, label = _adjacency(rows), {r.node: r.label for r in rows}
    length = next(w for x, w in near[a] if x == b)
    root = max(near) + 1
    out: list[tuple[int, int | None, str, float | None]] = [(root, None, "", None)]
    todo = [(a, root, from_a, b), (b, root, length - from_a, a)]
    while todo:
        node, parent, w, came = todo.pop()
        out.append((node, parent, label[node], w))
        todo += [(x, node, v, node) for x, v in near[node] if x != came]
    used = {p for _, p, _, _ in out}
    passed = {n: (p, w) for n, p, label_, w in out if p is not None and n in used and not label_ and sum(1 for _, q, _, _ in out if q == n) == 1}
    fixed = []
    for n, p, label_, w in out:  # the old root may now pass on one branch only
        if n in passed:
            continue
        while p in passed:
            p, w = passed[p][0], (w or 0.0) + passed[p][1]
        fixed.append((n, p, label_, w))
    return fixed


def root_at_outgroup(tree: DataFrame, outgroup: str, share: float = 0.5) -> DataFrame:
    """The tree rooted on the outgroup's branch, with ``share`` of its length on the outgroup's side (a half, or a quarter for drawing)."""
    rows = tree.collect()
    tip = next(r.node for r in rows if r.label == outgroup)
    other, length = _adjacency(rows)[tip][0]
    return tree.sparkSession.createDataFrame(_rooted_on(rows, tip, other, length * share), tree.schema)


def root_at_midpoint(tree: DataFrame) -> DataFrame:
    """The tree rooted half-way between the two tips farthest apart."""
    rows = tree.collect()
    near = _adjacency(rows)
    tips = [n for n, x in near.items() if len(x) == 1]

    def far(start: int) -> tuple[int, dict[int, float], dict[int, int]]:
        dist, prev, todo = {start: 0.0}, {}, [start]
        while todo:
            x = todo.pop()
            for y, w in near[x]:
                if y not in dist:
                    dist[y], prev[y] = dist[x] + w, x
                    todo.append(y)
        return max(tips, key=lambda t: dist[t]), dist, prev

    one, _, _ = far(tips[0])
    two, dist, prev = far(one)
    half, x = dist[two] / 2, two
    while dist[prev[x]] > half:
        x = prev[x]
    return tree.sparkSession.createDataFrame(_rooted_on(rows, x, prev[x], dist[x] - half), tree.schema)


def layout(tree: DataFrame) -> list[tuple[int, float, int]]:
    """``(node, x, size)`` with the smaller branches first: tips at 0, 1, 2, ..., inner nodes midway between their outermost children."""
    rows = tree.collect()
    kids: dict = {}
    for r in rows:
        kids.setdefault(r.parent, []).append(r.node)
    label = {r.node: r.label or "" for r in rows}
    order, todo = [], list(kids[None])
    while todo:
        x = todo.pop()
        order.append(x)
        todo += kids.get(x, [])
    size: dict[int, int] = {}
    for x in reversed(order):
        size[x] = sum(size[k] for k in kids.get(x, [])) or 1
    ranked = {x: sorted(k, key=lambda n: (size[n], label[n])) for x, k in kids.items()}
    place: dict[int, float] = {}
    tips, todo = 0, list(reversed(ranked[None]))
    while todo:
        x = todo.pop()
        if x in ranked:
            todo += reversed(ranked[x])
        else:
            place[x] = float(tips)
            tips += 1
    for x in reversed(order):
        if x in ranked:
            own = [place[k] for k in ranked[x]]
            place[x] = (min(own) + max(own)) / 2
    return [(x, place[x], size[x]) for x in order]


def tip_label(label: str) -> str:
    """A label for drawing: spaces for underscores, ten characters."""
    return label.replace("_", " ")[:10]
