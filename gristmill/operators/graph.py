"""Operators over edge tables (src, dst)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settled, ship


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree: how many ends of edges a node is."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def missing_ends(edges: DataFrame, nodes: DataFrame, id: str = "id") -> DataFrame:
    """Ends of edges that are no node."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(nodes.select(F.col(id).alias("node")), "node", "left_anti")


def orphans(nodes: DataFrame, edges: DataFrame, id: str = "id") -> DataFrame:
    """Nodes that no edge ends at."""
    return nodes.join(edges.select(F.explode(F.array("src", "dst")).alias(id)), id, "left_anti")


def siblings(edges: DataFrame) -> DataFrame:
    """Of child-parent edges, the number of other children that each child's parents have."""
    count = edges.distinct().groupBy("dst").agg(F.count("*").alias("children"))
    return edges.distinct().join(count, "dst").groupBy("src").agg(F.sum(F.col("children") - 1).alias("n_siblings"))


def _tarjan(edges: list[tuple]) -> dict:
    """The least node of each node's strong component."""
    out: dict = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
        out.setdefault(b, [])
    number, low, label, stack, on = {}, {}, {}, [], set()
    for root in out:
        if root in number:
            continue
        todo = [(root, iter(out[root]))]
        number[root] = low[root] = len(number)
        stack.append(root)
        on.add(root)
        while todo:
            node, rest = todo[-1]
            other = next(rest, None)
            if other is None:
                todo.pop()
                if todo:
                    low[todo[-1][0]] = min(low[todo[-1][0]], low[node])
                if low[node] == number[node]:
                    own = [stack.pop()]
                    while own[-1] != node:
                        own.append(stack.pop())
                    on.difference_update(own)
                    label.update(dict.fromkeys(own, min(own)))
            elif other not in number:
                number[other] = low[other] = len(number)
                stack.append(other)
                on.add(other)
                todo.append((other, iter(out[other])))
            elif other in on:
                low[node] = min(low[node], number[other])
    return label


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges whose ends both have an edge in and an edge out."""
    return edges.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")


def _chains(edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes with one edge in and one out are passed over: node, head, tail (the first other nodes before and after it), the nodes of cycles that
    have no other nodes (node, scc), and the edges between the other nodes. Each round doubles the steps taken, so a chain of n takes log2(n).
    """
    one = lambda by, of: edges.groupBy(by).agg(F.count("*").alias("n"), F.first(of).alias("v")).where("n = 1")
    ends = one("src", "dst").select(F.col("src").alias("node"), F.col("v").alias("tail"))
    found = settled(ends.join(one("dst", "src").select(F.col("dst").alias("node"), F.col("v").alias("head")), "node").withColumn("least", F.col("node")))
    many = found.count()
    for _ in range(many.bit_length() + 1):
        ahead = found.select(F.col("node").alias("tail"), F.col("tail").alias("_t"), F.col("least").alias("_l"))
        behind = found.select(F.col("node").alias("head"), F.col("head").alias("_h"))
        met = found.join(ahead, "tail", "left").join(behind, "head", "left")
        step = met.select("node", F.coalesce("_h", "head").alias("head"), F.coalesce("_t", "tail").alias("tail"), F.least("least", "_l").alias("least"), (F.col("_t").isNotNull() | F.col("_h").isNotNull()).alias("_moved"))
        step = settled(step)
        found = step.drop("_moved")
        if step.where("_moved").isEmpty():
            break
    closed = found.join(found.select(F.col("node").alias("tail")), "tail", "left_semi")  # still among themselves: a cycle of such nodes alone
    rings = closed.select("node", F.col("least").alias("scc"))
    chains = found.join(closed.select("node"), "node", "left_anti").select("node", "head", "tail")
    passed = found.select(F.col("node").alias("src"))
    left = edges.join(passed, "src", "left_anti").join(chains.select(F.col("node").alias("dst"), "tail"), "dst", "left")
    return chains, rings, left.select("src", F.coalesce("tail", "dst").alias("dst")).distinct()


def _coloured(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node and scc of the strong components that one colouring finds, and the edges that may be in others.

    Each node takes the greatest name that reaches it; whatever reaches the node of that name within its colour is its component.
    """
    colour = settled(edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("c", F.col("node")))
    while True:
        new = colour.withColumnRenamed("node", "src").join(edges, "src").select(F.col("dst").alias("node"), "c")
        new = settled(colour.unionByName(new).groupBy("node").agg(F.max("c").alias("c")))
        if new.exceptAll(colour).isEmpty():
            break
        colour = new
    within = edges.join(colour.withColumnRenamed("node", "src"), "src").join(colour.select(F.col("node").alias("dst"), F.col("c").alias("c2")), "dst").where("c = c2")
    within = settled(within.select("src", "dst"))
    reached = settled(colour.where("node = c").select("node"))
    while True:
        new = settled(within.join(reached.withColumnRenamed("node", "dst"), "dst", "left_semi").select(F.col("src").alias("node")).unionByName(reached).distinct())
        if new.count() == reached.count():
            break
        reached = new
    found = reached.join(colour, "node")
    least = found.groupBy("c").agg(F.min("node").alias("scc"))
    left = within.join(reached.withColumnRenamed("node", "src"), "src", "left_anti").join(reached.withColumnRenamed("node", "dst"), "dst", "left_anti")
    return found.join(least, "c").select("node", "scc"), settled(left.select("src", "dst"))


def strong_components(edges: DataFrame, local: int = 100_000) -> DataFrame:
    """Of edges (src, dst): node, scc (the least node of its strong component) and cyclic (true only if the node is on a cycle, a loop included).

    Nodes on no cycle are trimmed off while that takes a fifth of the edges, and chains are passed over by doubling, however long they are. What is left is
    coloured until at most so many edges stay; these are one task's. Rounds of a colouring grow with the longest path between nodes that
    neither step removes. Nulls in edges are ignored; an empty table gives no rows.
    """
    ship(edges.sparkSession)
    edges = settled(edges.select("src", "dst").where("src is not null and dst is not null").distinct())
    kind = edges.schema["src"].dataType.simpleString()
    left, labels, chained = edges.where("src <> dst"), [], []
    size = left.count()

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        label = _tarjan(list(zip(frame.src, frame.dst)))
        return pd.DataFrame({"node": list(label), "scc": list(label.values())})

    while size > local:
        before = size
        left = settled(_trimmed(left))
        size = left.count()
        if size <= max(local, 0.8 * before):  # a trimming is one round; chains take many
            continue
        chains, rings, rest = _chains(left)
        chained.append(settled(chains))
        labels.append(settled(rings))
        left = settled(rest.where("src <> dst"))
        size = left.count()
        if local < size > 0.9 * before:  # trimming that still takes a share is far cheaper than colouring
            found, left = _coloured(left)
            labels.append(settled(found))
            size = left.count()
    if size:
        labels.append(settled(left.groupBy(F.lit(0).alias("all")).applyInPandas(solve, f"node {kind}, scc {kind}")))
    known = reduce(DataFrame.unionByName, labels) if labels else edges.select(F.col("src").alias("node"), F.col("src").alias("scc")).limit(0)
    known = settled(known.groupBy("node").agg(F.min("scc").alias("scc")))
    for chains in reversed(chained):  # what a chain leads from and to is known by now; other nodes are alone
        own = lambda c: known.select(F.col("node").alias(c), F.col("scc").alias(f"_{c}"))
        met = chains.join(own("head"), "head", "left").join(own("tail"), "tail", "left")
        met = met.where(F.coalesce("_head", "head") == F.coalesce("_tail", "tail")).select("node", F.coalesce("_head", "head").alias("scc"))
        known = settled(known.unionByName(met))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    whole = nodes.join(known.withColumnRenamed("scc", "_scc"), "node", "left").select("node", F.coalesce("_scc", "node").alias("_scc"))
    least = whole.groupBy("_scc").agg(F.min("node").alias("scc"), F.count("*").alias("n"))
    loops = edges.where("src = dst").select(F.col("src").alias("node"), F.lit(True).alias("loop"))
    return settled(whole.join(least, "_scc").join(loops, "node", "left").select("node", "scc", ((F.col("n") > 1) | F.coalesce("loop", F.lit(False))).alias("cyclic")))


def levels(edges: DataFrame, local: int = 100_000) -> DataFrame:
    """node, level, cyclic: the longest path, counted in strong components, that leads to each node's component; 0 where nothing comes before.

    Nodes of one cycle share a level. Chains of components are passed over by doubling with the number of their steps, and waves go over what is
    left, one for each component of its longest path, unless it has at most so many edges; these are one task's.
    """
    parts = strong_components(edges, local)
    scc = lambda c: parts.select(F.col("node").alias(c), F.col("scc").alias(f"_{c}"))
    above = edges.select("src", "dst").dropna().join(scc("src"), "src").join(scc("dst"), "dst").where("_src <> _dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst")).distinct()
    above = settled(above.withColumn("far", F.lit(1).cast("long")))
    chains, left = None, above
    if above.count() > local:
        inner, _, _ = _chains(above.select("src", "dst"))
        # steps of a chain's nodes from its head: doubled over the edge before each
        before = settled(inner.select("node").join(above.select(F.col("dst").alias("node"), F.col("src").alias("at")), "node").withColumn("steps", F.lit(1).cast("long")))
        while True:
            back = before.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("steps").alias("_steps"))
            new = settled(before.join(back, "at", "left").select("node", F.coalesce("_at", "at").alias("at"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.col("_at").isNotNull().alias("moved")))
            before = new.drop("moved")
            if new.where("moved").isEmpty():
                break
        chains = before.withColumnRenamed("at", "head")
        ends = above.withColumnRenamed("src", "node").join(chains, "node").join(chains.select(F.col("node").alias("dst")), "dst", "left_anti")
        direct = above.join(chains.select(F.col("node").alias("src")), "src", "left_anti").join(chains.select(F.col("node").alias("dst")), "dst", "left_anti")
        left = settled(direct.unionByName(ends.select(F.col("head").alias("src"), "dst", (F.col("steps") + 1).alias("far"))).groupBy("src", "dst").agg(F.max("far").alias("far")))
    kind = parts.schema["scc"].dataType.simpleString()
    nodes = parts.select(F.col("scc").alias("node")).distinct()

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        out: dict = {}
        level: dict = {}
        waiting: dict = {}
        for a, b, n, base in zip(frame.src, frame.dst, frame.far, frame.base):
            waiting.setdefault(b, 0)
            if base == base and base is not None:
                level[b] = max(level.get(b, 0), int(base) + n)
            else:
                out.setdefault(a, []).append((b, n))
                waiting[b] += 1
        todo = [*(b for b, n in waiting.items() if not n), *(a for a in out if a not in waiting)]
        for a in todo:
            level.setdefault(a, 0)
            for b, n in out.get(a, ()):
                level[b] = max(level.get(b, 0), level[a] + n)
                waiting[b] -= 1
                if not waiting[b]:
                    todo.append(b)
        return pd.DataFrame({"node": list(level), "level": list(level.values())})

    # Edges that lead to nodes without a level yet; base is the level of their src, once it is known.
    left, waves = left.select("src", "dst", "far", F.lit(None).cast("long").alias("base")), []
    open_ = left.count()
    if open_ > local:
        waves.append(settled(left.select(F.col("src").alias("node")).distinct().join(left.select(F.col("dst").alias("node")), "node", "left_anti").withColumn("level", F.lit(0).cast("long"))))
    while open_ > local:  # a wave: nodes that no edge without a base leads to
        ahead = waves[-1].select(F.col("node").alias("src"), F.col("level").alias("_level"))
        left = left.join(waves[-1].select(F.col("node").alias("dst")), "dst", "left_anti").join(ahead, "src", "left")
        left = settled(left.select("src", "dst", "far", F.coalesce("base", "_level").alias("base")))
        open_ = left.count()
        ready = left.groupBy(F.col("dst").alias("node")).agg(F.max(F.col("base") + F.col("far")).alias("level"), F.max(F.col("base").isNull()).alias("waits"))
        if open_ > local:
            waves.append(settled(ready.where("not waits").select("node", "level")))
    if open_:
        waves.append(settled(left.groupBy(F.lit(0).alias("all")).applyInPandas(solve, f"node {kind}, level long")))
    found = reduce(DataFrame.unionByName, waves) if waves else nodes.limit(0).withColumn("level", F.lit(0).cast("long"))
    if waves:  # a source has its level from the first wave, and as a src from the last task
        found = settled(found.groupBy("node").agg(F.max("level").alias("level")))
    known = found
    if chains is not None:
        inner = chains.join(known.withColumnRenamed("node", "head"), "head", "left").select("node", (F.coalesce("level", F.lit(0)) + F.col("steps")).alias("level"))
        known = known.join(inner.select("node"), "node", "left_anti").unionByName(inner)
    known = nodes.join(known, "node", "left").select(F.col("node").alias("scc"), F.coalesce("level", F.lit(0)).cast("long").alias("level"))
    return parts.join(known, "scc").select("node", "level", "cyclic")


def acyclic_part(edges: DataFrame, local: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Splits edges into those that lie on no cycle and those that lie on one: both ends are in one strong component."""
    parts = strong_components(edges, local)
    scc = lambda c: parts.select(F.col("node").alias(c), F.col("scc").alias(f"_{c}"))
    met = settled(edges.select("src", "dst").distinct().join(scc("src"), "src").join(scc("dst"), "dst"))
    return met.where("_src <> _dst").select("src", "dst"), met.where("_src = _dst").select("src", "dst")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """src and the least node that it hangs together with, by the edges of one task."""
    above: dict = {}

    def top(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = up
        return x

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    if above:
        yield pa.RecordBatch.from_arrays([pa.array(list(above), kind), pa.array([top(x) for x in above], kind)], names=["src", "dst"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or all smaller ones and itself) are linked to its least neighbour instead."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if large else edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    met = both.join(least, "src")
    if large:
        return met.where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()
    return met.select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(least.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct()


def weak_components(edges: DataFrame, local: int = 100_000) -> DataFrame:
    """node, core: the least node that each node of edges hangs together with.

    Tasks join what hangs together by their own edges, in the order of src, so that what is near in that order is one star; stars are joined
    round by round (their number grows with the logarithm of the longest chain of stars), or in one task once at most so many edges are left.
    """
    ship(edges.sparkSession)
    kind = edges.schema["src"].dataType.simpleString()
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).where("node is not null").distinct()
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())
    near = edges.select("src", "dst").where("src <> dst").repartitionByRange("src", "dst").mapInArrow(_joined, f"src {kind}, dst {kind}")
    links = settled(near.where("src <> dst").distinct())
    before = state(links)
    if before[0] <= local:
        links = settled(links.coalesce(1).mapInArrow(_joined, f"src {kind}, dst {kind}"))
    while before[0] > local:  # each round takes stars nearer to the least nodes, until none changes
        links = settled(_star(settled(_star(links, True)), False))
        now = state(links)
        if now == before:
            break
        before = now
    return settled(nodes.join(links.select(F.col("src").alias("node"), F.col("dst").alias("_core")), "node", "left").select("node", F.coalesce("_core", "node").alias("core")))


def redirected(redirects: DataFrame) -> DataFrame:
    """src, root, steps: where each src of redirects (src, dst; one dst for each src) ends after all redirects, and after how many; both are null where they lead into a cycle.

    Each round joins the redirects with themselves and doubles the steps that they take, so a chain of n takes log2(n) rounds; what is still
    open after that is on a cycle or leads into one.
    """
    left = settled(redirects.select("src", F.col("dst").alias("root"), F.lit(1).cast("long").alias("steps")))
    ahead = lambda: left.select(F.col("src").alias("root"), F.col("root").alias("_next"), F.col("steps").alias("_more"))
    for _ in range(left.count().bit_length() + 1):
        met = settled(left.join(ahead(), "root", "left"))
        if met.where(F.col("_next").isNotNull()).isEmpty():
            return left
        left = met.select("src", F.coalesce("_next", "root").alias("root"), (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps"))
    ended = left.join(ahead().select("root"), "root", "left_anti").select("src", "root", "steps")
    return redirects.select("src").join(ended, "src", "left").select("src", "root", "steps")


def typed_edges(records: DataFrame, source: str, candidates: dict[str, tuple[list[str], Column]], among: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """source, target, type, detail: of each type, the first of its target columns that is filled, with a detail column; without loops, each edge once.

    among: types whose targets must be one of these.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    made = []
    for name, (columns, detail) in candidates.items():
        target = F.coalesce(*map(filled, columns))
        allowed = target.isin(*among[name]) if among and name in among else F.lit(True)
        made.append(F.when(allowed & (target != F.col(source)), F.struct(target.alias("target"), F.lit(name).alias("type"), detail.alias("detail"))))
    return records.where(F.col(source) != "").select(F.col(source).alias("source"), F.explode(F.array_compact(F.array(*made))).alias("e")).select("source", "e.*").distinct()


def stubs(edges: DataFrame, nodes: DataFrame, id: str) -> DataFrame:
    """A record for each target of edges that is no node: canonical_id, display_name_en, tree_status, n_edges (that lead to it)."""
    lost = edges.join(nodes.select(F.col(id).alias("target")).distinct(), "target", "left_anti").groupBy("target").agg(F.count("*").alias("n_edges"))
    return lost.select(F.col("target").alias("canonical_id"), F.replace("target", F.lit("_"), F.lit(" ")).alias("display_name_en"), F.lit("stub").alias("tree_status"), "n_edges")


def _found_cycles(edges: list[tuple[str, str]]) -> list[list[str]]:
    """The cycles that a depth-first search meets, from the least node on, in the order of names; one for each set of nodes."""
    out: dict[str, list[str]] = {}
    for a, b in sorted(set(edges)):
        out.setdefault(a, []).append(b)
    done, found, sets = set(), [], set()
    for root in sorted(out):
        if root in done:
            continue
        path, place, todo = [root], {root: 0}, [iter(out[root])]
        while todo:
            node = next(todo[-1], None)
            if node is None:
                done.add(path[-1])
                del place[path.pop()]
                todo.pop()
            elif node in place:
                cycle = path[place[node] :]
                if frozenset(cycle) not in sets:
                    sets.add(frozenset(cycle))
                    found.append([*cycle, node])
            elif node not in done:
                place[node] = len(path)
                path.append(node)
                todo.append(iter(out.get(node, ())))
    return found


def _by_core(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges on no cycle, and the others (src, dst, core) by strong component."""
    free, left = acyclic_part(edges)
    return free, left.join(strong_components(left).select(F.col("node").alias("src"), F.col("scc").alias("core")), "src")


def cycles(edges: DataFrame) -> DataFrame:
    """cycle (array of names, from its first node back to it): what a depth-first search of each strong component finds, from its least node on.

    Edges between strong components lie on no cycle and are left out; a strong component is searched whole, in one task.
    """
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cycle": _found_cycles(list(zip(frame.src, frame.dst)))})

    return _by_core(edges)[1].groupBy("core").applyInPandas(search, "cycle array<string>")


def without_cycles(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges that stay when every cycle is broken, and those that are removed: of each cycle the first edge to a longer name, or the last one, until none is left."""
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        left, gone = dict.fromkeys(zip(frame.src, frame.dst)), []
        while found := _found_cycles(list(left)):
            for cycle in found:
                steps = list(zip(cycle, cycle[1:]))
                worst = next((s for s in steps if len(s[1]) > len(s[0])), steps[-1])
                if worst in left:
                    del left[worst]
                    gone.append(worst)
        return pd.DataFrame(gone, columns=["src", "dst"])

    removed = settled(_by_core(edges)[1].groupBy("core").applyInPandas(search, "src string, dst string"))
    return edges.join(removed, ["src", "dst"], "left_anti"), removed
