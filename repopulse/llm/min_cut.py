"""Two-way labelling of a graph by a minimum cut.

Nodes with at most two neighbours are folded into those first, which keeps every minimum cut of the
rest: what the cut costs at such a node, for each labelling of its neighbours, is a capacity between
them and a change of their leanings. Chains with nested links vanish that way in linear time.
Maximum flow by blocking flows labels what is left, and the folded nodes are then labelled backwards.
"""

from __future__ import annotations

from collections import deque


class _Graph:
    """Leanings towards the sink (``pull``) and directed capacities; a node has an arc to each neighbour, be it of capacity 0."""

    def __init__(self, leaning: list[int], edges: list[tuple[int, int, int]]) -> None:
        self.pull = [-x for x in leaning]
        self.arcs: list[dict[int, int]] = [{} for _ in leaning]
        for a, b, capacity in edges:
            if a != b:
                self.add(a, b, capacity)
                self.add(b, a, capacity)

    def add(self, a: int, b: int, capacity: int) -> None:
        self.arcs[a][b] = self.arcs[a].get(b, 0) + capacity
        self.arcs[b].setdefault(a, 0)

    def without(self, node: int) -> list[tuple[int, int, int]]:
        """Take a node out; its neighbours, with the capacity to and from each."""
        near = [(b, out, self.arcs[b].pop(node)) for b, out in self.arcs[node].items()]
        self.arcs[node] = {}
        return near


def _fold(graph: _Graph) -> tuple[list[tuple[int, int, list[tuple[int, int, int]]]], set[int]]:
    """Fold nodes while one has two neighbours or fewer; the folded ones in order, and those that are left."""
    waiting = deque(k for k, arcs in enumerate(graph.arcs) if len(arcs) <= 2)
    left, folded = set(range(len(graph.pull))), []
    while waiting:
        node = waiting.popleft()
        if node not in left or len(graph.arcs[node]) > 2:
            continue
        left.remove(node)
        pull, near = graph.pull[node], graph.without(node)
        folded.append((node, pull, near))

        def cost(*sides: bool) -> int:
            """The least that the node costs beside neighbours on these sides; True is the source's."""
            at_sink = sum(back for (_, _, back), s in zip(near, sides) if s)
            return min(at_sink, pull + sum(out for (_, out, _), s in zip(near, sides) if not s))

        if len(near) == 1:
            graph.pull[near[0][0]] += cost(True) - cost(False)
        elif len(near) == 2:
            (a, _, _), (b, _, _) = near
            none, first, second, both = cost(False, False), cost(True, False), cost(False, True), cost(True, True)
            graph.pull[a] += both - second
            graph.pull[b] += second - none
            graph.add(a, b, first - none - both + second)
        waiting.extend(b for b, _, _ in near if len(graph.arcs[b]) <= 2)
    return folded, left


def _flow(graph: _Graph, nodes: set[int]) -> set[int]:
    """Nodes on the source's side after a maximum flow, by blocking flows along ever longer shortest paths."""
    arcs = graph.arcs
    supply = {k: -graph.pull[k] for k in nodes if graph.pull[k] < 0}
    demand = {k: graph.pull[k] for k in nodes if graph.pull[k] > 0}
    while True:
        level = {k: 0 for k, x in supply.items() if x}
        queue, met = deque(level), False
        while queue:
            a = queue.popleft()
            met = met or demand.get(a, 0) > 0
            for b, capacity in arcs[a].items():
                if capacity and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not met:
            return set(level)
        untried = {k: list(arcs[k]) for k in level}
        for start in [k for k, depth in level.items() if depth == 0]:
            path = [start]
            while path and supply[start]:
                node = path[-1]
                if demand.get(node, 0):
                    steps = list(zip(path, path[1:]))
                    sent = min(supply[start], demand[node], *(arcs[a][b] for a, b in steps)) if steps else min(supply[start], demand[node])
                    supply[start] -= sent
                    demand[node] -= sent
                    for a, b in steps:
                        arcs[a][b] -= sent
                        arcs[b][a] += sent
                    full = next((i for i, (a, b) in enumerate(steps) if not arcs[a][b]), None)
                    if full is not None:
                        del path[full + 1 :]
                    continue
                # An arc stays the one to try until it is full or leads nowhere.
                ahead = untried[node]
                while ahead and not (arcs[node][ahead[-1]] and level[ahead[-1]] == level[node] + 1):
                    ahead.pop()
                if ahead:
                    path.append(ahead[-1])
                else:
                    path.pop()
                    if path:
                        untried[path[-1]].pop()


def label(leaning: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    ``leaning`` has, for each node, its capacity from the source (positive) or to the sink
    (negative); only their difference matters to a cut. ``edges`` are (a, b, capacity), both ways.
    Nodes that may stand on either side go to the sink's.
    """
    graph = _Graph(leaning, edges)
    folded, left = _fold(graph)
    source = _flow(graph, left)
    for node, pull, near in reversed(folded):
        at_sink = sum(back for b, _, back in near if b in source)
        if pull + sum(out for b, out, _ in near if b not in source) < at_sink:
            source.add(node)
    return [k in source for k in range(len(leaning))]
