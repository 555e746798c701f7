"""Min-cost flow by successive cheapest paths, for small graphs."""

from __future__ import annotations

from collections import deque

INF = float("inf")


class FlowNetwork:
    """Directed arcs with integer capacity and cost per unit."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[float] = []

    def arc(self, a: int, b: int, capacity: int, cost: float) -> int:
        for x, y, cap, c in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(cap)
            self.cost.append(c)
        return len(self.to) - 2

    def used(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def send(self, source: int, sink: int) -> int:
        """Send all the flow there is room for, cheapest paths first."""
        total = 0
        while True:
            dist, via = [INF] * len(self.out), [-1] * len(self.out)
            dist[source], queue, queued = 0, deque([source]), [False] * len(self.out)
            while queue:
                x = queue.popleft()
                queued[x] = False
                for e in self.out[x]:
                    y, d = self.to[e], dist[x] + self.cost[e]
                    if self.room[e] > 0 and d < dist[y] - 1e-12:
                        dist[y], via[y] = d, e
                        if not queued[y]:
                            queued[y] = True
                            queue.append(y)
            if dist[sink] == INF:
                return total
            push, x = INF, sink
            while x != source:
                push = min(push, self.room[via[x]])
                x = self.to[via[x] ^ 1]
            x = sink
            while x != source:
                self.room[via[x]] -= push
                self.room[via[x] ^ 1] += push
                x = self.to[via[x] ^ 1]
            total += push
