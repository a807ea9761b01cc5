"""Running best k per question inside one task."""

from __future__ import annotations

import numpy as np


class BestK:
    """Keeps the ``k`` smallest (cost, id) of each question, whatever is offered in between.

    ``worst`` is the largest cost kept of a question that has ``k``, before that what is given or else infinite:
    nothing dearer gets in.
    """

    def __init__(self, questions: int, k: int, worst: np.ndarray | None = None):
        self.k = k
        self.cost = [np.empty(0)] * questions
        self.ids = [np.empty(0, dtype=np.int64)] * questions
        self.worst = np.full(questions, np.inf) if worst is None else worst.copy()

    def offer(self, question: int, cost: np.ndarray, ids: np.ndarray) -> None:
        cost = np.concatenate([self.cost[question], cost])
        ids = np.concatenate([self.ids[question], ids])
        if len(cost) > self.k:
            near = cost <= np.partition(cost, self.k - 1)[self.k - 1]
            cost, ids = cost[near], ids[near]
            order = np.lexsort((ids, cost))[: self.k]
            cost, ids = cost[order], ids[order]
        self.cost[question], self.ids[question] = cost, ids
        if self.k and len(cost) == self.k:
            self.worst[question] = min(self.worst[question], cost.max())

    def columns(self, qids: np.ndarray, sign: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, id, sign * cost) of everything kept."""
        sizes = [len(c) for c in self.cost]
        cost, ids = np.concatenate(self.cost), np.concatenate(self.ids)
        return np.repeat(qids, sizes), ids, sign * cost + 0.0
