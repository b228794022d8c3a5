"""A small task graph: order, trigger rules, branches, sensors, retries, and a record of what ran."""

from __future__ import annotations

import heapq
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

# The states of tasks.
SUCCESS, FAILED, SKIPPED, UPSTREAM_FAILED = "success", "failed", "skipped", "upstream_failed"


class DagError(ValueError):
    """A graph that can't be run."""


class Skip(Exception):
    """Raised by a task that has nothing to do."""


def _broken(seen: Counter) -> int:
    return seen[FAILED] + seen[UPSTREAM_FAILED]


# The names of the trigger rules.
#: For each rule what bars a task, by how often each state stands before it: (state taken, when).
TRIGGERS: dict[str, list[tuple[str, Callable[[Counter], Any]]]] = {
    "all_success": [(UPSTREAM_FAILED, _broken), (SKIPPED, lambda seen: seen[SKIPPED])],
    "none_failed_min_one_success": [(UPSTREAM_FAILED, _broken), (SKIPPED, lambda seen: not seen[SUCCESS])],
    "all_done": [],
}


def barred(rule: str, before: list[str]) -> str | None:
    """The state that a task takes without running, if its rule bars it; a task without upstream runs."""
    seen = Counter(before)
    return next((state for state, holds in TRIGGERS[rule] if before and holds(seen)), None)


@dataclass(frozen=True)
class Task:
    """``run`` gets the context.

    A branch returns the names of the tasks to follow. A sensor returns a truth; it is asked again
    every ``wait`` seconds for ``patience`` seconds, and is skipped if it stays false. A trigger
    returns the names of graphs that are to run next; ``run`` gathers them under ``triggered``.
    """

    name: str
    run: Callable[[dict], Any]
    after: tuple[str, ...] = ()
    rule: str = "all_success"
    kind: str = "task"  # or branch, sensor, trigger
    retries: int = 0
    wait: float = 0.0
    patience: float = 0.0


@dataclass
class Dag:
    name: str
    tasks: list[Task] = field(default_factory=list)

    def order(self) -> list[Task]:
        """Tasks after all that they follow; of those that are ready the one added first."""
        place = {t.name: i for i, t in enumerate(self.tasks)}
        if len(place) < len(self.tasks):
            raise DagError(f"{self.name}: a task stands twice")
        open_edges, followers = [0] * len(self.tasks), [[] for _ in self.tasks]
        for i, t in enumerate(self.tasks):
            if t.rule not in TRIGGERS:
                raise DagError(f"{t.name}: unknown rule {t.rule}")
            for upstream in set(t.after):
                if upstream not in place:
                    raise DagError(f"{t.name}: unknown upstream {upstream}")
                followers[place[upstream]].append(i)
                open_edges[i] += 1
        ready = [i for i, n in enumerate(open_edges) if not n]
        out = []
        while ready:
            i = heapq.heappop(ready)
            out.append(self.tasks[i])
            for j in followers[i]:
                open_edges[j] -= 1
                if not open_edges[j]:
                    heapq.heappush(ready, j)
        if len(out) < len(self.tasks):
            raise DagError(f"{self.name}: a cycle through {', '.join(sorted(t.name for i, t in enumerate(self.tasks) if open_edges[i]))}")
        return out


def _tried(task: Task, context: dict, sleep: Callable[[float], None]) -> dict:
    """What one task came to: state, tries, result, error."""
    tries, asked = 0, 0.0
    while True:
        tries += 1
        try:
            result = task.run(context)
        except Skip:
            return {"state": SKIPPED, "tries": tries, "result": None, "error": None}
        except Exception as e:
            if tries <= task.retries:
                sleep(task.wait)
                continue
            return {"state": FAILED, "tries": tries, "result": None, "error": f"{type(e).__name__}: {e}"}
        if task.kind != "sensor" or result:
            return {"state": SUCCESS, "tries": tries, "result": result, "error": None}
        asked += max(task.wait, 1e-3)
        if asked > task.patience:
            return {"state": SKIPPED, "tries": tries, "result": result, "error": None}
        sleep(task.wait)


def run(dag: Dag, context: dict, sleep: Callable[[float], None] = time.sleep, record: Callable[[dict], None] | None = None) -> dict[str, dict]:
    """Run a graph in its order; by task its state, tries, result, error, start and seconds.

    ``record`` is told each task's outcome as it ends, so that a run that dies leaves a trace.
    """
    out: dict[str, dict] = {}
    chosen: dict[str, set[str]] = {}  # of branches that ran, what they chose
    for task in dag.order():
        begun = time.monotonic()
        held = {"started": datetime.now(UTC).isoformat(timespec="seconds")}
        state = barred(task.rule, [out[u]["state"] for u in task.after])
        unchosen = [u for u in task.after if task.name not in chosen.get(u, {task.name})]
        if state is None and unchosen and (task.rule == "all_success" or len(unchosen) == len(task.after)):
            state = SKIPPED
        held |= {"state": state, "tries": 0, "result": None, "error": None} if state else _tried(task, context, sleep)
        held["seconds"] = round(time.monotonic() - begun, 3)
        out[task.name] = held
        if held["state"] == SUCCESS and task.kind in ("branch", "trigger"):
            said = held["result"] or ()
            names = [said] if isinstance(said, str) else list(said)
            if task.kind == "branch":
                chosen[task.name] = set(names)
            else:
                context.setdefault("triggered", []).extend(n for n in names if n not in context.get("triggered", ()))
        if record:
            record({"graph": dag.name, "task": task.name} | {k: held[k] for k in ("state", "tries", "error", "started", "seconds")})
    return out
