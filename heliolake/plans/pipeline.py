"""A registry of named nodes, each a function of other nodes to a lazy DataFrame: run, config, cache, lineage."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Node:
    name: str
    make: Callable[..., Any]
    needs: tuple[str, ...]
    tags: dict[str, str] = field(default_factory=dict)
    when: dict[str, Any] = field(default_factory=dict)
    cache: bool = False


def merged(base: dict, over: dict) -> dict:
    """Deep merge: dictionaries are merged, everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_config(path: str) -> dict[str, Any]:
    """JSON config, flat or nested by category; categories are flattened."""
    raw = json.loads(Path(path).read_text())
    out: dict[str, Any] = {}
    for k, v in raw.items():
        out.update(v) if isinstance(v, dict) else out.update({k: v})
    return out


class Pipeline:
    """Parameters of a node's function are its inputs; the function's name is the node's."""

    def __init__(self) -> None:
        self._nodes: dict[str, list[Node]] = {}
        self._kept: dict[tuple[str, str], Any] = {}

    def node(self, name: str | None = None, tags: dict[str, str] | None = None, when: dict[str, Any] | None = None, cache: bool = False) -> Callable:
        """Register a function; ``when`` makes it a variant that holds for a config."""

        def add(f: Callable) -> Callable:
            n = Node(name or f.__name__, f, tuple(inspect.signature(f).parameters), tags or {}, when or {}, cache)
            self._nodes.setdefault(n.name, []).append(n)
            return f

        return add

    def names(self, **tags: str) -> list[str]:
        return sorted(k for k, v in self._nodes.items() if any(all(n.tags.get(t) == x for t, x in tags.items()) for n in v))

    def _pick(self, name: str, config: dict[str, Any]) -> Node | None:
        fit = [n for n in self._nodes.get(name, []) if all(config.get(k) == v for k, v in n.when.items())]
        return max(fit, key=lambda n: len(n.when)) if fit else None

    def run(self, outputs: list[str], inputs: dict[str, Any] | None = None, overrides: dict[str, Any] | None = None) -> dict[str, Any]:
        """Values of the outputs; inputs double as config and stand for nodes of the same name."""
        config = dict(inputs or {})
        done: dict[str, Any] = {**config, **(overrides or {})}
        stamp = hashlib.sha256(repr(sorted((k, repr(v)) for k, v in config.items())).encode()).hexdigest()

        def value(name: str, path: tuple[str, ...]) -> Any:
            if name in path:
                raise ValueError("cycle: " + " -> ".join([*path, name]))
            if name not in done:
                n = self._pick(name, config)
                if n is None:
                    raise KeyError(f"no node or input {name}")
                if n.cache and (name, stamp) in self._kept:
                    done[name] = self._kept[name, stamp]
                else:
                    got = n.make(**{p: value(p, (*path, name)) for p in n.needs})
                    if n.cache:
                        got = got.persist() if isinstance(got, DataFrame) else got
                        self._kept[name, stamp] = got
                    done[name] = got
            return done[name]

        return {o: value(o, ()) for o in outputs}

    def forget(self) -> None:
        """Drop all cached values."""
        for v in self._kept.values():
            if isinstance(v, DataFrame):
                v.unpersist()
        self._kept.clear()

    def upstream(self, name: str) -> set[str]:
        """Everything a node depends on, inputs included."""
        out: set[str] = set()
        todo = [name]
        while todo:
            for n in self._nodes.get(todo.pop(), []):
                for p in n.needs:
                    if p not in out:
                        out.add(p)
                        todo.append(p)
        return out

    def downstream(self, name: str) -> set[str]:
        """Every node that depends on a name."""
        return {k for k in self._nodes if name in self.upstream(k)}

    def between(self, first: str, last: str) -> set[str]:
        """Nodes on any path from one to the other."""
        on = (self.downstream(first) & self.upstream(last)) | {first, last}
        return on if first in self.upstream(last) else set()
