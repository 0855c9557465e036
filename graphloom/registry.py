"""Named functions: mutations (Column to Column), target specifiers, edge properties, report filters, sources and arguments."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class Registry:
    def __init__(self, what: str):
        self.what, self.found = what, {}

    def __call__(self, name: str) -> Callable:
        def keep(f: Callable) -> Callable:
            self.found[name] = f
            return f

        return keep

    def get(self, name: str) -> Callable:
        if name not in self.found:
            raise KeyError(f"no {self.what} named {name}")
        return self.found[name]

    def names(self) -> list[str]:
        return sorted(self.found)


mutations, specifiers, edge_properties, report_filters, sources = (Registry(x) for x in ("mutation", "specifier", "edge property", "report filter", "source"))


def arguments(given: dict[str, Any], provided: dict[str, Any]) -> dict[str, Any]:
    """Query arguments: a literal, {"provided": name} from the caller, or {"function": f} called with what is provided."""
    out = {}
    for name, value in given.items():
        if isinstance(value, dict) and "provided" in value:
            value = provided[value["provided"]]
        elif isinstance(value, dict) and "function" in value:
            value = value["function"](**provided)
        out[name] = value
    return out


def merged(left: Any, right: Any) -> Any:
    """A deep merge: maps recurse, lists are joined, other values are replaced."""
    if isinstance(left, dict) and isinstance(right, dict):
        return {k: merged(left[k], right[k]) if k in left and k in right else right.get(k, left.get(k)) for k in {**left, **right}}
    if isinstance(left, list) and isinstance(right, list):
        return left + right
    return right
