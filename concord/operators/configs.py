"""Checks over a handful of connector settings, on the driver."""

from __future__ import annotations

import heapq


def connector_order(depends_on: dict[str, list[str]]) -> list[str]:
    """Connectors after all they depend on, ties by name. Unknown dependencies don't count; a cycle raises ValueError."""
    open_deps = {name: {d for d in deps if d in depends_on} for name, deps in depends_on.items()}
    ready, out = sorted(n for n, deps in open_deps.items() if not deps), []
    while ready:
        name = heapq.heappop(ready)
        out.append(name)
        for other, deps in open_deps.items():
            if name in deps:
                deps.remove(name)
                if not deps:
                    heapq.heappush(ready, other)
    if len(out) < len(depends_on):
        raise ValueError(f"circular dependency among {sorted(set(depends_on) - set(out))}")
    return out


def required_scopes(datatypes: dict[str, dict[str, list[str]]]) -> list[str]:
    """All scopes that datatypes need, sorted; each datatype has ``read`` and ``write`` lists."""
    return sorted({s for d in datatypes.values() for kind in ("read", "write") for s in d.get(kind, [])})


def missing_scopes(granted: list[str], datatypes: dict[str, dict[str, list[str]]]) -> list[str]:
    """Scopes that are needed but not granted; nothing if either side declares none."""
    return sorted(set(required_scopes(datatypes)) - set(granted)) if granted else []
