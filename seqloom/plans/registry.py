"""Stages by name: which function selects anchors, clusters them, reorders clusters, embeds blocks."""

from __future__ import annotations

from collections.abc import Callable

_STAGES: dict[str, dict[str, Callable]] = {}


def register(stage: str, name: str) -> Callable[[Callable], Callable]:
    """Decorator that enters a function of a stage under a name; a name may be taken once."""

    def enter(function: Callable) -> Callable:
        known = _STAGES.setdefault(stage, {})
        if name in known:
            raise ValueError(f"{stage} {name!r} is taken")
        known[name] = function
        return function

    return enter


def stage(kind: str, name: str) -> Callable:
    """The function of a stage."""
    try:
        return _STAGES[kind][name]
    except KeyError:
        raise ValueError(f"no {kind} {name!r}; there are {sorted(_STAGES.get(kind, {}))}") from None


def names(kind: str) -> list[str]:
    return sorted(_STAGES.get(kind, {}))
