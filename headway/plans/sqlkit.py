"""Tiny helper that assembles WITH-clauses from named, dependent CTEs."""

from __future__ import annotations

import re


class CteBook:
    """Named CTE bodies; ``query(final, uses)`` emits WITH <deps in order> final."""

    def __init__(self) -> None:
        self._bodies: dict[str, str] = {}
        self._order: list[str] = []

    def add(self, name: str, body: str) -> None:
        if name in self._bodies:
            raise ValueError(f"duplicate CTE {name}")
        self._bodies[name] = body.strip()
        self._order.append(name)

    def _deps(self, body: str) -> set[str]:
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
        return {n for n in self._bodies if n in words}

    def query(self, final: str, uses: list[str] | None = None) -> str:
        wanted: set[str] = set()
        stack = list(uses or []) + sorted(self._deps(final))
        while stack:
            name = stack.pop()
            if name in wanted:
                continue
            wanted.add(name)
            stack.extend(d for d in self._deps(self._bodies[name]) if d != name)
        ordered = [n for n in self._order if n in wanted]
        if not ordered:
            return final.strip()
        ctes = ",\n".join(f"{n} AS (\n{self._bodies[n]}\n)" for n in ordered)
        return f"WITH {ctes}\n{final.strip()}"
