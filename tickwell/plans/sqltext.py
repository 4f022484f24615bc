"""Named SQL common-table expressions with dependencies.

Oracles are assembled from these: ``compose(final_select, "fact_stock_price")``
emits every CTE the final SELECT needs, in dependency order, under one
``WITH RECURSIVE`` head (DuckDB accepts plain CTEs there too).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Cte:
    name: str
    body: str
    deps: tuple[str, ...] = ()
    columns: str | None = None       # column list for recursive CTEs
    materialized: bool = False


@dataclass
class CteSet:
    ctes: dict[str, Cte] = field(default_factory=dict)

    def add(self, name: str, body: str, deps=(), columns=None, materialized=False) -> None:
        self.ctes[name] = Cte(name, body.strip(), tuple(deps), columns, materialized)

    def _order(self, needed) -> list[str]:
        out: list[str] = []
        seen: set[str] = set()

        def visit(n: str) -> None:
            if n in seen:
                return
            seen.add(n)
            for d in self.ctes[n].deps:
                visit(d)
            out.append(n)

        for n in needed:
            visit(n)
        return out

    def compose(self, final_select: str, *needed: str) -> str:
        parts = []
        for n in self._order(needed):
            c = self.ctes[n]
            head = f"{n}({c.columns})" if c.columns else n
            mat = " MATERIALIZED" if c.materialized else ""
            parts.append(f"{head} AS{mat} (\n{c.body}\n)")
        return "WITH RECURSIVE\n" + ",\n".join(parts) + "\n" + final_select.strip()
