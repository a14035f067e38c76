"""Independent DuckDB SQL for every registered query (the correctness oracle).

``render(sql, bodies)`` turns a query that names source tables and helper
bodies (``g_business``, ``d02_bid_stats`` …) into ONE self-contained DuckDB
statement over the driver's pre-registered carrier views: every referenced
fixture projection (padded to its contract like ``contracts.conform``) and
helper body becomes a CTE, in dependency order.
"""

from __future__ import annotations

import re

from ..sources.contracts import CONTRACTS, pad_key, pad_type, pad_value
from ..sources.fixtures import FIXTURE_COLUMNS, FIXTURE_SQL

def q(name: str) -> str:
    """Quote an identifier for DuckDB (keeps case, allows dots)."""
    return '"' + name.replace('"', '""') + '"'


def sql_list(values) -> str:
    out = []
    for v in values:
        if isinstance(v, str):
            out.append("'" + v.replace("'", "''") + "'")
        else:
            out.append(str(v))
    return "(" + ", ".join(out) + ")"


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def fixture_body(name: str) -> str:
    text = re.sub(r"\{(\w+)\}", r"\1", FIXTURE_SQL[name]).strip()
    have = {c for c, _ in FIXTURE_COLUMNS[name]}
    pads = [(c, pad_type(c)) for c in CONTRACTS.get(name, []) if c not in have]
    if not pads:
        return text
    key = q(pad_key(name, list(have)))
    cols = ", ".join(f"{pad_value(c, key)} as {q(c)}" for c, _ in pads)
    return f"select _fx.*, {cols} from (\n{text}\n) _fx"


def _refs(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"(?<![\w.\"']){re.escape(n)}(?![\w\"'])", text)]


def render(sql: str, bodies: dict[str, str]) -> str:
    registry = {**{n: None for n in FIXTURE_SQL}, **bodies}
    names = sorted(registry, key=len, reverse=True)
    texts: dict[str, str] = {}

    def text_of(n: str) -> str:
        if n not in texts:
            texts[n] = fixture_body(n) if registry[n] is None else registry[n].strip()
        return texts[n]

    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in _refs(text_of(n), [m for m in names if m != n]):
            visit(d)
        order.append(n)

    for n in _refs(sql, names):
        visit(n)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{text_of(n)}\n)" for n in order)
    return f"WITH {ctes}\n{sql.strip()}"
