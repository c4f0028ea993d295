"""SQL equivalents of the registered queries, composed from named common table expressions."""

from __future__ import annotations

import re

from blockpulse.fixtures import oracle_ctes

CTES: dict[str, str] = dict(oracle_ctes())


def define(name: str, sql: str) -> None:
    """Add a named expression; it may use any name defined before it."""
    CTES[name] = sql.strip()


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{re.escape(name)}\b", text) is not None


def compose(body: str) -> str:
    """`body` preceded by every named expression it needs, in definition order."""
    names = list(CTES)
    needed: list[str] = []
    text = body
    for name in reversed(names):
        if _mentions(text, name):
            needed.append(name)
            text += "\n" + CTES[name]
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in reversed(needed))
    body = body.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return f"{opening}{parts},\n{body[len(opening):]}"
    return f"WITH {parts}\n{body}"
