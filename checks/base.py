"""Compose a checking query from the sample views it needs."""

from __future__ import annotations

import re

from parcelmetrics.sources.sample import GENERATED, VIEWS


#: Steps computed once, however often they are named.
KEPT = {"paid", "charged", "bought", "single_terms", "fx_daily", "cost_top", "item_sums"}


def with_views(body: str, *steps: tuple[str, str]) -> str:
    """``WITH`` the sample views, then ``steps`` (name, sql), then ``body``.

    A sample view is written ``{name}``; generated tables keep their own name. Only views
    that are reached are written out.
    """
    chosen: list[str] = []

    def visit(text: str, inside_view: bool = False) -> None:
        for name in re.findall(r"\{(\w+)\}", text):
            # Inside a view, the name of a generated table means that table.
            if name not in chosen and not (inside_view and name in GENERATED):
                visit(VIEWS[name], True)
                chosen.append(name)

    def bind(text: str, inside_view: bool) -> str:
        def name_of(match: re.Match) -> str:
            name = match.group(1)
            return name if inside_view and name in GENERATED else f"v_{name}"

        return re.sub(r"\{(\w+)\}", name_of, text)

    for _, sql in steps:
        visit(sql)
    visit(body)
    parts = [f"v_{name} AS ({bind(VIEWS[name], True)})" for name in VIEWS if name in chosen]
    parts += [f"{name} AS {'MATERIALIZED ' if name in KEPT else ''}({bind(sql, False)})" for name, sql in steps]
    return f"WITH {', '.join(parts)} {bind(body, False)}" if parts else body
