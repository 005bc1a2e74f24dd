"""Stands in for the service in the benchmark: pages that ``inputs.save_pages`` wrote below the shared folder."""

from __future__ import annotations

import json
import os


def fetch_saved(date_range: str, skip: int, limit: int, options: dict) -> str | None:
    """Rows ``skip`` to ``skip + limit`` of a saved window, put together from its files of a hundred rows."""
    digits = "".join(c for c in date_range if c.isdigit())
    folder = os.path.join(options["folder"].removeprefix("file:"), f"window={digits}")
    if not os.path.isdir(folder):
        return None
    total, results = 0, []
    for start in range(skip // 100 * 100, skip + limit, 100):
        where = os.path.join(folder, f"skip={start}")
        names = sorted(n for n in os.listdir(where) if n.startswith("part-")) if os.path.isdir(where) else []
        if names:
            with open(os.path.join(where, names[0]), encoding="utf-8") as page:
                envelope = json.load(page)
            total = envelope["meta"]["results"]["total"]
            results += envelope["results"][max(0, skip - start):skip + limit - start]
    return json.dumps({"meta": {"results": {"total": total}}, "results": results}) if results else None
