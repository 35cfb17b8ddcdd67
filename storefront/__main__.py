"""Run registered queries and print their results.

    python -m storefront                          # list the queries
    python -m storefront <query> [sf_dir] [rows]  # run one, in its statement's order

Only the printed rows reach the driver (``show``); the query itself runs on
Spark like any other.
"""

from __future__ import annotations

import sys

from storefront.plans import registry


def main(argv: list[str]) -> int:
    names = registry.queries()
    if not argv:
        for name, fn in names.items():
            first_line = (fn.__doc__ or "").strip().splitlines()[:1]
            print(f"{name:34} {first_line[0] if first_line else ''}")
        return 0
    name = argv[0]
    if name not in names:
        print(f"unknown query {name!r}; run without arguments for the list", file=sys.stderr)
        return 2
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    rows = int(argv[2]) if len(argv) > 2 else 20
    from storefront.session import build_session
    spark = build_session()
    registry.ordered(name, names[name](spark, sf_dir)).show(rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
