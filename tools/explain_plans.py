"""Print ``explain("formatted")`` for registered queries.

Usage: python tools/explain_plans.py [sf_dir] [name ...]   (default: bench headline queries)
Streaming queries run their stream first (they return the sink table).
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from bench import HEADLINE  # noqa: E402
from scriptorium.plans import registry  # noqa: E402
from scriptorium.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(HEADLINE)
    spark = build_session("local[8]", shuffle_partitions=16)
    qs = registry.all_queries()
    for name in names:
        print(f"===== {name} =====")
        qs[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
