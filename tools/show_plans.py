"""Print the formatted physical plan of registered queries.

    python tools/show_plans.py /root/testdata/sf0.01 class_popularity dump_stats
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from rosterlens.plans.registry import QUERIES
    from rosterlens.session import build_session

    spark = build_session("local[8]", 8)
    for name in argv[2:] or list(QUERIES):
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
