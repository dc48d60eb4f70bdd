"""Print the formatted physical plan of every registered query (or the named ones).

    python tests/plan_report.py [sf_dir] [name ...]

Note: the K-Means queries run their fit (small jobs) while the plan of the returned frame is built.
"""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    import __spark_entry__ as E
    from centroidal.session import get_session
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)] or sorted(E.queries())
    spark = get_session("local[8]", 8)
    for name in names:
        df = E.queries()[name](spark, sf_dir)
        print(f"===== {name}")
        df.explain("formatted")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
