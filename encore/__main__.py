"""Run a registered query from the command line.

    python -m encore list
    python -m encore <query> <sf_dir> [--out PATH] [--show N] [--explain]

With ``--out`` the result is written as parquet (overwrite); otherwise the
first ``--show`` rows are printed. On a cluster, submit with spark-submit and
leave the master unset.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from encore.plans import registry

    qs = registry.queries()
    p = argparse.ArgumentParser(prog="python -m encore")
    p.add_argument("query", help="query name, or 'list'")
    p.add_argument("sf_dir", nargs="?", help="folder with the base parquet tables")
    p.add_argument("--out", help="write the result here as parquet")
    p.add_argument("--show", type=int, default=20, help="rows to print when not writing")
    p.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    p.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[8]")
    a = p.parse_args(argv)
    if a.query == "list":
        for name in qs:
            print(name)
        return 0
    if a.query not in qs or not a.sf_dir:
        p.error(f"unknown query {a.query!r} or missing sf_dir; try 'list'")

    from encore.session import build_session
    spark = build_session(master=a.master, app=f"encore-{a.query}")
    df = qs[a.query](spark, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(f"wrote {a.query} to {a.out}")
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
