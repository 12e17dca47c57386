"""Command line: list the queries, or run one over a data folder and write its rows.

    python -m loamstone list
    python -m loamstone run NAME DATA_FOLDER [OUT_FOLDER]
    python -m loamstone explain NAME DATA_FOLDER
"""

from __future__ import annotations

import sys

from loamstone.plans import catalogue


def main(args: list[str]) -> int:
    queries = catalogue.queries()
    if args[:1] == ["list"]:
        for name, f in sorted(queries.items()):
            print(name, "-", (f.__doc__ or "").strip().split("\n")[0])
        return 0
    if len(args) < 3 or args[0] not in ("run", "explain") or args[1] not in queries:
        print(__doc__)
        return 2
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    df = queries[args[1]](spark, args[2])
    if args[0] == "explain":
        df.explain("formatted")
    elif len(args) > 3:
        df.write.mode("errorifexists").parquet(args[3])
    else:
        df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
