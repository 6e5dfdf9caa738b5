"""One layer of the refresh as a job, for ``spark-submit`` or ``python -m strata.run``.

    spark-submit strata/run.py bronze --csv-dir s3a://bucket/retail
    spark-submit strata/run.py silver
    spark-submit strata/run.py gold
    spark-submit strata/run.py platinum

Each job first runs the gate of the layer before on its written tables and ends with its own
gate; a failed gate is a failed job (exit status 1), so a retry starts at the same gate.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.operators.quality import DQError  # noqa: E402
from strata.plans.bronze import read_sources  # noqa: E402
from strata.plans.refresh import LAYERS, refresh_all  # noqa: E402
from strata.session import build_session  # noqa: E402


def main(args: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("layer", choices=LAYERS)
    parser.add_argument("--csv-dir", help="folder of the source files (bronze)")
    parser.add_argument("--jdbc-url", help="database of the sources instead (bronze)")
    parser.add_argument("--prefix", default="", help="put before the names of the namespaces")
    parser.add_argument("--purchase-window", nargs=2, metavar=("FROM", "TO"))
    parser.add_argument("--calendar", nargs=2, metavar=("FROM", "TO"),
                        help="without it the calendar covers the orders")
    parser.add_argument("--run-id", help="name of the run: the same when it is tried again")
    given = parser.parse_args(args)
    spark = spark or build_session(f"strata-{given.layer}")
    raw = None
    if given.layer == "bronze":
        if not (given.csv_dir or given.jdbc_url):
            parser.error("bronze needs --csv-dir or --jdbc-url")
        raw = read_sources(spark, "csv", directory=given.csv_dir) if given.csv_dir else \
            read_sources(spark, "jdbc", url=given.jdbc_url)
    try:
        refresh_all(spark, raw, tuple(given.calendar) if given.calendar else None,
                    namespace_prefix=given.prefix, start_at=given.layer, stop_after=given.layer,
                    purchase_window=tuple(given.purchase_window) if given.purchase_window else None,
                    csv_dir=given.csv_dir, run_id=given.run_id)
    except DQError as failed:
        print(failed, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
