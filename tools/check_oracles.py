"""Run every registered query against its oracle: python tools_check.py [sf] [key ...]"""

import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import oracle  # noqa: E402

from tidegauge.queries import ORACLES, QUERIES  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    keys = sys.argv[2:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), oracle.connect(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in ORACLES:
                message = oracle.difference(df, con, ORACLES[key])
                rows = con.execute(f"SELECT count(*) FROM ({ORACLES[key]})").fetchall()[0][0]
            else:
                message, rows = None, df.count()
        except Exception as error:
            message, rows = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += message is not None
        state = "ok" if message is None else "FAIL"
        print(f"\r{key:28s} {state:5s} rows={rows} {time.time() - start:.1f}s {message or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} failed, {sum(k not in ORACLES for k in keys)} without oracle")


if __name__ == "__main__":
    main()
