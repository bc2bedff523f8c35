"""Every registered query against its oracle: ``python tests/check_all.py [sf_dir] [name ...]``."""

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con, texts, bad = local_session(), connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, texts[name]) if name in texts else []
            if name not in texts:
                df.count()
        except Exception:
            problems = [traceback.format_exc()[-1500:]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t0:.2f}s"
              f"{'' if name in texts else ' (rows only)'}", *problems, sep="\n  " if problems else "", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
