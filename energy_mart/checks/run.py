"""Compare queries on both engines: python -m energy_mart.checks.run SF_DIR [name ...]."""

import sys

from energy_mart.checks import catalogue
from energy_mart.checks.compare import compare
from energy_mart.session import build_session


def main(sf_dir: str, *names: str) -> int:
    spark = build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue.queries()
    chosen = [q for q in known if not names or any(q.startswith(n) for n in names)]
    failed = 0
    for name in chosen:
        try:
            result = compare(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            result = {"problems": [f"{type(error).__name__}: {str(error)[:600]}"]}
        failed += bool(result["problems"])
        print("FAIL" if result["problems"] else "ok", name, result, flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
