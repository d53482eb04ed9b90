
import json
import sys


def main(path: str, repeat: str) -> None:
    d = json.load(open(path))
    rows = sorted(d["queries"].items(), key=lambda kv: -kv[1])
    print(f"Measured with `bench.py` at sf{d['sf']} (lineitem ~600,000 rows, events 100,000) on "
          f"local[{d['cpus']}], one JVM, AQE on; each query fully executed into the `noop` sink; "
          f"median of {repeat} run(s) per query.\n")
    print(f"| metric | value |\n|---|---|\n| queries | {d['n_queries']} |\n"
          f"| total seconds (sum of per-query medians) | {d['value']} |\n"
          f"| mean seconds per query | {d['value'] / d['n_queries']:.2f} |\n")
    print("| query | sec |\n|---|---|")
    for k, v in rows:
        print(f"| {k} | {v} |")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "1")
