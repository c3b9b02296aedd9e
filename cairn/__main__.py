"""``python -m cairn steps.json``: run a step chain file on the active session."""

import sys

from pyspark.sql import SparkSession

from .plans.steps import run_steps_file


def main(argv: list[str]) -> int:
    if len(argv) != 2:
        print("usage: python -m cairn STEPS.json", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("cairn-steps").getOrCreate()
    outputs = run_steps_file(spark, argv[1])
    for name, value in outputs.items():
        kind = type(value).__name__
        print(f"{name}: {kind}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
