"""python -m cloakwork run --policy P --run-id R [--resume] | verify --policy P --run-id R | --version"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from . import __version__
from .errors import CloakError


def main(argv: Sequence[str] | None = None) -> int:
    """Exit code: 0 passed, 2 policy, 3 generation, 4 transformation, 5 verification, 6 anything else."""
    parser = argparse.ArgumentParser(prog="cloakwork")
    parser.add_argument("--version", action="version", version=__version__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "verify"):
        p = commands.add_parser(name)
        p.add_argument("--policy", required=True)
        p.add_argument("--run-id", required=True)
        if name == "run":
            p.add_argument("--resume", action="store_true")
    args = parser.parse_args(argv)
    try:
        from pyspark.sql import SparkSession

        from .plans.policy import load
        from .plans.stages import run_masking, verify_run
        from .sources.jdbc_catalog import open_catalog

        policy = load(args.policy)
        spark = SparkSession.builder.getOrCreate()
        size = policy.verifier_fetch_size if args.command == "verify" else policy.collector_fetch_size
        arguments = (spark, policy, os.environ, lambda session, place: open_catalog(session, place, size), args.run_id)
        run_masking(*arguments, args.resume) if args.command == "run" else verify_run(*arguments)
        return 0
    except Exception as e:  # only our own errors may be shown: others may hold values
        known = isinstance(e, CloakError)
        sys.stderr.write(f"error: {e if known else 'internal failure'}\n")
        return e.exit_code if known else 6


if __name__ == "__main__":
    sys.exit(main())
