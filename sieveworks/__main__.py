"""The command line: one run for a date, resumed where an earlier one of that date broke off."""

from __future__ import annotations

import argparse
import datetime
import os
import sys
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from .assets import process_judges, read_assets
from .config import LANES, from_environment, valid_date
from .judge import Judge, RuleJudge
from .pipeline import run_all
from .sources import boards, landed


class _ByLength:
    """A scorer without a model: longer texts fit better, up to 100."""

    def __call__(self, rows: list[dict], lane: str) -> list[dict]:
        return [{"url": r["url"], "fit_score": min(100, 35 + len(r.get("snippet") or "") // 20), "rationale": "by the length of the text"} for r in rows]


def _date(text: str) -> str:
    try:
        return valid_date(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"not a YYYY-MM-DD date: {text!r}") from e


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sieveworks", description=__doc__)
    p.add_argument("--date", type=_date, default=datetime.date.today().isoformat(), help="the run's date, YYYY-MM-DD")
    p.add_argument("--force", action="store_true", help="make every stage anew; answers in the ledger still count")
    p.add_argument("--root", required=True, help="folder of runs, reports, ledger, log and seen store")
    p.add_argument("--assets", required=True, help="folder of the criteria files and, if wanted, prompt templates")
    p.add_argument("--companies", help="the company list, CSV")
    p.add_argument("--board", default=boards.BOARD)
    p.add_argument("--feed", action="append", help="address or file of a feed; may be given again")
    p.add_argument("--search", default=boards.SEARCH)
    p.add_argument("--thread", default=boards.THREAD, help="address or file of a thread, with %%s for its number")
    p.add_argument("--rule", action="append", default=[], metavar="LANE:CATEGORY:PATTERN", help="judge by patterns instead of a program")
    return p


def main(argv: Sequence[str] | None = None, env: Mapping[str, str] | None = None, session: Callable[[], SparkSession] | None = None, judges: tuple[Judge, Judge] | None = None, **options) -> int:
    """0, or 1 if the run failed; settings come from config.from_environment()."""
    args = parser().parse_args(argv)
    env = os.environ if env is None else env
    config = from_environment(args.date, args.root, env, force=args.force)
    spark = (session or SparkSession.builder.appName("sieveworks").getOrCreate)()
    try:
        assets = read_assets(spark, args.assets, config.lanes)
        if judges is None and args.rule:
            rules: dict[str, list[tuple[str, str]]] = {}
            for lane, category, pattern in (r.split(":", 2) for r in args.rule):
                rules.setdefault(lane, []).append((category, pattern))
            judges = RuleJudge(rules), _ByLength()
        elif judges is None:
            if not config.judge_command:
                raise ValueError("a judge is needed: --rule, or a command in SIEVEWORKS_JUDGE")
            judges = process_judges(config.judge_command, config.model, assets, LANES)
        given = boards.sources(spark, f"{config.root.rstrip('/')}/landed/{config.run_date}", board=args.board, feeds=args.feed or boards.FEEDS, search=args.search, thread=args.thread)
        companies = (lambda: landed.companies(spark, args.companies)) if args.companies else None
        out = run_all(spark, config, given, companies, *judges, salt=assets.salt(config.model, *config.judge_command, *args.rule), **options)
    except Exception as e:
        print(f"run {config.run_date} failed: {e}", file=sys.stderr)
        return 1
    print(f"run {config.run_date}: {out.counts['matches']} matches, {out.counts['rejected']} rejected")
    return 0


if __name__ == "__main__":
    sys.exit(main())
