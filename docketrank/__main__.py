"""``spark-submit`` / ``python -m docketrank`` entry: run all steps or one of them."""

from __future__ import annotations

import argparse

from docketrank.plans.refresh import Refresh
from docketrank.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="docketrank", description="Rank facilities from public register extracts")
    parser.add_argument("step", choices=["load", "profile", "model", "mart", "answer", "run"])
    parser.add_argument("--warehouse", required=True, help="folder of the layers, on shared storage")
    parser.add_argument("--exports", required=True, help="folder of the reports")
    parser.add_argument("--registry", help="registry CSV file or folder (load, run)")
    parser.add_argument("--actions", help="action log CSV file or folder (load, run)")
    parser.add_argument("--top", type=int, default=25, help="length of the ranked list (answer, run)")
    parser.add_argument(
        "--two-digit-year", choices=["literal", "pivot"], default="literal", help="how 12/29/16 is read (model, run)"
    )
    parser.add_argument(
        "--multi-line", choices=["auto", "yes", "no"], default="auto", help="whether fields hold line breaks (load, run)"
    )
    given = parser.parse_args()
    if given.step in ("load", "run") and not (given.registry and given.actions):
        parser.error(f"{given.step} needs --registry and --actions")

    refresh = Refresh(build_session(), given.warehouse, given.exports)
    multi_line = {"auto": None, "yes": True, "no": False}[given.multi_line]
    if given.step == "run":
        refresh.run(given.registry, given.actions, given.top, given.two_digit_year, multi_line)
    elif given.step == "load":
        refresh.load(given.registry, given.actions, multi_line)
    elif given.step == "model":
        refresh.model(given.two_digit_year)
    elif given.step == "answer":
        refresh.answer(given.top)
    else:
        getattr(refresh, given.step)()
    for written, count in refresh.rows.items():
        print(f"wrote {count} to {written}")


if __name__ == "__main__":
    main()
