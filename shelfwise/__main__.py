"""Command line: run the weekly reports from raw report files.

    python -m shelfwise --feed feed.xml --ranking ranking.csv --ads ads/ \\
        --analytics analytics/ --analytics-sizes sizes/ --out warehouse/ \\
        [--run-date 2024-01-15] [--rates eurofxref-hist.csv --to-currency GBP] [--replace]
        [--gtin-clean | --feed-drop 2 --rank-drop 4] [--bad-documents folder/]

Each input may be a file or a folder (all files are one read).  The
analytics inputs are saved report responses (JSON lines, or one JSON
document per file with --multi-line).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from .functions.dates import reporting_week
from .operators.filters import US_ACCOUNT
from .operators.ordering import TOP_N
from .plans.run_ledger import publish_weekly
from .plans.weekly import WeeklyInputs, run_weekly
from .session import get_spark, scale_settings
from .sources.ads import read_ads
from .sources.analytics import ANALYTICS_RENAMES, flatten_responses, read_responses, rename_fields
from .sources.feed import MARGIN_FIELD, read_feed
from .sources.popular import read_ranking
from .sources.rates import read_rates

ANALYTICS_FIELDS = ["ga:date", "ga:productName", "ga:productSku", "ga:country", "ga:itemRevenue",
                    "ga:buyToDetailRate", "ga:quantityAddedToCart", "ga:itemQuantity", "ga:uniquePurchases"]
SIZE_FIELDS = ANALYTICS_FIELDS + ["ga:dimensionX", "ga:productCategoryLevelX"]


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="shelfwise", description="Run the weekly product reports.")
    ap.add_argument("--feed", required=True)
    ap.add_argument("--ranking", required=True)
    ap.add_argument("--ads", required=True)
    ap.add_argument("--analytics", required=True)
    ap.add_argument("--analytics-sizes", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", type=_dt.date.fromisoformat, default=_dt.date.today())
    ap.add_argument("--snap", action="store_true", help="use the previous calendar week on any run day")
    ap.add_argument("--account", default=US_ACCOUNT)
    ap.add_argument("--top", type=int, default=TOP_N)
    ap.add_argument("--margin-field", default=MARGIN_FIELD)
    ap.add_argument("--size-field", default="ga:dimensionX", help="report field holding the size")
    ap.add_argument("--category-field", default="ga:productCategoryLevelX")
    ap.add_argument("--rates")
    ap.add_argument("--from-currency", default="USD")
    ap.add_argument("--to-currency", default="USD")
    ap.add_argument("--feed-drop", type=int, default=2, help="trailing characters that feed GTINs lose in the match")
    ap.add_argument("--rank-drop", type=int, default=4, help="the same for ranking GTINs")
    ap.add_argument("--gtin-clean", action="store_true",
                    help="match GTINs as text without a decimal ending; short codes match nothing")
    ap.add_argument("--bad-documents", help="folder for analytics documents that do not parse (default: stop); "
                    "feed items that do not go to the folder of that name with -feed")
    ap.add_argument("--multi-line", action="store_true")
    ap.add_argument("--replace", action="store_true", help="replace this week's partitions on a re-run")
    ap.add_argument("--run-id", help="publish the six tables as one run of this name, with a ledger")
    ap.add_argument("--input-bytes", type=int, help="approximate input size: applies scale_settings()")
    ap.add_argument("--cores", type=int, default=8, help="executor cores, with --input-bytes")
    args = ap.parse_args(argv)
    if args.from_currency != args.to_currency and not args.rates:
        ap.error("--to-currency needs --rates")
    if args.run_id and args.replace:
        ap.error("a published run replaces by its ledger: --run-id goes without --replace")
    return args


def load_inputs(spark, args: argparse.Namespace) -> WeeklyInputs:
    bad_items = f"{args.bad_documents.rstrip('/')}-feed" if args.bad_documents else None
    feed = read_feed(spark, args.feed, "all", margin_field=args.margin_field, divert_to=bad_items)
    ranking = read_ranking(spark, args.ranking, args.run_date, args.snap, gtin_text=args.gtin_clean)
    ads = read_ads(spark, args.ads)
    renames = {**ANALYTICS_RENAMES, args.size_field: "size", args.category_field: "productType"}
    responses = lambda path: read_responses(spark, path, args.multi_line, args.bad_documents)
    analytics = rename_fields(flatten_responses(responses(args.analytics), ANALYTICS_FIELDS), renames)
    sizes = rename_fields(flatten_responses(responses(args.analytics_sizes),
                                            [*ANALYTICS_FIELDS, args.size_field, args.category_field]), renames)
    rates = read_rates(spark, args.rates) if args.rates else None
    return WeeklyInputs(feed, ranking, ads, analytics, sizes, rates)


def main(argv: list[str] | None = None) -> dict[str, str]:
    args = parse_args(argv)
    spark = get_spark("shelfwise-weekly")
    if args.input_bytes:
        for key, value in scale_settings(args.input_bytes, args.cores).items():
            spark.conf.set(key, value)
    options = dict(top=args.top, account=args.account, from_ccy=args.from_currency, to_ccy=args.to_currency,
                   snap=args.snap, feed_drop=args.feed_drop, rank_drop=args.rank_drop, clean=args.gtin_clean)
    inputs = load_inputs(spark, args)
    if args.run_id:
        new = publish_weekly(inputs, args.run_date, args.out, args.run_id, **options)
        paths = {"run": args.run_id, "new": new}
    else:
        paths = run_weekly(inputs, args.run_date, args.out, replace=args.replace, **options)
    week = reporting_week(args.run_date, args.snap)
    print(json.dumps({"run_date": str(args.run_date), "week": [str(week[0]), str(week[-1])], "tables": paths}))
    return paths


if __name__ == "__main__":
    main(sys.argv[1:])
