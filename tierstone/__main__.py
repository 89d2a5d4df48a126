"""Run a refresh: ``spark-submit`` this file, or ``python -m tierstone``.

Lists the landed files, rebuilds all tables, then shows the row audit, the newest versions
and the sales reports.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tierstone.plans import Landing, layer_audit, refresh, table_path
from tierstone.sources import landing_inventory, read_commit, snapshot_history

# Report -> the column to show it by, and whether the highest comes first.
_REPORTS = {
    "gold_sales_by_city": ("total_revenue", True),
    "gold_sales_by_category": ("total_revenue", True),
    "gold_top_customers": ("rank", False),
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierstone", description=__doc__)
    for name in ("orders", "customers", "products"):
        parser.add_argument(f"--{name}", required=True, nargs="+", help="CSV files or folders")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--flag-mode", choices=("post_fill", "pre_fill"), default="post_fill")
    parser.add_argument("--overwrite-schema", action="store_true", help="take changed columns")
    parser.add_argument("--any-header", action="store_true", help="read by position, unchecked")
    parser.add_argument("--corrupt-column", help="keep malformed lines in this bronze column")
    parser.add_argument("--verify", action="store_true", help="count source lines and stored rows")
    parser.add_argument("--preview", type=int, default=20, help="rows to show per report")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tierstone").getOrCreate()
    print("Spark", spark.version)
    files = [*options.orders, *options.customers, *options.products]
    landing_inventory(spark, files).show(options.preview, truncate=False)

    landing = Landing(options.orders, options.customers, options.products)
    commits = refresh(
        spark,
        landing,
        options.root,
        flag_mode=options.flag_mode,
        overwrite_schema=options.overwrite_schema,
        strict_header=not options.any_header,
        corrupt_column=options.corrupt_column,
        count_source=options.verify,
    )

    layer_audit(spark, options.root, read_back=options.verify).show(truncate=False)
    for table, (column, highest_first) in _REPORTS.items():
        print(table)
        snapshot_history(spark, table_path(options.root, table)).show(3, truncate=False)
        report = read_commit(spark, commits[table])
        report.orderBy(column, ascending=not highest_first).show(options.preview, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
