"""Print the physical plan tree and the scan/exchange/join lines of chosen queries.

Usage: python tests/plan_report.py /root/testdata/sf0.1 board_rows stored_day_offers ...
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^(PushedFilters|PartitionFilters|ReadSchema|Arguments: hashpartitioning|Join type|Join condition|"
                  r"Left keys|Right keys|Functions)")


def main(argv):
    from offerboard.session import get_spark
    import __spark_entry__ as E
    spark = get_spark()
    qs = E.queries()
    for name in argv[2:]:
        df = qs[name](spark, argv[1])
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        tree, _, details = text.partition("\n\n\n")
        print(f"### `{name}`\n\n```")
        print(tree.replace("== Physical Plan ==\n", "").rstrip())
        seen = set()
        for line in details.splitlines():
            if KEEP.match(line) and line not in seen:
                seen.add(line)
                print("  " + (line if len(line) < 160 else line[:157] + "..."))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
