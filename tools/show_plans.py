"""Print the physical plans of the key jobs (operator tree + scan details).

    python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and ("Scan parquet" in block or "LocalTableScan" in block):
            keep = [ln for ln in block.splitlines()
                    if re.match(r"^\(\d+\)|^(Location|PushedFilters|ReadSchema|Output)", ln)]
            scans.append("\n".join(keep))
    return tree.strip() + "\n\n" + "\n\n".join(scans)


def main() -> None:
    from cashbook.plans import model as M
    from cashbook.plans import pnl
    from cashbook.session import get_session, scratch_dir
    from cashbook.sources.fixture_sources import billing_source
    from cashbook.sources.fixtures import catalog_tables, fixture_tables
    from cashbook.sources.snapshot import snapshot_sources
    from cashbook.sources.warehouse import Warehouse

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    t = fixture_tables(spark, sf)
    wh = Warehouse(spark, scratch_dir(spark, "plans"), namespace="plans")
    snapshot_sources(spark, [billing_source(spark, sf)], wh)
    stored = catalog_tables(wh)
    M.refresh_model(spark, wh, "en")

    sections = [
        ("Flagship `pnl_en` over the stored warehouse tables (all dimension sides within their "
         "bounds: map-only, no shuffle)", pnl.pnl_long(stored, "en")),
        ("`pnl_en` with the account side over its broadcast bound (one shuffle on the account id; "
         "AQE splits skewed partitions at run time)", pnl.pnl_long(stored, "en", account_max_rows=0)),
        ("`pnl_wide`: leaf found by one broadcast lookup, 30 trivial CASE columns",
         pnl.pnl_wide(stored, "en")),
        ("Model refresh write (default layout): REBALANCE(id_club) + sort within partitions",
         M.rebalanced(pnl.pnl_long(stored, "en"))),
        ("Model refresh write (layout='range'): range partitioning on (club, local time, row hash)",
         M.clustered(pnl.pnl_long(stored, "en"), M.range_count(spark, stored.payment))),
        ("Model refresh write (layout='curve', that of a warehouse run): three broadcast lookups, one exchange by "
         "partition number", M.along_curve(stored, "en", M.range_count(spark, stored.payment))),
        ("The 34 branches from one scan of the wide form (`queries()['union_all_bag']`)", pnl.pnl_rows(stored, "en")),
        ("Lookup on the stored model: club and local-time filters pushed into the Parquet scan",
         M.lookup(M.model_table(wh, "en"), [5, 7], "1995-01-01", "1997-01-01")),
        ("Flagship on the fixture tables derived from the testdata (as `queries()['pnl_en']`)",
         pnl.pnl_long(t, "en")),
    ]
    print(f"# Physical plans (sf = `{sf}`, generated by `tools/show_plans.py`)\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{formatted(df)}\n```\n")


if __name__ == "__main__":
    main()
