"""Headline queries at one scale: one JSON line with the median of the runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "facet_money_range",
    "facet_date_range",
    "facet_terms",
    "filter_any_money",
    "table_to_documents",
    "unified_catalog",
    "upsert_by_id",
    "delta_import_plan",
    "keyword_search",
    "leading_wildcard",
    "term_vectors",
    "sheet_rows",
    "page_records",
    "slide_records",
    "html_extract",
    "csv_dialect_read",
    "mbox_messages",
    "rfc822_headers",
    "mime_parts",
    "xlsx_cells",
    "outline_flatten",
    "write_documents",
    "ingest_stream",
    "glyph_words",
    "paragraphs",
    "page_text",
)


def main() -> None:
    from docweave.plans import all_queries
    from docweave.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()[0]
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of headline queries, warm, median of runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
