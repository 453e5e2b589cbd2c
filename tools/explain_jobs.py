"""Print the formatted physical plans of the three jobs (over landed day files) to stdout.
Usage: python tools/explain_jobs.py [sf_dir] > docs/PLANS.md"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from clickmodel.operators.serving import serving_projection  # noqa: E402
from clickmodel.operators.sessions import build_sessions  # noqa: E402
from clickmodel.operators.staging import stage_events  # noqa: E402
from clickmodel.operators.base import base_model  # noqa: E402
from clickmodel.plans.jobs import run_base, run_staging  # noqa: E402
from clickmodel.session import local_session  # noqa: E402
from clickmodel.sources import testdata as TD  # noqa: E402
from clickmodel.sources.files import raw_file_name, read_days, read_partitioned  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"#\d+", "", buf.getvalue())
    return re.sub(r"(ReadSchema: .{300}).*", r"\1…", text)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="clickmodel-explain-")
    raw = TD.raw_events(spark, sf)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for d in days:
        raw.where(F.col("event_date") == d.strftime("%Y%m%d")).write.parquet(f"{root}/raw/{raw_file_name(d)}")
    run_base(spark, f"{root}/raw", f"{root}/base")
    run_staging(spark, f"{root}/base", f"{root}/stg")
    TD.traffic_sources(spark, sf).write.parquet(f"{root}/traffic")
    plans = {
        "Base job: raw day files -> deduplicated base events": base_model(read_days(spark, f"{root}/raw", days)),
        "Staging job: one day of base events -> staged events": stage_events(
            read_partitioned(spark, f"{root}/base", [days[1]])),
        "Session job: staged day -> session dimension + traffic sources": build_sessions(
            read_partitioned(spark, f"{root}/stg", [days[1]]), traffic=read_partitioned(spark, f"{root}/traffic")),
        "Serving projection": serving_projection(read_partitioned(spark, f"{root}/stg")),
    }
    for title, df in plans.items():
        print(f"## {title}\n\n```\n{formatted(df).strip()}\n```\n")


if __name__ == "__main__":
    main()
