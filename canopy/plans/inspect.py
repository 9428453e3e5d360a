"""Plan inspection: formatted explain text and counts of the operators that
matter at scale (exchanges, scans, broadcasts, pushed filters)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict:
    """Counts over the (pre-AQE) physical plan."""
    text = explain_text(df, "simple")
    lines = text.splitlines()
    own = [ln for ln in lines if "ReusedExchange" not in ln]
    own_text = "\n".join(own)
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                    r"Exchange SinglePartition|Exchange RoundRobin", own_text)),
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", own_text)),
        "reused_exchanges": sum("ReusedExchange" in ln for ln in lines),
        "broadcasts": len(re.findall(r"BroadcastExchange", own_text)),
        "scans": len(re.findall(r"FileScan|Scan parquet|Scan ExistingRDD|Scan JDBC", text)),
        # (the metadata string may be cut by spark.sql.maxMetadataStringLength)
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)", text),
        "read_schemas": re.findall(r"ReadSchema: (struct<[^>]*>)", text),
        "top_k": "TakeOrderedAndProject" in text,
        "window": "Window" in text,
    }
