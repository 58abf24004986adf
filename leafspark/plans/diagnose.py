"""Statistics and warnings over the records of all stages; pixels are never read."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafspark.operators import fields

NAMES = "stage string, branch string, stem string, record string"


def _get(name: str, kind: str) -> Column:
    return F.try_variant_get(F.try_parse_json("record"), f"$.{name}", kind)


def stage_fields(records: DataFrame) -> DataFrame:
    """Per branch, stage and key: counts and the numbers' range."""
    flat = fields.unpivoted(records, "record", ["branch", "stage"])
    number = F.when(F.col("kind") == "number", F.try_variant_get("value", "$", "double"))
    return flat.withColumn("number", number).groupBy("branch", "stage", "key").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("string", "bool", "number")],
        F.min("number").alias("least"), F.max("number").alias("greatest"), F.avg("number").alias("mean"),
    )


def stage_warnings(records: DataFrame) -> DataFrame:
    """branch, stage and warning of every rule that holds; one aggregation for all."""
    n = F.count("*")
    name = F.first("stage")
    share = lambda c: F.count_if(c) / n
    is_ = lambda s: name.endswith(s)
    method, reason = _get("method", "string"), _get("staff_extract_reason", "string")
    angle, focus, margin = _get("skew_angle", "double"), _get("focus_score", "double"), _get("margin_px", "double")
    rules = {
        "hotspots": is_("preprocess") & (F.count_if(_get("hotspot_detected", "boolean")) > 0),
        "many blurry pages": is_("orientation") & (share(_get("is_blurry", "boolean")) > 0.1),
        "mixed rotations": is_("orientation") & (F.count_distinct(_get("rotation_applied", "double")) > 2),
        "very low focus": is_("orientation") & (share(focus < 50) > 0.2),
        "several page types": is_("page_detect") & (F.count_distinct(_get("page_type", "string")) > 1),
        "page not found": is_("page_detect") & (share(method == "full_image") > 0.2),
        "content always inset": is_("content_area") & (F.count_if(method != "inset_fallback") == 0),
        "content always by ink": is_("content_area") & (F.count_if(method != "ink_density") == 0),
        "tiny margins": is_("content_area") & (F.max(margin) <= 2),
        "staff passed through": is_("staff_extract") & (share(reason.isNotNull()) > 0.15),
        "staff fills the page": is_("staff_extract") & (share(_get("staff_extract_coverage", "double") >= 0.95) > 0.2),
        "strong skew": is_("deskew") & (F.max(F.abs(angle)) > 3),
        "biased skew": is_("deskew") & (F.abs(F.avg(angle)) > 1),
        "failed stitch": is_("stitch") & (F.count_if(~_get("stitch_success", "boolean")) > 0),
        "review: many fall back": share(method.isin("full_image", "inset_fallback", "pass_through")) > 0.2,
    }
    return fields.warnings(records, ["branch", "stage"], {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()})


def number_text(v: float | None) -> str:
    return "-" if v is None else str(int(v)) if float(v).is_integer() else f"{v:.4f}"


def rendered(records: DataFrame, as_json: bool = False) -> str:
    """Both tables as text or JSON; their sizes go with stages and keys, not with pages."""
    stats = [r.asDict() for r in stage_fields(records).orderBy("stage", "branch", "key").collect()]
    warned = [r.asDict() for r in stage_warnings(records).orderBy("stage", "branch", "warning").collect()]
    if as_json:
        return json.dumps({"fields": stats, "warnings": warned}, indent=1)
    lines = [f"{r['branch'] or '-':6} {r['stage']:18} {r['key']:24} {r['n']:6} {number_text(r['least']):>12} {number_text(r['greatest']):>12} {number_text(r['mean']):>12}" for r in stats]
    return "\n".join([*lines, *[f"WARNING {r['branch'] or '-'} {r['stage']}: {r['warning']}" for r in warned]])
