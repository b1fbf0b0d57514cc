"""Validators of whole texts: what is computed of a text is computed once."""

from __future__ import annotations

from pyspark.sql import functions as F
from saltmarsh.operators import messages


def test_a_text_is_cleaned_once(spark):
    body = "Revenue rose and margin guidance was raised again this quarter, they said.\n"
    rows = [("blog", "Date: 2025-01-02\nSource: https://x.example/1\n" + body * 2), ("blog", "Date: 2025-01-02\nSource: https://x.example/1\n[ATTACH_TEXT]\n" + body * 2 + "[/ATTACH_TEXT]\n"), ("telegram", body * 2), ("premium", None), ("other", "a longer text"), (None, "a longer text")]
    out = spark.createDataFrame(rows, "kind string, text string").repartition(2).select("kind", messages.text_reason("text", F.col("kind")).alias("reason"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\[/ATTACH_TEXT\]") == 1
    got = sorted((str(r["kind"]), str(r["reason"])) for r in out.collect())
    assert got == [("None", "None"), ("blog", "None"), ("blog", "blog_effective_body_empty"), ("other", "None"), ("premium", "text_too_short"), ("telegram", "telegram_missing_required_metadata")]
