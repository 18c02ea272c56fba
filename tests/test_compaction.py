"""File-level compaction of a dated Parquet table."""

import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluicegate.plans import compaction
from sluicegate.sinks import files as file_tasks


def local(path):
    return Path(path.removeprefix("file://"))


def table(spark, path, days=2, small=6):
    """Per day some small files and one large one; the sizes of the large ones."""
    rows = spark.range(days * small * 20).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"),
        F.col("id").alias("n"),
        F.date_add(F.lit(dt.date(2025, 11, 11)), (F.col("id") % days).cast("int")).alias("dt"),
    )
    for k in range(small):
        rows.where(F.floor(F.col("n") / days) % small == k).coalesce(1).write.mode("append").partitionBy("dt").parquet(path)
    wide = rows.where(F.col("n") < 100 * days).select(
        F.concat(F.lit("w"), F.repeat(F.sha2(F.col("n").cast("string"), 512), F.lit(1)), F.sha2((F.col("n") * 7).cast("string"), 512)).alias("user_id"), "n", "dt"
    )
    wide.unionByName(wide.withColumn("user_id", F.reverse("user_id"))).coalesce(1).write.mode("append").partitionBy("dt").parquet(path)
    return sorted(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def content(spark, path):
    return Counter(map(tuple, spark.read.parquet(path).select("user_id", "n", "dt").collect()))


def names(path):
    return {p.name for p in Path(path).rglob("*.parquet")}


def test_bins_are_rewritten_and_large_files_left(spark, root):
    sizes = table(spark, root)
    before, target = content(spark, root), sizes[-2]
    large = {p.name for p in Path(root).rglob("*.parquet") if p.stat().st_size >= target}
    report = {r["dt"]: r for r in compaction.compact_files(spark, root, "r1", target, min_input_files=2).collect()}
    assert content(spark, root) == before and len(report) == 2
    assert [(r["files_before"], r["files_after"], r["untouched"]) for r in report.values()] == [(7, 2, 1)] * 2, (sizes, report)
    assert large <= names(root) and not (Path(root) / "_compaction").exists()
    again = compaction.compact_files(spark, root, "r2", target, min_input_files=2).collect()
    assert all((r["files_before"], r["files_after"], r["untouched"]) == (2, 2, 2) for r in again)


def test_only_planned_files_are_scanned(spark, root):
    sizes = table(spark, root)
    plan = compaction.upkeep.plan_compaction(compaction._listed(spark, root), sizes[-2], min_input_files=2)
    plan = compaction.stage(plan.withColumn("_pieces", F.lit(1).cast("bigint")), "plan")
    assert plan.count() == 12
    for path in {r["file_path"] for r in compaction._listed(spark, root).collect()} - {r["file_path"] for r in plan.collect()}:
        local(path).write_bytes(b"cannot be read")
        local(path).with_name(f".{local(path).name}.crc").unlink(missing_ok=True)
    for number, units in enumerate(compaction._jobs(plan, 7)):
        compaction._rewrite(spark, root, f"{root}/_compaction/x/new/job={number}", plan, units, ("n",))
    assert number == 1 and spark.read.parquet(f"{root}/_compaction/x/new").count() == 240


def test_oversized_file_is_split(spark, root):
    table(spark, root, days=1)
    before = content(spark, root)
    size = max(p.stat().st_size for p in Path(root).rglob("*.parquet"))
    report = compaction.compact_files(spark, root, "r1", size // 3, max_bytes=size - 1, min_input_files=100).first()
    assert report["untouched"] + 3 <= report["files_after"] and report["files_before"] == 7 and content(spark, root) == before


@pytest.mark.parametrize("fails", ["rewrite", "manifest", "move", "delete"])
def test_run_that_failed_is_finished_or_forgotten(spark, root, monkeypatch, fails):
    target = table(spark, root)[-2]
    before = content(spark, root)
    with monkeypatch.context() as patch:
        broken = lambda *_, **__: 1 / 0
        name = {"rewrite": "_rewrite", "manifest": "_manifest", "move": "move_in_tasks", "delete": "delete_in_tasks"}[fails]
        if fails == "rewrite":
            real = compaction._rewrite
            patch.setattr(compaction, name, lambda *a: (real(*a), 1 / 0))
        else:
            patch.setattr(compaction, name, broken)
        with pytest.raises(ZeroDivisionError):
            compaction.compact_files(spark, root, "r1", target, min_input_files=2)
    if fails in ("rewrite", "manifest"):
        assert content(spark, root) == before
    compaction.finish(spark, root)
    assert content(spark, root) == before and not (Path(root) / "_compaction").exists()
    report = compaction.compact_files(spark, root, "r2", target, min_input_files=2).collect()
    assert content(spark, root) == before and all(r["files_after"] == 2 for r in report)


def test_files_are_moved_and_deleted_once(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"a{k}").write_text(str(k))
    pairs = spark.createDataFrame([(f"file:{tmp_path}/a{k}", f"file://{tmp_path}/to/b{k}") for k in range(5)], "s string, t string")
    assert file_tasks.move_in_tasks(pairs, "s", "t") == 5 and file_tasks.move_in_tasks(pairs, "s", "t") == 0
    assert file_tasks.delete_in_tasks(pairs, "t") == 5 and file_tasks.delete_in_tasks(pairs, "t") == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        file_tasks.move_in_tasks(pairs, "s", "t")


def test_long_names_are_made_after_the_shuffle(spark):
    from sluicegate.checks import queries

    rows = spark.range(100).selectExpr("id AS event_id", "concat('U', id) AS user_id", "date '2024-01-01' AS dt")
    plan = queries._long_names(rows)._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan and "sha2" not in plan[plan.index("Exchange"):]
