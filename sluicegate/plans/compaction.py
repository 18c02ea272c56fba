"""Compaction of a dated Parquet table (``dt=..`` folders), bin by bin, as planned.

Each bin of :func:`~sluicegate.plans.upkeep.plan_compaction` becomes one file, an oversized one as many as it takes. Files that
are in no bin are neither opened nor moved. New files are written aside, below ``_compaction``, which readers of the table
skip; then a manifest names what replaces what; then files are moved in and the old ones deleted, in tasks. A run that ends
before its manifest changes nothing and is cleared away by the next; one that ends after it is finished by the next. Between the
moves and the deletions a reader may see rows twice: a table that is read meanwhile needs commits (:mod:`sluicegate.sinks.lake`)
or a table format (:mod:`sluicegate.sinks.iceberg`).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate import constants as C
from sluicegate.plans import upkeep
from sluicegate.session import delete_path, publish
from sluicegate.sinks.files import delete_in_tasks, move_in_tasks, same_form
from sluicegate.sources import lake
from sluicegate.sources.tables import stage

#: Files that one job reads, about; their names pass through the driver.
FILES_PER_JOB = 10_000
_ASIDE = "_compaction"


def compact_files(
    spark: SparkSession,
    path: str,
    run_id: str,
    target_bytes: int = C.TARGET_FILE_BYTES,
    sort_by: tuple[str, ...] = ("user_id", "event_time"),
    files_per_job: int = FILES_PER_JOB,
    **plan_options,
) -> DataFrame:
    """Rewrite the bins of a table; one row per day: files and bytes before and after, and how many files were left as they were.

    ``plan_options`` are those of :func:`~sluicegate.plans.upkeep.plan_compaction`. The same ``run_id`` again finishes that run.
    """
    path = path.rstrip("/")
    finish(spark, path)
    files = stage(_listed(spark, path), "files")
    planned = upkeep.plan_compaction(files, target_bytes, **plan_options)
    pieces = F.greatest(F.lit(1), F.ceil(F.sum("file_size_in_bytes") / target_bytes)).alias("_pieces")
    bins = planned.groupBy("dt", "slice", "bin_id").agg(pieces)
    plan = stage(planned.join(bins, ["dt", "slice", "bin_id"]), "plan")
    for number, units in enumerate(_jobs(plan, files_per_job)):
        _rewrite(spark, path, f"{path}/{_ASIDE}/{run_id}/new/job={number}", plan, units, sort_by)
    if not plan.isEmpty():
        _manifest(spark, path, run_id, plan)
        finish(spark, path)
    left = files.join(plan.select("file_path"), "file_path", "left_anti").groupBy("dt").agg(F.count(F.lit(1)).alias("untouched"))
    before = _totals(files, "before")
    after = _totals(stage(_listed(spark, path), "files"), "after")
    counts = {name: F.coalesce(name, F.lit(0)) for name in ("files_before", "bytes_before", "files_after", "bytes_after", "untouched")}
    return before.join(after, "dt", "full_outer").join(left, "dt", "left").select("dt", *(c.alias(n) for n, c in counts.items()))


def _totals(files: DataFrame, suffix: str) -> DataFrame:
    return files.groupBy("dt").agg(F.count(F.lit(1)).alias(f"files_{suffix}"), F.sum("file_size_in_bytes").alias(f"bytes_{suffix}"))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return lake.lake_files(spark, path).withColumn("file_path", same_form(F.col("file_path")))


def _jobs(plan: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Slices of days, as many as hold about ``most`` files; a slice is bounded by the plan."""
    units, size = [], 0
    counted = plan.groupBy("dt", "slice").agg(F.count(F.lit(1)).alias("n")).orderBy("dt", "slice")
    for row in counted.toLocalIterator():
        if units and size + row["n"] > most:
            yield units
            units, size = [], 0
        units.append((row["dt"], row["slice"]))
        size += row["n"]
    if units:
        yield units


def _rewrite(spark: SparkSession, path: str, target: str, plan: DataFrame, units: list[tuple], sort_by: tuple[str, ...]) -> None:
    """Write the bins of some slices aside; the scan lists nothing but their files."""
    chosen = plan.join(F.broadcast(spark.createDataFrame(units, "dt date, slice bigint")), ["dt", "slice"], "left_semi")
    picked = chosen.select("file_path", "slice", "bin_id", "_pieces").collect()
    bins = spark.createDataFrame([tuple(r) for r in picked], "_file string, slice bigint, _bin bigint, _pieces bigint")
    schema = spark.read.option("basePath", path).parquet(picked[0]["file_path"]).schema
    reader = spark.read.schema(schema).option("basePath", path)
    rows = reader.parquet(*(r["file_path"] for r in picked)).withColumn("_file", same_form(F.col("_metadata.file_path")))
    columns = [name for name in rows.columns if name not in ("_file", "dt")]
    part = F.pmod(F.xxhash64(*columns), F.col("_pieces"))
    name: Column = F.concat_ws("-", "slice", "_bin", part)
    placed = rows.join(F.broadcast(bins), "_file").select(*columns, F.col("dt").cast("date").alias("dt"), name.alias("bin"))
    count = sum({(r["slice"], r["bin_id"]): r["_pieces"] for r in picked}.values()) * len({u[0] for u in units})
    order = [c for c in sort_by if c in columns]
    placed = placed.repartition(min(count, 10_000), "dt", "bin").sortWithinPartitions("dt", "bin", *order)
    placed.write.mode("overwrite").option("compression", "zstd").partitionBy("dt", "bin").parquet(target)


def _manifest(spark: SparkSession, path: str, run_id: str, plan: DataFrame) -> None:
    """What goes and what comes in; its folder gets its name when it is complete."""
    aside = f"{path}/{_ASIDE}/{run_id}"
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(f"{aside}/new")
    source = same_form(F.col("path"))
    number, day, bin_ = (F.regexp_extract("path", rf"/{name}=([^/]+)/", 1) for name in ("job", "dt", "bin"))
    split = F.regexp_extract("path", r"/part-(\d+)", 1)
    target = F.concat(same_form(F.lit(path)), F.lit("/dt="), day, F.lit(f"/part-{run_id}-"), number, F.lit("-"), bin_, F.lit("-"), split, F.lit(".zstd.parquet"))
    come = written.select(F.lit("new").alias("kind"), source.alias("source"), target.alias("target"))
    go = plan.select(F.lit("old").alias("kind"), F.col("file_path").alias("source"), F.lit(None).cast("string").alias("target"))
    come.unionByName(go).write.mode("overwrite").parquet(f"{aside}/writing")
    publish(spark, f"{aside}/writing", f"{aside}/manifest")


def finish(spark: SparkSession, path: str) -> None:
    """Carry out the manifests that runs have left, and clear away what is aside of runs without one."""
    aside = f"{path.rstrip('/')}/{_ASIDE}"
    place = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    files = place(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place(aside)):
        return
    runs = [status.getPath().getName() for status in files.listStatus(place(aside))]
    for run_id in sorted(run for run in runs if files.exists(place(f"{aside}/{run}/manifest"))):
        manifest = stage(spark.read.parquet(f"{aside}/{run_id}/manifest"), "manifest")
        move_in_tasks(manifest.where("kind = 'new'"), "source", "target")
        delete_in_tasks(manifest.where("kind = 'old'"), "source")
        delete_path(spark, f"{aside}/{run_id}")
    delete_path(spark, aside)
