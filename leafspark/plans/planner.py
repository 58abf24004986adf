"""Running a book: phases of fused stages, branches, written checkpoints, and re-runs of what changed alone.

A checkpoint is a table partitioned by branch and stage; a page's row is written together with its pixels, so
whatever a run finished before a crash counts as done. A phase is stale when the hash of its settings, which
includes that of the phase before it, differs from the stored one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafspark.operators import tables
from leafspark.plans import normalize, stages
from leafspark.plans.config import Config, skipped, stage_hash

PHASES = (("", ("preprocess",)), ("", stages.COMMON), ("book", stages.BOOK), ("score", stages.SCORE))


class Book:
    """Checkpoints of one book below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, folder.rstrip("/"), name

    def _path(self, branch: str, phase: str, digest: str) -> str:
        return f"{self.folder}/pages/branch={branch or 'common'}/phase={phase}/hash={digest}"

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(at)

    def done(self, path: str, pages: DataFrame) -> DataFrame:
        """Pages of a phase's input that it has not yet given a result."""
        if not self._exists(path):
            return pages
        return tables.without(pages, self.spark.read.schema(pages.schema).parquet(path), "stem")

    def phase(self, pages: DataFrame, branch: str, names: list[str], cfg: Config, upstream: str) -> tuple[DataFrame, str]:
        """Results of a phase, computed for the pages that lack them, and its hash."""
        digest = upstream
        for name in names:
            digest = stage_hash(name, cfg, digest)
        path = self._path(branch, "+".join(names), digest)
        todo = self.done(path, pages)
        out = stages.run_pages(todo, names, cfg).withColumn("branch", F.lit(branch))
        out.write.mode("append").parquet(path)
        return self.spark.read.schema(pages.schema).parquet(path), digest

    def run(self, pages: DataFrame, cfg: Config) -> dict[str, DataFrame]:
        """Results of the common phases and of both branches."""
        if cfg.preview:
            pages = pages.filter(F.col("page_seq") <= cfg.preview)
        if cfg.split_spreads:
            pages = normalize.split_spreads(pages)
        results, digest, out = pages, stage_hash("split", cfg) if cfg.split_spreads else "", {}
        records = []
        for k, (branch, names) in enumerate(PHASES):
            own = cfg.for_branch(branch) if branch else cfg
            names = [n for n in names if not skipped(f"{n}_{branch}" if n == "deskew" else n, own) and not skipped(n, own)]
            if not names:
                continue
            if branch:
                made, last = self.phase(results, branch, names, own, digest)
                out[branch] = stages.last_of(made)
                if branch == "book" and not skipped("normalize", own):
                    path = self._path(branch, "normalize", stage_hash("normalize", own, last))
                    if not self._exists(path):
                        normalize.normalized(out[branch]).write.parquet(path)
                    out[branch] = self.spark.read.schema(pages.schema).parquet(path)
                    records.append(out[branch])
            else:
                made, digest = self.phase(results, branch, names, own, digest)
                results = stages.last_of(made)
                if k == 0 and not skipped("stitch", own):
                    groups = stages.page_groups(stages.shot_features(results), own)
                    digest = stage_hash("stitch", own, digest)
                    path = self._path("", "stitch", digest)
                    if not self._exists(path):
                        stages.stitch(results, groups).write.parquet(path)
                    results = self.spark.read.schema(pages.schema).parquet(path)
                    records.append(results)
            records.append(made)
        out[""] = results
        out["records"] = records[0]
        for r in records[1:]:
            out["records"] = out["records"].unionByName(r)
        out["records"] = out["records"].drop("data")
        return out


def counters(records: DataFrame) -> DataFrame:
    """Per branch and stage: processed, failed, excluded."""
    return records.groupBy("branch", "stage").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("processed", "failed", "excluded")]
    )


def report(records: DataFrame) -> str:
    rows = counters(records).orderBy("stage", "branch").collect()
    return "\n".join(f"{r['branch'] or 'common':8} {r['stage']:18} {r['processed']:6} {r['failed']:6} {r['excluded']:6}" for r in rows)
