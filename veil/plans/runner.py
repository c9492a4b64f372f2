"""Runs named jobs from one configuration, writing a table after each step.

Jobs: org, pre, deid, post, post_1_file, post_jk, dist_*, sum_* (org, pre, old, new), sample, count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.functions.templates import as_list
from veil.operators.stats import numeric_columns, numeric_profile
from veil.operators.suppress import dup_histogram
from veil.plans import reports, steps
from veil.sources.quoted import count_records
from veil.sources.readers import csv_options, load_table
from veil.sources.writers import crosswalk, export_rows, save_table


@dataclass(frozen=True)
class Run:
    """A session and a configuration; the configuration is only read."""

    spark: SparkSession
    config: Mapping

    @property
    def catalog(self) -> str:
        return str(self.config["catalog"])

    @property
    def rn(self) -> str:
        return self.config.get("_rn") or steps.RN

    @property
    def jk(self) -> str:
        return self.config.get("_jk") or steps.JK

    @property
    def uses_pre(self) -> bool:
        pre = self.config.get("step_pre") or {}
        return any(pre.get(k) for k in ("column", "remove_duplicated", "filter_in", "filter_out"))

    @property
    def chains(self) -> Mapping:
        return (self.config.get("step_deid") or {}).get("column") or {}

    def section(self, name: str) -> Mapping:
        return self.config.get(name) or {}

    def table(self, step: str) -> DataFrame:
        if step == "step_pre" and not self.uses_pre:
            step = "org_rn"
        return load_table(self.spark, {"directory": self._folder(step)}, f"{self.catalog}.parquet")

    def save(self, df: DataFrame, step: str) -> str:
        return save_table(df, {"directory": self._folder(step)}, f"{self.catalog}.parquet")

    def report(self, df: DataFrame, step: str, filename: str, single_file: bool = True) -> str:
        storage = {"directory": self._folder(step), "make_1_file": single_file}
        if self.config.get("dist_encoding"):
            storage["encoding"] = self.config["dist_encoding"]
        return save_table(df, storage, filename)

    def _folder(self, step: str) -> str:
        return f"{self.config['storage']}/{step}"


def run_jobs(spark: SparkSession, config: Mapping, jobs: str | Iterable[str]) -> dict[str, str | None]:
    """Run jobs in the given order; returns where each one wrote its result, if it had any."""
    run = Run(spark, config)
    names = [j.strip() for j in (jobs.split(",") if isinstance(jobs, str) else jobs)]
    names = [n for n in names if n and not (n == "post_jk" and config.get("data_with_jk"))]
    unknown = [n for n in names if n not in JOBS]
    if unknown:
        raise ValueError(f"unknown job: {', '.join(unknown)}; known: {', '.join(JOBS)}")
    return {n: JOBS[n](run) for n in names}


def _org(run: Run) -> str:
    return run.save(steps.ingest(run.spark, run.config["step_org"]["in"], run.rn), "org_rn")


def _pre(run: Run) -> str | None:
    if not run.uses_pre:
        return None
    pre = run.section("step_pre")
    keys = as_list(pre.get("remove_duplicated"))
    if keys:
        # written first, so that the histogram and the surviving rows come from the same values
        before = {k: v for k, v in pre.items() if k in ("filter_in", "column")}
        run.save(steps.prepare(run.table("org_rn"), before), "step_pre_copies")
        kept = run.table("step_pre_copies")
        run.report(dup_histogram(kept, keys), "step_pre", f"duplicated_jk_count.{run.catalog}.csv")
        rest = {k: v for k, v in pre.items() if k in ("remove_duplicated", "null_keys", "filter_out")}
        return run.save(steps.prepare(kept, rest), "step_pre")
    return run.save(steps.prepare(run.table("org_rn"), pre), "step_pre")


def _deid(run: Run) -> str:
    return run.save(steps.deidentify(run.table("step_pre"), run.chains), "step_deid")


def _post(run: Run) -> str:
    post = run.section("step_post")
    original = [c for c in run.table("org_rn").columns if c != run.rn]
    published = steps.publish(
        run.table("step_deid"),
        run.chains,
        post.get("include"),
        post.get("exclude"),
        post.get("filter_out"),
        original=original,
        data_with_jk=bool(run.config.get("data_with_jk")),
        rn=run.rn,
        jk=run.jk,
    )
    return run.save(published, "step_post")


def _post_file(run: Run) -> str:
    rows = export_rows(run.table("step_post"), run.rn, bool(run.config.get("data_with_jk")))
    return run.report(rows, "step_post_1_file", f"data.{run.catalog}.csv", single_file=False)


def _post_jk(run: Run) -> str:
    links = crosswalk(run.table("step_deid"), run.chains[run.jk], run.rn, run.jk)
    return run.report(links, "step_post_1_file", f"jk.{run.catalog}.csv", single_file=False)


def _dist(step: str, table: str) -> Callable[[Run], str]:
    def job(run: Run) -> str:
        section = run.section(step)
        ids = (run.rn, run.jk)
        counts = reports.frequencies(run.table(table), section.get("include"), section.get("exclude"), ids)
        return run.report(counts.orderBy("column", "value"), step, f"{run.catalog}.csv", single_file=False)

    return job


def _sum(step: str, table: str) -> Callable[[Run], str | None]:
    def job(run: Run) -> str | None:
        section = run.section(step)
        if not section.get("include"):
            return None
        df = run.table(table)
        names = numeric_columns(df, reports.report_columns(df, section["include"], section.get("exclude")))
        if not names:
            return None
        option = section.get("opt") or {"lower": "right", "upper": "left"}
        profile = numeric_profile(df, names, section.get("accuracy"), option.get("lower"), option.get("upper"))
        return run.report(profile, step, f"{run.catalog}.csv")

    return job


def _sample(run: Run) -> str:
    section = run.section("step_sample")
    lines = reports.sample_compare(
        run.table("step_pre"),
        run.table("step_post"),
        section.get("filters"),
        section.get("default_filter"),
        run.rn,
        run.jk,
    )
    return run.report(lines.orderBy("name", "sample_no"), "step_sample", f"{run.catalog}.csv")


def _count(run: Run) -> str:
    source = run.config["step_org"]["in"]
    counts = reports.dataset_counts({str(source["filename"]): run.table("org_rn")}, run.rn)
    # the source's own bytes, while rows are counted where they are filtered already
    counts = counts.withColumn("filesize", _bytes(run, f"{source['directory']}/{source['filename']}"))
    if run.config.get("step_post"):
        # the exported file itself: an incomplete export has fewer rows than the table it was written from
        name = f"data.{run.catalog}.csv"
        path = f"{run._folder('step_post_1_file')}/{name}"
        data = run.spark.read.options(**csv_options({})).csv(path)
        rows = count_records(run.spark, path, csv_options({})).agg(F.coalesce(F.sum("records"), F.lit(0))).scalar()
        exported = reports.dataset_counts({name: data}, rn="", with_size=False)
        counts = counts.unionByName(exported.withColumns({"row_count": rows, "filesize": _bytes(run, path)}))
    path = f"{run._folder('step_count')}/count.{run.catalog}.json"
    counts.coalesce(1).write.mode("overwrite").json(path)
    return path


def _bytes(run: Run, path: str) -> Column:
    """The bytes of the files, from their listing."""
    files = run.spark.read.format("binaryFile").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).scalar()


_TABLES = {"org": "org_rn", "pre": "step_pre", "old": "step_pre", "new": "step_post"}
JOBS: dict[str, Callable[[Run], str | None]] = {
    "org": _org,
    "pre": _pre,
    "deid": _deid,
    "post": _post,
    "post_1_file": _post_file,
    "post_jk": _post_jk,
    **{f"dist_{k}": _dist(f"step_dist_{k}", t) for k, t in _TABLES.items()},
    **{f"sum_{k}": _sum(f"step_sum_{k}", t) for k, t in _TABLES.items()},
    "sample": _sample,
    "count": _count,
}
