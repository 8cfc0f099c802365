"""Command line: tables, progress, exports, samples, work queues, stuck rows and registered queries."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierflow import model as m, registry
from tierflow.config import Settings
from tierflow.operators import exports, reports, sampling, upsert, workqueue
from tierflow.streaming import drain

#: Phases that take rows of a level: their selection, the level, its status column and the status of a claim.
PHASES = {
    "local-bodies": (workqueue.pending_districts, "districts", "status", "IN_PROGRESS"),
    "project-tables": (workqueue.pending_bodies, "bodies", "status", "IN_PROGRESS"),
    "pdfs": (workqueue.pending_projects, "projects", "pdf_status", "DOWNLOADING"),
}
NUMBERS = {2: "local-bodies", 3: "project-tables", 4: "pdfs"}


def _show(df: DataFrame, n: int = 50) -> None:
    df.show(n, truncate=False)


def parser(cfg: Settings) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierflow", description=__doc__)
    p.add_argument("--data", default=cfg.data_dir, help="directory of the model's tables")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("init-db", aliases=["init"], help="create empty tables")
    sub.add_parser("drop-db", help="delete the tables")
    x = sub.add_parser("progress", help="the progress report; with --detail by year and district")
    x.add_argument("-d", "--detail", action="store_true")
    sub.add_parser("status", help="counts, summary, latest runs and errors")
    x = sub.add_parser("dashboard", help="KPIs, rates and yearly failures")
    x.add_argument("--as-of", required=True, help="timestamp that windows end at")
    x = sub.add_parser("export", help="flat CSV by year and CSV by table, in a folder named after the time")
    x.add_argument("--year", type=int)
    x.add_argument("--district")
    x.add_argument("--only-flat", action="store_true")
    x.add_argument("--output-dir", default=cfg.export_dir)
    x.add_argument("--at", help="time that names the folder (default: now)")
    x.add_argument("--upload", metavar="URI", help="copy the files there afterwards")
    x.add_argument("--upload-only", metavar="FOLDER", help="copy this export instead of making one")
    x = sub.add_parser("sample", help="joined sample records, by phase 1 to 4")
    x.add_argument("-c", "-n", "--count", type=int, default=cfg.sample_size)
    x.add_argument("--phase", type=int, choices=(1, 2, 3, 4))
    x.add_argument("--seed", type=int, default=cfg.sample_seed)
    x = sub.add_parser("pending", help="the next batch of a level")
    x.add_argument("--level", choices=("districts", "bodies", "projects"), default="districts")
    x.add_argument("--batch-size", type=int, default=cfg.batch_size)
    for name in ("run-discovery", *(f"run-{k}" for k in PHASES), "run-phase", "run-all", "run-pipeline"):
        x = sub.add_parser(name, help="claim the waiting rows of a phase, batch by batch" if name != "run-discovery" else "list what is undiscovered")
        if name == "run-phase":
            x.add_argument("phase", type=int, choices=(1, 2, 3, 4))
        x.add_argument("--batch-size", type=int, default=cfg.batch_size)
        x.add_argument("--max-queue", type=int, default=cfg.max_queue, help="most rows that may be under way")
        x.add_argument("--skip-exists", action="store_true", help="leave out projects whose document is uploaded")
        x.add_argument("--output", help="folder for new snapshots")
    x = sub.add_parser("reset-stuck-pdfs", aliases=["reset-stuck"], help="let stuck projects wait again")
    x.add_argument("--as-of", required=True, help="timestamp that ages are measured from")
    x.add_argument("--older-than-minutes", type=int, default=cfg.stuck_minutes)
    x.add_argument("--all", action="store_true")
    x.add_argument("--dry-run", action="store_true")
    x.add_argument("-y", "--yes", action="store_true", help="do not ask")
    x.add_argument("--output", help="folder for the new snapshot")
    x = sub.add_parser("queue-status", help="rows under way of each phase, and whether it accepts more")
    x.add_argument("--max-queue", type=int, default=cfg.max_queue)
    x = sub.add_parser("query", help="a registered query over star-schema tables")
    x.add_argument("name", choices=sorted(registry.QUERIES))
    return p


def queues(model: m.Model) -> DataFrame:
    """(queue, size): rows under way of each phase."""
    out = None
    for name, (_, level, status, claimed) in PHASES.items():
        row = getattr(model, level).agg(F.count_if(F.col(status) == claimed).alias("size")).select(F.lit(name).alias("queue"), "size")
        out = row if out is None else out.unionByName(row)
    return out


def claim_phase(model: m.Model, phase: str, batch: int, most: int, retries: int, path: str, skip: bool = False) -> int:
    """Claims batches of a phase until nothing waits or ``most`` rows are under way; commits each as a version at ``path``.

    Returns how many rows are claimed. A version that another writer commits in between raises ``upsert.Conflict``.
    """
    select, level, status, claimed = PHASES[phase]
    spark, taken = model.projects.sparkSession, 0
    if not upsert.version(spark, path):
        upsert.swap(spark, getattr(model, level), path, base=0)

    def now() -> m.Model:
        return m.Model(**{**model.__dict__, level: upsert.current(spark, path)})

    def state() -> dict[str, int]:
        r = getattr(now(), level).agg(F.count_if(F.col(status) == claimed).alias("n")).first()
        return {"pending": int(r.n < most), "in_progress": 0, "n": r.n}

    def work(size: int) -> int:
        nonlocal taken
        base, here = upsert.version(spark, path), now()
        room = min(size, most - state()["n"])
        rows = select(here, None, retries) if skip and level == "projects" else select(here, room, retries)
        if skip and level == "projects":
            rows = workqueue.take(rows.join(model.pdfs.where("status = 'UPLOADED'").select(F.col("project_id").alias("id")), "id", "left_anti"), room)
        ids, marked = workqueue.claim(getattr(here, level), rows, status, claimed)
        n = ids.count()
        if n:
            upsert.swap(spark, marked, path, base)
            taken += n
        return n

    drain(state, work, batch)
    return taken


def main(argv: list[str] | None = None) -> None:
    cfg = Settings.from_env()
    a = parser(cfg).parse_args(argv)
    spark = SparkSession.builder.appName("tierflow").config("spark.sql.session.timeZone", cfg.time_zone).getOrCreate()
    if a.command in ("init", "init-db"):
        m.create_empty(spark, a.data)
        return
    if a.command == "drop-db":
        print("deleted:", ", ".join(m.drop(spark, a.data)) or "nothing")
        return
    if a.command == "query":
        _show(registry.QUERIES[a.name](spark, a.data))
        return
    if a.command == "export" and a.upload_only:
        done = exports.upload(spark, a.upload_only, a.upload or cfg.export_dir)
        _show(done)
        _show(exports.outcome(done))
        return
    model = m.read_model(spark, a.data)
    if a.command == "progress":
        _show(reports.progress_report(model))
        for phase in (2, 3, 4) if a.detail else ():
            _show(reports.progress_detail(model, phase).orderBy(F.desc_nulls_last("year_label"), F.asc_nulls_first("district_name")), 1000)
    elif a.command == "status":
        for df in (reports.table_counts(model), reports.summary(model), reports.phase_status(model), reports.latest_runs(model, 5), reports.by_name(model, "year_label"), reports.recent_errors(model)):
            _show(df)
    elif a.command == "dashboard":
        at = F.lit(a.as_of).cast("timestamp_ntz")
        for df in (reports.kpis(model, at, cfg.window_minutes), reports.fail_rates(model, at), reports.upload_rates(model, at), reports.by_year_failure(model).orderBy(F.desc("year_label")), reports.upload_summary(model)):
            _show(df)
    elif a.command == "export":
        folder = exports.export_dir(a.output_dir, dt.datetime.fromisoformat(a.at) if a.at else dt.datetime.now())
        _show(exports.export_summary(exports.write_flat(model, folder, a.year, a.district)), 1000)
        if not a.only_flat:
            exports.write_raw(model, folder)
        if a.upload:
            _show(exports.upload(spark, folder, f"{a.upload}/{folder.rpartition('/')[2]}"))
    elif a.command == "sample":
        kinds = list(sampling.RECORDS)
        for kind in [kinds[a.phase - 1]] if a.phase else kinds:
            _show(sampling.RECORDS[kind](model, a.count, a.seed), a.count)
    elif a.command == "pending":
        pick = {"districts": workqueue.pending_districts, "bodies": workqueue.pending_bodies, "projects": workqueue.pending_projects}[a.level]
        _show(pick(model, a.batch_size, cfg.max_retries), a.batch_size)
    elif a.command == "queue-status":
        _show(reports.scheduler_status(queues(model), a.max_queue))
    elif a.command.startswith("run-"):
        name = a.command.removeprefix("run-")
        wanted = [NUMBERS.get(a.phase, "discovery")] if name == "phase" else ["discovery", *PHASES] if name in ("all", "pipeline") else [name]
        caps = {"local-bodies": cfg.max_district_retries, "project-tables": cfg.max_body_retries, "pdfs": cfg.max_pdf_retries}
        for phase in wanted:
            if phase == "discovery":
                d = model.districts
                _show(workqueue.undiscovered(d.select("year_val").distinct(), d.select("lb_type_val").distinct(), d))
                continue
            path = f"{a.output or a.data + '/snapshots'}/{PHASES[phase][1]}"
            print(f"{phase}: {claim_phase(model, phase, a.batch_size, a.max_queue, caps[phase], path, a.skip_exists)} claimed")
    elif a.command in ("reset-stuck", "reset-stuck-pdfs"):
        as_of, minutes = F.lit(a.as_of).cast("timestamp_ntz"), None if a.all else a.older_than_minutes
        n = upsert.count_stuck(model.projects, as_of, minutes).first().stuck
        print(f"{n} stuck")
        if not a.dry_run and n and (a.yes or input("reset them? [y/N] ").strip().lower() == "y"):
            upsert.swap(spark, upsert.reset_stuck(model.projects, as_of, minutes), a.output or f"{a.data}/snapshots/projects")


if __name__ == "__main__":
    main()
