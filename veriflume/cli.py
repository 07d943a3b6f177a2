"""Command line: ``python -m veriflume.cli STAGE ...``.

Exit codes: 2 for missing input, 1 for a broken invariant or a failed regression bound.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _extraction(p: argparse.ArgumentParser) -> None:
    p.add_argument("--extensions", default=".pdf,.docx,.html,.htm,.txt,.md,.rst")
    p.add_argument("--reextract", action="store_true", help="write texts again that are there")
    p.add_argument("--no-merge-manifest", action="store_true", help="replace the table of sources instead of merging")
    p.add_argument("--force-academic-pdf", action="store_true")
    p.add_argument("--prefer-ocr", action="store_true")
    p.add_argument("--allow-long-ocr", action="store_true")
    p.add_argument("--grobid-url", help="address of a TEI service; none: not asked")
    p.add_argument("--grobid-rps", type=float, default=0.5)
    p.add_argument("--grobid-max-retries", type=int, default=3)
    p.add_argument("--grobid-timeout", type=float, default=60)


def _pairs(p: argparse.ArgumentParser) -> None:
    p.add_argument("--prefer-excel", action="store_true")
    p.add_argument("--csv-encoding-sweep", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--urls-subdir", default="urls")


def _verify(p: argparse.ArgumentParser) -> None:
    p.add_argument("--bm25-topk", type=int, default=20)
    p.add_argument("--cos-thresh", type=float, default=0.82)
    p.add_argument("--fuzzy-thresh", type=int, default=85)


def _sniff(p: argparse.ArgumentParser) -> None:
    p.add_argument("--config", help="JSON file of settings")
    p.add_argument("--limit-rows", type=int, default=0, help="only the first rows (0: all)")
    p.add_argument("--query-field", choices=("quote_from_report", "quote_from_source"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="veriflume", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, root: bool = True, *parts) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=text)
        if root:
            s.add_argument("root")
        s.add_argument("--artifacts-root", "--out-root", default="artifacts")
        s.add_argument("--cohort-id", help="by default the name of the root")
        s.add_argument("--cohort-note")
        s.add_argument("--include-groups", default="")
        for add in parts:
            add(s)
        return s

    run = stage("cohort", "extract, pair, verify, triage and check a folder of groups", True, _extraction, _pairs, _verify, _sniff)
    run.add_argument("--wipe", action="store_true", help="delete the artifacts first")
    run.add_argument("--fetch-urls", action=argparse.BooleanOptionalAction, default=False, help="download what tables link to first")
    run.add_argument("--cheap-only", action="store_true", help="accepted for compatibility: inference is never run here")
    text = stage("extract", "texts of the documents", True, _extraction)
    text.add_argument("--verify", action="store_true", help="report per group afterwards")
    text.add_argument("--verify-only", action="store_true", help="only report")
    text.add_argument("--verify-report", help="write the report to this JSON file")
    stage("pairs", "citation rows, resolved to sources", True, _pairs)
    stage("verify", "check quotes against their sources", False, _verify)
    stage("sniff", "passages that qualify or contradict a claim", False, _sniff)
    stage("status", "groups with files that have no text")
    stage("missing", "cited sources without any text", False)
    bounds = stage("check", "invariants of the tables, bounds of success ratios", False)
    bounds.add_argument("--bound", action="append", default=[], metavar="GROUP=LOW:HIGH")
    urls = stage("fetch", "download what tables link to", True)
    urls.add_argument("--urls-subdir", default="urls")
    urls.add_argument("--url-timeout", type=float, default=20)
    stage("preview", "first rows of every table")
    nli = sub.add_parser("nli", help="score flagged candidates and merge the scores back")
    nli.add_argument("--candidates-parquet", "--in-parquet", required=True)
    nli.add_argument("--out-dir", required=True)
    nli.add_argument("--flagged-only", action="store_true")
    nli.add_argument("--all", action="store_true")
    nli.add_argument("--batch-size", type=int, default=8)
    nli.add_argument("--max-length", type=int, default=384, help="words of a window that are scored")
    nli.add_argument("--topk-per-pair", type=int, default=3)
    return p


def extractors(a: argparse.Namespace):
    from .sources import extract

    tei = extract.tei_service(a.grobid_url, a.grobid_timeout) if a.grobid_url else None
    return extract.Extractors(
        tei=tei, ocr=extract.ocr_program() if a.prefer_ocr else None, force_academic=a.force_academic_pdf, prefer_ocr=a.prefer_ocr,
        allow_long_ocr=a.allow_long_ocr, rps=a.grobid_rps, retries=a.grobid_max_retries,
    )


def triage_config(a: argparse.Namespace):
    from dataclasses import replace

    from .config import TriageConfig

    cfg = TriageConfig.overlay(a.config)
    return replace(cfg, query_field=a.query_field) if a.query_field else cfg


def report(rows: DataFrame, path: str | None = None) -> None:
    """Print a small table; write it as JSON too."""
    got = [r.asDict(recursive=True) for r in rows.collect()]
    for r in got:
        print("  ".join(f"{k}={v}" for k, v in r.items()))
    if path:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(got, f, ensure_ascii=False, indent=2, default=str)


def broken(stages, bounds: list[str]) -> int:
    from .operators import checks

    bad = stages.checks().where("violations > 0")
    report(bad)
    spans = {g: tuple(float(x) for x in r.split(":")) for g, r in (b.rsplit("=", 1) for b in bounds)}
    out = checks.group_bounds(stages.read("verification_summary"), spans) if spans else None
    if out is not None:
        report(out)
    return int(bad.where("not warn").count() > 0 or (out is not None and out.count() > 0))


def main(argv: list[str] | None = None) -> int:
    from .config import VerifyConfig
    from .operators import corpus, nli, tables
    from .plans import cohort
    from .sources import sinks, tabular

    a = parser().parse_args(argv)
    source = getattr(a, "root", None) or getattr(a, "candidates_parquet", None) or a.artifacts_root
    if not os.path.exists(source) and "://" not in source:
        print(f"not found: {source}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("veriflume").getOrCreate()
    if a.stage == "nli":
        cands = nli.load_candidates(spark.read.parquet(a.candidates_parquet))
        chosen = nli.selected(cands, a.flagged_only or not a.all)
        sinks.write_parquet(nli.score(chosen, batch=a.batch_size, max_length=a.max_length), f"{a.out_dir}/nli_results")
        merged = nli.merge_scores(cands, spark.read.parquet(f"{a.out_dir}/nli_results"))
        sinks.write_parquet(merged, f"{a.out_dir}/cherrypicking_candidates_nli")
        sinks.write_csv(nli.summary(merged), f"{a.out_dir}/nli_summary", quote_all=True)
        sinks.write_group_json(nli.report(merged, a.topk_per_pair), f"{a.out_dir}/nli_report")
        return 0
    stages = cohort.Stages(spark, a.artifacts_root)
    cohort_id = a.cohort_id or cohort.default_cohort(getattr(a, "root", a.artifacts_root))
    if a.stage == "preview":
        cells = tabular.read_tables(tables.group_tables(tabular.list_files(spark, a.root)).select("path", "content"))
        report(tables.previews(cells))
    elif a.stage == "fetch":
        done = cohort.fetch_urls(spark, a.root, a.artifacts_root, a.include_groups, a.urls_subdir, a.url_timeout)
        report(done.groupBy("group_id").agg(F.count("*").alias("urls"), F.count("content").alias("saved")))
    elif a.stage == "extract":
        if not a.verify_only:
            stages.extract(a.root, cohort_id, a.include_groups, extractors(a), a.extensions, a.reextract, not a.no_merge_manifest)
        if a.verify or a.verify_only or a.verify_report:
            report(stages.status(a.root, a.include_groups), a.verify_report)
    elif a.stage == "pairs":
        stages.pairs(a.root, cohort_id, a.include_groups, a.prefer_excel, a.csv_encoding_sweep, a.urls_subdir)
        report(tables.worst_tables(stages.read("tables_report")))
    elif a.stage == "verify":
        stages.verify(VerifyConfig(bm25_topk=a.bm25_topk, cos_thresh=a.cos_thresh, fuzzy_thresh=a.fuzzy_thresh))
        report(stages.read("verification_summary"))
    elif a.stage == "sniff":
        cands = stages.sniff(triage_config(a), a.limit_rows)
        report(cands.agg(F.count("*").alias("candidates"), F.count_if("recommend_nli").alias("recommend_nli")))
    elif a.stage == "status":
        report(stages.status(a.root, a.include_groups))
    elif a.stage == "missing":
        report(corpus.missing_sidecars(stages.read("pairs_raw"), stages.read("source_text")))
    elif a.stage == "check":
        return broken(stages, a.bound)
    else:
        if a.wipe:
            cohort.wipe(spark, a.artifacts_root)
        from .sources.fetch import http_get

        vcfg = VerifyConfig(bm25_topk=a.bm25_topk, cos_thresh=a.cos_thresh, fuzzy_thresh=a.fuzzy_thresh)
        cohort.run(
            spark, a.root, a.artifacts_root, cohort_id, a.include_groups, extractors(a), vcfg, triage_config(a), a.cohort_note, a.reextract,
            http_get if a.fetch_urls else None, a.urls_subdir, a.limit_rows,
        )
        report(stages.read("verification_summary"))
        return broken(stages, [])
    return 0


if __name__ == "__main__":
    sys.exit(main())
