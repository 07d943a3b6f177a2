"""The whole flow from files to reports: one session, one lineage, Parquet only where a stage is reused."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TriageConfig, VerifyConfig
from ..functions.text import clock, non_empty, unhyperlink
from ..operators import checks, corpus, tables, triage, verify
from ..sources import extract, fetch, sidecars, sinks, tabular

DOCUMENTS = ".pdf,.docx,.doc,.rtf,.html,.htm,.txt,.md,.rst"
PAIRS = "cohort_id string, group_id string, table_path string, sheet_name string, row_index long, quote_from_report string, file_name_raw string, quote_from_source string, row_id string"


def column_numbers(cells: DataFrame) -> DataFrame:
    """What column inference needs, per (path, sheet_name, pos, name), of all sheets in one pass."""
    each = cells.where("error is null").select("path", "sheet_name", F.posexplode("cells").alias("pos", "c")).select("path", "sheet_name", "pos", "c.name", "c.value")
    return tables.value_stats(each, ["path", "sheet_name", "pos", "name"], F.col("value"))


def canonical_places(numbers: DataFrame) -> DataFrame:
    """``path, sheet_name, quote_from_report, file_name, quote_from_source``: which column plays each part (null: none).

    A sheet's columns are few, so they meet in one call; sheets are spread over the cluster.
    """

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        live = rows[rows["any"] & (rows["filled"] | ~rows["name"].str.lower().str.startswith("unnamed"))]
        first: dict[str, int] = {}
        for name, pos in zip(tables.canonical_headers(live["name"].tolist()), live["pos"].tolist(), strict=True):
            first.setdefault(name, pos)  # of equal names the first
        stats = {n: {k: None if pd.isna(v) else v for k, v in rows.set_index("pos").loc[p, ["length", "punct", "fileish", "quotey"]].items()} for n, p in first.items()}
        picks = tables.choose_columns(list(first), stats) if first else dict.fromkeys(tables.CANON)
        out = {c: [None if picks[c] is None else first[picks[c]]] for c in tables.CANON}
        return pd.DataFrame({"path": rows["path"].iloc[:1].tolist(), "sheet_name": rows["sheet_name"].iloc[:1].tolist()} | out).astype({c: "Int64" for c in tables.CANON})

    return numbers.groupBy("path", "sheet_name").applyInPandas(choose, "path string, sheet_name string, quote_from_report long, file_name long, quote_from_source long")


def build_pairs(spark: SparkSession, root: str, cohort_id: str, include: str = "", prefer_excel: bool = False, sweep: bool = True) -> DataFrame:
    """The citation rows of all tables under ``root``, canonical columns only.

    All sheets go through one plan: their cells are read once, numbers per column choose the parts, and rows pick their
    cells by place. Nothing is looped over on the driver.
    """
    files = tabular.list_files(spark, root, recursive=True).where(corpus.included_groups(include, F.col("group_id")))
    listing = tables.group_tables(files, prefer_excel)
    cells = tabular.read_tables(listing.select("path", "content"), sweep)
    places = canonical_places(column_numbers(cells))

    def cell(part: str) -> Column:
        at = F.when(F.col(part).isNotNull(), F.try_element_at("cells", (F.col(part) + 1).cast("int"))["value"])
        return unhyperlink(F.coalesce(at, F.lit("")))

    rows = cells.where("error is null").join(places, ["path", "sheet_name"]).join(listing.select("path", "group_id"), "path")
    rows = rows.select(
        F.lit(cohort_id).alias("cohort_id"), "group_id", F.col("path").alias("table_path"), "sheet_name", "row_index",
        cell("quote_from_report").alias("quote_from_report"), cell("file_name").alias("file_name_raw"), cell("quote_from_source").alias("quote_from_source"),
    )
    key = tables.row_key(F.col("group_id"), F.element_at(F.split("table_path", "/"), -1), F.col("sheet_name"), F.col("row_index"))
    return tables.with_graph_flag(rows.withColumn("row_id", key))


def url_map(spark: SparkSession, root: str, include: str = "", urls_subdir: str = "urls") -> tuple[DataFrame, DataFrame]:
    """``group_id, url, saved_as`` (saved_as: the path of a file that is there) of the groups' download logs, and the
    logs themselves (``timestamp, url, saved_as, group_id``)."""
    every = tabular.list_files(spark, root)
    log = tabular.read_manifests(spark, root, urls_subdir).where(corpus.included_groups(include, F.col("group_id")))
    latest = tables.latest_manifest(log.where(non_empty(F.col("url")) & non_empty(F.col("saved_as"))))
    base = tabular.plain_root(root)
    there = every.select("group_id", F.col("path").alias("file"), tabular.relative(F.col("path"), base).alias("rel"))
    found = latest.withColumn("rel", F.concat_ws("/", "group_id", F.regexp_replace("saved_as", r"^\./", ""))).join(there, ["group_id", "rel"])
    return found.select("group_id", "url", F.col("file").alias("saved_as")), tables.consolidated_manifest([log], spark)


def urls_to_fetch(spark: SparkSession, root: str, include: str = "") -> DataFrame:
    """``group_id, url``: URLs in the cells of the groups' tables and behind the hyperlinks of their workbooks."""
    files = tables.group_tables(tabular.list_files(spark, root).where(corpus.included_groups(include, F.col("group_id"))))
    cells = tabular.read_tables(files.select("path", "content")).where("error is null").join(files.select("path", "group_id"), "path")
    values = cells.select("group_id", F.explode(F.transform("cells", lambda c: c["value"])).alias("value"))
    links = tabular.read_links(files).join(files.select("path", "group_id"), "path")
    return tables.urls_of_tables(values, ["group_id"], links).select("group_id", F.explode("urls").alias("url"))


def fetch_urls(spark: SparkSession, root: str, out: str, include: str = "", urls_subdir: str = "urls", timeout: float = 20, fetcher: fetch.Fetcher = fetch.http_get) -> DataFrame:
    """Download what the logs lack: bodies as a table under ``out/downloads``, and a log like those of the groups."""
    _, log = url_map(spark, root, include, urls_subdir)
    got = fetch.fetch(urls_to_fetch(spark, root, include), log, fetcher, timeout)
    got.write.mode("append").parquet(f"{out}/downloads")
    done = spark.read.parquet(f"{out}/downloads")
    sinks.append_log(done.select("timestamp", "url", "saved_as", "group_id"), f"{out}/urls_manifest_log")
    return done


def default_cohort(root: str) -> str:
    return tabular.plain_root(root).rstrip("/").rsplit("/", 1)[-1] or "cohort"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def wipe(spark: SparkSession, out: str) -> None:
    """Delete the tables and reports of an output root."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in (*NAMES, "verification", "cherrypicking_summary", "cherrypicking_teacher", "cherrypicking_report"):
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/{name}"), True)


class Stages:
    """The stages over one output root; each writes its tables there and reads those of the stages before it."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def has(self, name: str) -> bool:
        return exists(self.spark, f"{self.out}/{name}/_SUCCESS")

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        sinks.write_parquet(df, f"{self.out}/{name}")
        return self.read(name)

    def swap(self, name: str, df: DataFrame) -> DataFrame:
        """Write what may be computed from the table's former state: first beside it, then in its place."""
        beside = self.keep(f"{name}_next", df)
        return self.keep(name, beside)

    def extract(self, root: str, cohort_id: str, include: str = "", tools: extract.Extractors = extract.Extractors(), extensions: str = DOCUMENTS, reextract: bool = False, merge: bool = True) -> DataFrame:
        """``extracted``, ``sources`` (merged with what is there) and ``source_text``, to which only unseen digests are
        appended, unless all are to be written again. Files with a known digest are not opened by an extractor."""
        wanted = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*tabular.extensions(extensions))
        docs = tabular.list_files(self.spark, root).where(wanted).where(corpus.included_groups(include, F.col("group_id")))
        known = self.read("source_text").select("source_sha256").distinct() if self.has("source_text") and not reextract else None
        identified = docs.withColumn("source_sha256", F.sha2("content", 256))
        todo = identified if known is None else identified.join(known, "source_sha256", "left_anti")
        made = extract.extract_documents(todo.select("path", "content"), tools).join(todo.select("path", "group_id"), "path")
        if known is not None:
            old = identified.join(known, "source_sha256").select("path", "source_sha256", "group_id", F.length("content").cast("long").alias("bytes"))
            suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
            old = old.withColumns({"canonical_ext": suffix, "extract_tool": F.lit("cached"), "ocr_used": F.lit(False), "extract_ok": F.lit(True)})
            made = made.unionByName(old, allowMissingColumns=True)
        texts = self.keep("extracted", made)
        new = texts.where("text is not null or tei_xml is not null").groupBy("source_sha256").agg(F.min_by(F.struct("text", "tei_xml"), "path").alias("t")).select("source_sha256", "t.*")
        if self.has("source_text") and not reextract:
            sinks.append_texts(corpus.new_artifacts(new, self.read("source_text")), f"{self.out}/source_text")
        else:
            self.keep("source_text", new)
        columns = ["source_sha256", "canonical_ext", "bytes", "path", "extract_tool", "ocr_used", "extract_ok", "extract_error", "group_id"]
        found = corpus.dedup(texts.select(*columns), "source_sha256", ["group_id", "path"], "path").withColumnRenamed("path", "first_seen_path").withColumn("cohort_id", F.lit(cohort_id))
        if self.has("sources") and merge:
            return self.swap("sources", corpus.merge_sources(self.read("sources"), found, rule="last"))
        return self.keep("sources", found)

    def pairs(self, root: str, cohort_id: str, include: str = "", prefer_excel: bool = False, sweep: bool = True, urls_subdir: str = "urls") -> DataFrame:
        """``pairs_raw``, ``tables_report`` and ``urls_manifest``."""
        pairs = build_pairs(self.spark, root, cohort_id, include, prefer_excel, sweep).withColumn("key", F.col("row_id"))
        texts = self.read("extracted")
        named = tables.resolve_names(pairs, texts.select("group_id", "path"))
        saved, log = url_map(self.spark, root, include, urls_subdir)
        self.keep("urls_manifest", log)
        resolved = tables.resolve_references(named, saved, texts.select("path", "source_sha256").distinct())
        status = self.read("sources").select("source_sha256", "extract_ok", "extract_error", "extract_tool", "ocr_used")
        out = resolved.join(status, "source_sha256", "left").withColumn("extract_ok", F.coalesce("extract_ok", F.lit(False))).drop("key", "name_score")
        done = self.keep("pairs_raw", out)
        self.keep("tables_report", tables.tables_report(done))
        return done

    def sentences(self) -> DataFrame:
        """``sha, sents`` of every stored text: those of its TEI document, else of its plain text."""
        store = extract.tei_sentences(self.read("source_text"), "tei_xml", "tei_sentences")
        return sidecars.index_sentences(store).select(F.col("source_sha256").alias("sha"), "sents")

    def verify(self, cfg: VerifyConfig = VerifyConfig()) -> DataFrame:
        """``quote_evidence``, ``verification_summary`` and a report per group."""
        pairs = self.read("pairs_raw")
        quotes = pairs.select(F.col("row_id").alias("query_id"), F.col("source_sha256").alias("sha"), F.col("quote_from_source").alias("quote"))
        name = verify.display_name(F.col("resolved_source_path"), F.col("file_name_raw"))
        names = pairs.select(F.col("row_id").alias("query_id"), "group_id", name.alias("source_filename"))
        evidence = self.keep("quote_evidence", verify.verify_quotes(quotes, self.sentences(), cfg).join(names, "query_id"))
        asked = evidence.where("intent <> 'empty'")
        self.keep("verification_summary", verify.summary(asked, pairs.select("group_id")))
        sinks.write_group_json(verify.group_report(asked, cfg), f"{self.out}/verification")
        return evidence

    def sniff(self, cfg: TriageConfig = TriageConfig(), limit_rows: int = 0) -> DataFrame:
        """``cherrypicking_candidates`` and their summary, teacher's table and report. ``limit_rows`` keeps so many pairs
        in order of their place (0: all). Without candidates the summary tells why."""
        pairs = self.read("pairs_raw")
        pairs = pairs.orderBy("group_id", "table_path", "sheet_name", "row_index").limit(limit_rows) if limit_rows else pairs
        texts = self.read("source_text").where("text is not null").select(F.col("source_sha256").alias("sha"), "text")
        cands = self.keep("cherrypicking_candidates", triage.candidates(pairs, texts, cfg))
        if cands.limit(1).count():
            sinks.write_csv(triage.summary(cands), f"{self.out}/cherrypicking_summary")
        else:
            have = pairs.join(texts.select(F.col("sha").alias("source_sha256"), F.lit(True).alias("has")), "source_sha256", "left")
            why = triage.skip_reason(F.col("source_sha256"), F.col(cfg.query_field), F.col("has"), cfg.min_claim_chars)
            sinks.write_csv(triage.empty_summary(have.withColumn("skip_reason", why)), f"{self.out}/cherrypicking_summary")
        sinks.write_csv(triage.teacher_view(cands), f"{self.out}/cherrypicking_teacher", quote_all=True)
        sinks.write_group_json(triage.nested_report(cands).withColumnRenamed("group_id", "group"), f"{self.out}/cherrypicking_report")
        return cands

    def status(self, root: str, include: str = "") -> DataFrame:
        """``extraction_status``: per group the files that should have a text, those that have, and the others."""
        texts = self.read("extracted").where(corpus.included_groups(include, F.col("group_id")))
        return self.keep("extraction_status", corpus.extraction_status(texts.select("group_id", "path", "source_sha256"), self.read("source_text"), self.read("sources")))

    def checks(self) -> DataFrame:
        return self.keep("checks", checks.invariants(*[self.read(n) for n in ("pairs_raw", "sources", "tables_report", "verification_summary")]))

    def meta(self, cohort_id: str, note: str | None) -> DataFrame:
        """``cohort_meta``: which run this was."""
        counts = self.read("sources").agg(F.count("*").alias("sources"), F.count_if("extract_ok").alias("extracted"))
        return self.keep("cohort_meta", counts.select(F.lit(cohort_id).alias("cohort_id"), F.lit(note).cast("string").alias("note"), clock().alias("finished_at"), "sources", "extracted"))


NAMES = ("extracted", "sources", "source_text", "pairs_raw", "urls_manifest", "tables_report", "quote_evidence", "verification_summary", "cherrypicking_candidates", "extraction_status", "checks", "cohort_meta")


def run(
    spark: SparkSession, root: str, out: str, cohort_id: str | None = None, include: str = "", tools: extract.Extractors = extract.Extractors(),
    vcfg: VerifyConfig = VerifyConfig(), tcfg: TriageConfig = TriageConfig(), note: str | None = None, reextract: bool = False,
    fetcher: Callable | None = None, urls_subdir: str = "urls", limit_rows: int = 0,
) -> dict[str, DataFrame]:
    """Fetch (if a fetcher is given), extract, pair, resolve, verify, triage, check; every table is written under ``out``
    and returned as read back."""
    cohort_id = cohort_id or default_cohort(root)
    if fetcher:
        fetch_urls(spark, root, out, include, urls_subdir, fetcher=fetcher)
    s = Stages(spark, out)
    s.extract(root, cohort_id, include, tools, reextract=reextract)
    s.pairs(root, cohort_id, include, urls_subdir=urls_subdir)
    s.verify(vcfg)
    s.sniff(tcfg, limit_rows)
    s.status(root, include)
    s.checks()
    s.meta(cohort_id, note)
    return {n: s.read(n) for n in NAMES}
