"""The whole flow over small folders of groups, and its stages by command line."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from veriflume import cli
from veriflume.operators import tables
from veriflume.plans import cohort
from veriflume.sources import extract, sidecars, tabular

TEXT = "Floods are rising in many deltas of the world. However, the data may be limited and uncertain. It could change."
TABLE = 'Quote from report,File name,Quote from source\n"Floods are said to be rising in deltas",flood risk.txt,"Floods are rising in many deltas of the world."\n"Sand goes to the sea each year",page.html,"Rivers carry sand to the sea"\nx,none,\n"Seas are salty everywhere they say",http://x.org/a,"All the seas are salty"\n'


def workbook(sheets: dict[str, str], links: tuple[str, ...] = ()) -> bytes:
    """A small .xlsx: sheet names to the XML of their rows; links hang on the first sheet."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{i}" Type="x" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{targets}</Relationships>')
        for i, body in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>' if body != "broken" else "<worksheet")
        each = "".join(f'<Relationship Id="h{i}" Type="{rel}/hyperlink" Target="{u}"/>' for i, u in enumerate(links))
        z.writestr("xl/worksheets/_rels/s1.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{each}</Relationships>')
    return out.getvalue()


def row(*cells: str) -> str:
    return "<row>" + "".join(f'<c t="inlineStr"><is><t>{c}</t></is></c>' for c in cells) + "</row>"


@pytest.fixture
def root(tmp_path):
    g = tmp_path / "in" / "group 1"
    (g / "urls").mkdir(parents=True)
    (g / "flood_risk.txt").write_text(TEXT)
    (g / "page.html").write_text("<p>Rivers carry sand to the sea every single year.</p>")
    (g / "table.csv").write_text(TABLE)
    (g / "urls" / "a.txt").write_text("All the seas are salty.")
    (g / "urls" / "_manifest.csv").write_text("timestamp,url,saved_as\n1,http://x.org/a,gone.txt\n2,http://x.org/a,urls/a.txt\n3,http://x.org/b,urls/none.txt\n")
    return tmp_path / "in"


def test_cohort(spark, root, tmp_path):
    done = cohort.run(spark, str(root), str(tmp_path / "out"), "c1", note="a note")
    pairs = {r.row_index: r for r in done["pairs_raw"].collect()}
    assert pairs[0].source_ref_type == "sha256" and pairs[1].extract_ok and pairs[2].source_ref_type == "unresolved"
    assert pairs[3].source_ref_type == "sha256" and pairs[3].resolved_source_path.endswith("urls/a.txt")
    assert done["verification_summary"].first().hits == 3
    assert done["cherrypicking_candidates"].count() > 0
    assert done["checks"].where("violations > 0 and not warn").count() == 0
    assert done["urls_manifest"].count() == 3 and done["cohort_meta"].first().note == "a note"
    # a second run extracts what is new only, and keeps what it knows
    (root / "group 1" / "new.txt").write_text("A new text that nobody cites.")
    again = cohort.run(spark, str(root), str(tmp_path / "out"), "c1")
    tools = {r.path.rsplit("/", 1)[-1]: r.extract_tool for r in again["extracted"].collect()}
    assert tools["new.txt"] == "text" and tools["page.html"] == "cached"
    assert again["source_text"].count() == 4 and again["sources"].count() == 4 and again["sources"].where("extract_ok").count() == 4
    assert again["verification_summary"].first().hits == 3


def test_many_groups_in_one_plan(spark, tmp_path):
    """Sheets by the hundred don't mean jobs by the hundred."""
    for i in range(200):
        g = tmp_path / "in" / f"g{i}"
        g.mkdir(parents=True)
        (g / "t.csv").write_text(f'Intro,,Quote from report,Quote from source,File\nx,,claim,"Long quote number {i}. It has a full stop",f{i}.pdf\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pairs", "pairs")
    got = cohort.build_pairs(spark, str(tmp_path / "in"), "c").collect()
    jobs = len(tracker.getJobIdsForGroup("pairs"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 200 and jobs < 20
    assert all(r.file_name_raw == f"f{r.group_id[1:]}.pdf" and r.quote_from_source.startswith("Long quote") for r in got)


def test_sheets(spark, tmp_path):
    """A broken sheet loses only itself; links and blanks are seen."""
    g = tmp_path / "in" / "g"
    g.mkdir(parents=True)
    good = row("Quote from report", "Source", "blank", "Quote from source") + row("Said so", "a.pdf", "", "It says so.")
    (g / "t.xlsx").write_bytes(workbook({"one": good, "two": "broken"}, ("http://linked.org/x",)))
    (g / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0rest")
    listing = tabular.list_files(spark, str(tmp_path / "in"))
    errors = {(r.path.rsplit("/", 1)[-1], r.sheet_name) for r in tabular.read_tables(listing.select("path", "content")).where("error is not null").collect()}
    assert errors == {("t.xlsx", "two"), ("old.xls", None)}
    pair = cohort.build_pairs(spark, str(tmp_path / "in"), "c").first()
    assert (pair.quote_from_report, pair.file_name_raw, pair.quote_from_source, pair.sheet_name) == ("Said so", "a.pdf", "It says so.", "one")
    assert [tuple(r) for r in cohort.urls_to_fetch(spark, str(tmp_path / "in")).collect()] == [("g", "http://linked.org/x")]
    shown = tables.previews(tabular.read_tables(listing.select("path", "content"))).first()
    assert shown.columns == ["quote_from_report", "file_name", "quote_from_source"] and shown.cells == ["Said so", "a.pdf", "It says so."]
    one = tabular.list_files(spark, str(g / "t.xlsx")).first()
    assert one.group_id == "t.xlsx"


def test_fetch(spark, root, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def fetcher(url, timeout):
        calls.add(1)
        if "bad" in url:
            raise OSError("no")
        return {"Content-Disposition": 'attachment; filename="x.pdf"'}, b"data"

    (root / "group 1" / "more.csv").write_text("File,Quote from report\nhttp://x.org/new,a\nhttp://bad.org/,b\n")
    done = {r.url: r for r in cohort.fetch_urls(spark, str(root), str(tmp_path / "out"), fetcher=fetcher).collect()}
    assert set(done) == {"http://x.org/new", "http://bad.org/"}  # the log has the other
    assert done["http://x.org/new"].name == "x.pdf" and bytes(done["http://x.org/new"].content) == b"data" and done["http://bad.org/"].saved_as is None


def test_tei_sentences_come_first(spark, tmp_path):
    tei = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><p><s>One from TEI.</s><s>Two.</s></p></TEI>'
    store = spark.createDataFrame([("a", "Plain. Text", tei), ("b", "Plain. Text", "<broken"), ("c", None, None)], "source_sha256 string, text string, tei_xml string")
    store.write.parquet(str(tmp_path / "source_text"))
    got = {r.sha: r.sents for r in cohort.Stages(spark, str(tmp_path)).sentences().collect()}
    assert got == {"a": ["One from TEI.", "Two."], "b": ["Plain.", "Text"], "c": []}


def test_text_by_digest_path_or_name(spark):
    rows = spark.createDataFrame([(1, "a", "x/1.txt"), (2, "zz", "x/1.txt"), (3, None, "elsewhere/2.txt"), (4, None, None)], "k int, source_sha256 string, source_text_path string")
    by_sha = spark.createDataFrame([("a", "by digest")], "source_sha256 string, text string")
    by_path = spark.createDataFrame([("x/1.txt", "by path"), ("store/2.txt", "by name")], "path string, text string")
    got = {r.k: r.text for r in sidecars.chosen_text(rows, by_sha, by_path, ["source_text_path"]).collect()}
    assert got == {1: "by digest", 2: "by path", 3: "by name", 4: None}


def test_ocr_and_limits():
    assert extract.ocr_program("no-such-program") is None
    waits = []
    limiter = extract.RateLimiter(2, clock=lambda: 0.0, sleep=waits.append)
    for _ in range(3):
        limiter.acquire()
    assert waits == [0.5, 1.0] and extract.limiter_of(3.0) is extract.limiter_of(3.0)


def test_command_line(spark, root, tmp_path, capsys):
    out = ["--artifacts-root", str(tmp_path / "o"), "--cohort-id", "c"]
    for stage in ("extract", "pairs"):
        assert cli.main([stage, str(root), *out]) == 0
    assert cli.main(["verify", *out]) == 0 and "success_ratio=1.0" in capsys.readouterr().out
    assert cli.main(["sniff", *out, "--limit-rows", "1", "--query-field", "quote_from_report"]) == 0
    assert spark.read.parquet(str(tmp_path / "o" / "cherrypicking_candidates")).select("row_id").distinct().count() == 1
    assert cli.main(["check", *out, "--bound", "group 1=0.9:1"]) == 0 and cli.main(["check", *out, "--bound", "group 1=0:0.5"]) == 1
    assert cli.main(["missing", *out]) == 0 and cli.main(["status", str(root), *out]) == 0
    assert cli.main(["extract", str(tmp_path / "nowhere"), *out]) == 2
    cands = str(tmp_path / "o" / "cherrypicking_candidates")
    assert cli.main(["nli", "--in-parquet", cands, "--out-dir", str(tmp_path / "n"), "--all", "--max-length", "50"]) == 0
    assert spark.read.parquet(str(tmp_path / "n" / "nli_results")).where(F.col("nli_label").isNotNull()).count() > 0


def test_no_candidates_are_explained(spark, tmp_path):
    pairs = spark.createDataFrame([("c", "g", "r", None, None, "short", "q", "t", "s", 0)], "cohort_id string, group_id string, row_id string, source_sha256 string, resolved_source_path string, quote_from_report string, quote_from_source string, table_path string, sheet_name string, row_index long")
    pairs.write.parquet(str(tmp_path / "pairs_raw"))
    spark.createDataFrame([], "source_sha256 string, text string, tei_xml string").write.parquet(str(tmp_path / "source_text"))
    cohort.Stages(spark, str(tmp_path)).sniff()
    got = spark.read.option("header", True).csv(str(tmp_path / "cherrypicking_summary")).first()
    assert got.group_id == "NO_CANDIDATES" and got.missing_sha == "1"
