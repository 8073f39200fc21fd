import zipfile

import pytest

from ledgerloom.sources import files, sinks
from ledgerloom.streaming import runlog


def workbook(path):
    cell = lambda r, v: f'<c r="{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    rows = [("A1", "name"), ("B1", "id")], [("A2", "甲"), ("B2", "1")], [], [("B4", "2")]
    xml = "".join(f'<row>{"".join(cell(r, v) for r, v in row)}</row>' for row in rows)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{xml}</sheetData></worksheet>')


def test_company_tables(spark, tmp_path):
    workbook(tmp_path / "a.xlsx")
    assert [tuple(r) for r in files.company_table(spark, str(tmp_path / "a.xlsx")).collect()] == [("甲", "1"), (None, "2")]
    (tmp_path / "a.csv").write_text('﻿name,id\n"x, y",1\n', encoding="utf-8")
    assert [tuple(r) for r in files.company_table(spark, str(tmp_path / "a.csv")).collect()] == [("x, y", "1")]
    with pytest.raises(ValueError):
        files.company_table(spark, "a.txt")


def test_json_and_pipe_tables(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"tracks": [{"n": 1}, {"n": 2}]}')
    assert {r.n for r in files.catalogue(spark, str(tmp_path / "t.json")).collect()} == {1, 2}
    (tmp_path / "p.md").write_text("# x\n| a | b |\n|---|---|\n| 1 | 2 |\n| only |\n| 3 | 4 |\n")
    assert [tuple(r) for r in files.pipe_table(spark, str(tmp_path / "p.md"), ["a", "b"]).collect()] == [("P001", "1", "2"), ("P002", "3", "4")]
    (tmp_path / "d.html").write_text('<script>const D = {"a": 5};</script>')
    assert files.embedded_json(spark, str(tmp_path / "d.html"), r"const D = (\{.*?\});", "a int").first().payload.a == 5


def test_html(spark):
    html = '<html><head><title>T</title><meta property="article:published_time" content="2024-01-02"></head><body><nav>menu</nav><article><p>One &amp; two</p><script>x</script></article><footer>f</footer></body></html>'
    r = {x.k: x for x in files.html_pages(spark.createDataFrame([(1, html), (2, None)], "k int, h string"), "k", "h").collect()}
    assert (r[1].title, r[1].published, r[1].text, r[2].text) == ("T", "2024-01-02", "One & two", "")


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "</x>")], "k int, l array<string>, s string")
    assert sinks.write_rows(df, str(tmp_path / "out")) and not sinks.write_rows(df.where("k > 1"), str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "out.parquet")).collect() == df.collect()
    assert spark.read.csv(str(tmp_path / "out.csv"), header=True).first().l == "a;b"
    assert sinks.dashboard({"t": df}, "<script>{{payload}}</script>").count("</") == 1
    with pytest.raises(ValueError):
        sinks.dashboard({"t": df.union(df)}, "{{payload}}", most_rows=1)


def test_streams(spark, tmp_path):
    rows = [("j", "2024-01-01 10:00:00", "running"), ("j", "2024-01-01 10:01:00", "failed"), ("k", "2024-01-01 10:30:00", "completed")]
    spark.createDataFrame(rows, "job string, ts string, status string").selectExpr("job", "cast(ts as timestamp) ts", "status").write.parquet(str(tmp_path / "log"))
    log = runlog.log_stream(spark, str(tmp_path / "log"), "job string, ts timestamp, status string")
    for name, df, mode in (("counts", runlog.windowed_counts(log, "ts", "status"), "complete"), ("states", runlog.job_states(log, "job", "ts", "status"), "update")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert {(r.status, r.n) for r in spark.table("counts").collect()} == {("running", 1), ("failed", 1), ("completed", 1)}
    assert {(r.job, r.state, r.attempts) for r in spark.table("states").collect()} == {("j", "failed_retryable", 1), ("k", "completed", 0)}
