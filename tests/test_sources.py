import json
import zipfile
from datetime import date

import pytest
from conftest import rows

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.sinks.files import export_report, report_file_name, write_dead_letters, write_json_lines
from ledgerflow.sinks.messages import as_messages, write_messages
from ledgerflow.sinks.tables import copy_table, write_table
from ledgerflow.operators.batches import json_batches
from ledgerflow.sources.csv import read_csv_source
from ledgerflow.sources.pages import explode_pages, trim_pages
from ledgerflow.sources.paths import dated_path, resolve_path, shard_table
from ledgerflow.sources.router import SourceSpec, read_source
from ledgerflow.sources.tables import read_query, read_table, table_facts
from ledgerflow.sources.workbooks import double_text, read_workbooks

CSV = 'id;name;note\n1;"a ""q""; b";x\n\n2;;y\n3;short\n4\n5;a;b;extra\n7;;\n8;"";w\n9;"";\n'


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV)
    got = {r["id"]: (r["name"], r["note"]) for r in read_csv_source(spark, str(path), delimiter=";|").collect()}
    assert got == {
        "1": ('a "q"; b', "x"), "2": ("", "y"), "3": ("short", None), "4": (None, None), "5": ("a", "b"),
        "7": ("", ""), "8": ("", "w"), "9": ("", ""),
    }


def test_csv_short_rows_keep_inner_empty_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a,b,c,d\n1,,"x,y"\n')
    assert rows(read_csv_source(spark, str(path))) == [("1", "", "x,y", None)]


def test_csv_quoted_newlines(spark, tmp_path):
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('id,text\n1,"two\nlines"\n2,one\n')
    assert rows(read_csv_source(spark, str(quoted))) == [("1", "two\nlines"), ("2", "one")]


def test_csv_without_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("1,x\n2,\n3,y,z\n")
    got = read_csv_source(spark, str(path), has_header=False)
    assert got.columns == ["field_0", "field_1"]
    assert rows(got) == [("1", "x"), ("2", ""), ("3", "y")]
    with pytest.raises(ValueError):
        read_csv_source(spark, str(path), delimiter="")


def test_paths():
    day = date(2024, 1, 31)
    assert resolve_path("gs://b", "x_{dateCompact}_", "{periodId}.csv", day, "202401") == "gs://b/x_20240131_202401.csv"
    assert resolve_path("/d/", None, "{date}{periodId}", day) == "/d/2024-01-31"
    assert dated_path("base", day) == "base/2024-01-31/"
    assert shard_table("t", day) == "t$20240131"
    assert report_file_name("r", "202401", day, "JSON", "{date}-", "-v1") == "2024-01-31-r_202401_2024-01-31-v1.json"


def test_file_source_by_dated_path(spark, tmp_path):
    (tmp_path / "t_20240131.csv").write_text("a\n1\n")
    spec = SourceSpec("FILE", path=str(tmp_path), prefix="t_", suffix="{dateCompact}.csv")
    got = read_source(spark, spec, RunTokens(run_date="2024-01-31"), mode="load")
    assert rows(got) == [("1",)]


def pages_of(spark, bodies, source="s"):
    data = [(source, i + 1, json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "source string, page int, body string")


def kept(df):
    return sorted(r["page"] for r in df.collect())


def test_page_numbers_stop_at_the_first_empty_page(spark):
    pages = pages_of(spark, [[1, 2], [], [3, 4]])
    assert kept(trim_pages(pages, "PAGE_NUMBER")) == [1]
    assert kept(trim_pages(pages_of(spark, [[1], [2]]), "PAGE_NUMBER")) == [1, 2]
    both = pages.unionByName(pages_of(spark, [[1], [2], []], "t"))
    assert kept(trim_pages(both, "PAGE_NUMBER")) == [1, 1, 2]


def test_offsets_stop_after_the_first_short_page(spark):
    pages = pages_of(spark, [[1, 2], [3, 4], [5], [6, 7]])
    assert kept(trim_pages(pages, "OFFSET", page_size=2)) == [1, 2, 3]
    exact = pages_of(spark, [[1, 2], [3, 4], [], [9]])
    assert kept(trim_pages(exact, "OFFSET", page_size=2)) == [1, 2, 3]


@pytest.mark.parametrize("last", [{"m": {"next": ""}}, {"m": {"next": None}}, {"m": {}}, {"m": {"next": "  "}}])
def test_cursors_stop_at_a_blank_null_or_missing_cursor(spark, last):
    pages = pages_of(spark, [{"m": {"next": "c1"}}, last, {"m": {"next": "c3"}}])
    assert kept(trim_pages(pages, "CURSOR", data_path="d", next_path="m.next")) == [1, 2]


def test_unknown_strategy_keeps_the_first_page(spark):
    assert kept(trim_pages(pages_of(spark, [[1], [2]]), "KEYSET")) == [1]
    assert kept(trim_pages(pages_of(spark, [[1], [2]]), None)) == [1]


def test_records_by_path(spark):
    bodies = [{"d": {"items": [{"b": 1, "a": "x"}, "s", 2, None]}}, {"d": {"items": "[1]"}}, {"d": 5}]
    got = [r["raw_json"] for r in explode_pages(pages_of(spark, bodies), "d.items").collect()]
    assert [json.loads(t) for t in got] == [{"b": 1, "a": "x"}, "s", 2, None]
    root = explode_pages(pages_of(spark, [[{"q": 1}], {"q": 2}]))
    assert [json.loads(r["raw_json"]) for r in root.collect()] == [{"q": 1}]


def test_unreadable_bodies(spark):
    pages = spark.createDataFrame([("s", 1, "{oops")], "source string, page int, body string")
    with pytest.raises(Exception, match="MALFORMED"):
        explode_pages(pages).collect()
    assert explode_pages(pages, strict=False).count() == 0


def test_api_source_reads_landed_pages(spark, tmp_path):
    pages_of(spark, [[{"a": 1}], [], [{"a": 3}]]).write.parquet(str(tmp_path / "landed"))
    spec = SourceSpec("API", path=str(tmp_path / "landed"), pagination_enabled=True, pagination_strategy="PAGE_NUMBER")
    assert rows(read_source(spark, spec, mode="load")) == [('{"a":1}',)]


def test_query_wins_over_table(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    assert read_query(spark, "SELECT 1 AS x", "numbers").columns == ["x"]
    assert read_query(spark, " ", "numbers").count() == 3
    bound = read_query(spark, "SELECT * FROM {t} WHERE id = :x", args={"x": 2}, t=spark.range(5))
    assert rows(bound) == [(2,)]
    assert rows(read_table(spark, "numbers", as_strings=True)) == [("0",), ("1",), ("2",)]


def test_table_facts(spark):
    spark.range(3).createOrReplaceTempView("numbers")
    facts = table_facts(spark, "numbers")
    assert (facts.exists, facts.row_count, facts.schema.names) == (True, 3, ["id"])
    absent = table_facts(spark, "no_such_table")
    assert (absent.exists, absent.row_count, absent.schema) == (False, -1, None)


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(path, sheet_rows, shared=()):
    """A workbook whose second sheet holds the given row XML."""
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets><sheet name="a" sheetId="1" r:id="r1"/>'
            '<sheet name="b" sheetId="2" r:id="r2"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="r1" Type="t" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="r2" Type="t" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        items = "".join(f"<si><t>{s}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{items}</sst>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{sheet_rows}</sheetData></worksheet>')


def test_workbook_cells(spark, tmp_path):
    body = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>z</t></is></c></row>'
        '<row r="2"><c r="A2"><v>3.0</v></c><c r="B2" t="b"><v>1</v></c><c r="C2"><f>A1+1</f><v>9</v></c></row>'
        '<row r="3"><c r="A3"><v>1.5</v></c><c r="C3" t="str"><v>late</v></c></row>'
        '<row r="4"><c r="A4"/><c r="B4" t="e"><v>#N/A</v></c></row>'
    )
    workbook(tmp_path / "w.xlsx", body, ("x", "y"))
    got = [json.loads(r["raw_json"]) for r in read_workbooks(spark, f"{tmp_path}/*.xlsx", sheet_index=1).collect()]
    assert got == [
        {"x": "3", "y": "true", "z": "A1+1"},
        {"x": "1.5", "y": "late", "z": None},
        {"x": "", "y": "", "z": None},
    ]
    plain = read_workbooks(spark, f"{tmp_path}/*.xlsx", sheet_index=1, has_header=False)
    first = json.loads(plain.first()["raw_json"])
    assert first == {"field_0": "x", "field_1": "y", "field_2": "z"}
    assert read_workbooks(spark, f"{tmp_path}/*.xlsx", sheet_index=0).count() == 0


def test_double_text():
    cases = {3.0: "3", -2.5: "-2.5", 12345678.5: "1.23456785E7", 0.00012: "1.2E-4", 0.001: "0.001", 1e15: "1000000000000000"}
    assert {k: double_text(k) for k in cases} == cases


def test_json_lines_write_nulls(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 'q\"\\n' AS c, CAST(1.50 AS DECIMAL(5,2)) AS d, true AS e")
    write_json_lines(df, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("*.json"))
    assert len(files) == 1
    assert files[0].read_text().strip() == '{"a":1,"b":null,"c":"q\\"\\n","d":1.50,"e":true}'


def test_dead_letters_without_path_are_discarded(spark, tmp_path):
    assert write_dead_letters(spark.range(1), None) is False
    assert write_dead_letters(spark.range(1), str(tmp_path / "dead")) is True


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", "")], "x string, y string").coalesce(1)
    export_report(df, str(tmp_path / "c"), "csv", header=False)
    assert next((tmp_path / "c").glob("*.csv")).read_text() == "a,\n"
    with pytest.raises(ValueError):
        export_report(df, str(tmp_path / "d"), "XML")


def test_table_sink(spark):
    spark.sql("CREATE TABLE sink_t (b STRING, a INT) USING parquet")
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    write_table(df, "sink_t")
    write_table(df, "sink_t", "APPEND")
    assert rows(spark.table("sink_t")) == [("x", 1), ("x", 1)]
    write_table(df, "sink_t", "TRUNCATE")
    assert rows(spark.table("sink_t")) == [("x", 1)]
    with pytest.raises(ValueError, match="does not exist"):
        write_table(df, "absent_t")
    with pytest.raises(ValueError, match="disposition"):
        write_table(df, "sink_t", "MERGE")
    copy_table(df, "copied_t")
    copy_table(df, "copied_t")
    assert spark.table("copied_t").count() == 1


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert as_messages(df).first()[0] == '{"a":1,"b":null}'
    write_messages(df, "text", path=str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).count() == 1


def test_batches_keep_order_and_size(spark):
    df = spark.range(0, 10, 1, 2)
    got = json_batches(df, 3).collect()
    assert sorted(r["row_count"] for r in got) == [2, 2, 3, 3]
    found = [row["id"] for r in got for row in json.loads(r["payload"])]
    assert found == list(range(10))
    with pytest.raises(ValueError):
        json_batches(df, 0)
    assert "Exchange" not in json_batches(df, 3)._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_footers_and_statistics(spark, tmp_path):
    from ledgerflow.sources.tables import footer_count, footer_settings

    path = str(tmp_path / "counted")
    spark.range(100).write.parquet(path)
    assert table_facts(spark, path).row_count == 100
    with footer_settings(spark):
        plan = footer_count(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    spark.sql(f"CREATE TABLE analyzed USING parquet LOCATION '{path}'")
    assert table_facts(spark, "analyzed").row_count == 100
    spark.sql("ANALYZE TABLE analyzed COMPUTE STATISTICS")
    spark.range(5).write.mode("append").parquet(path)  # behind the catalog's back
    assert table_facts(spark, "analyzed").row_count == 100
    spark.sql("DROP TABLE analyzed")


def test_payloads_are_bounded_by_bytes(spark):
    df = spark.createDataFrame([("é" * n,) for n in (1, 3, 2, 40, 1, 1, 0)], "s string").coalesce(1)
    found = [(r["row_count"], len(r["payload"].encode()), r["oversized"]) for r in json_batches(df, 10, max_bytes=40).collect()]
    assert [n for n, *_ in found] == [3, 1, 3] and [o for *_, o in found] == [False, True, False]  # 40, 90 and 32 bytes
    assert all(size <= 40 or oversized for _, size, oversized in found)
    exact = len(b'[{"s":"\xc3\xa9"},{"s":"\xc3\xa9\xc3\xa9\xc3\xa9"}]')
    assert json_batches(df.limit(2), 10, max_bytes=exact).count() == 1 and json_batches(df.limit(2), 10, max_bytes=exact - 1).count() == 2
    with pytest.raises(ValueError):
        json_batches(df, 1, max_bytes=1)
