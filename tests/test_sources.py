import io
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from driver_queries.workbooks import workbook
from siltstone import fs
from siltstone.operators import drop_failing
from siltstone.plans.bronze import ingest, unified_entity
from siltstone.sources import registry as reg
from siltstone.sources.discovery import discover_sources
from siltstone.sources.readers import corrupt_xml, read_source, read_table, source_schema
from siltstone.sources.records import read_records
from siltstone.sources.schemas import merge_schemas
from siltstone.sources.xlsx import header_names, read_xlsx, sheet_rows
from siltstone.specs import Expectation, SourceSpec


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    mode = "wb" if isinstance(content, bytes) else "w"
    with open(folder / name, mode) as out:
        out.write(content)
    return str(folder)


XML = """<?xml version="1.0" encoding="UTF-8"?>
<root><meta>1</meta><group><record id="9" k="attribute"><k>child</k><name lang="en">A &lt;b&gt;</name>
<rep>1</rep><rep>2</rep><e/><sp>  two </sp><n>007</n></record></group>
<record><id>5</id><name>B</name></record></root>"""
BAD_XML = "<root><record><id>6</name></record></root>"


@pytest.mark.parametrize("streaming", [False, True])
def test_xml(spark, tmp_path, streaming):
    path = put(tmp_path / "in", "a.xml", XML)
    put(tmp_path / "in", "bad.xml", BAD_XML)
    spec = SourceSpec("s", "e", format="xml", base_path=path)
    df = read_source(spark, spec, streaming)
    if streaming:
        q = df.writeStream.format("memory").queryName("xml_rows").trigger(availableNow=True).start()
        q.awaitTermination()
        df = spark.table("xml_rows")
    found = {r.id: r for r in df.collect()}
    assert set(found) == {"9", "5"}
    nine, five = found["9"], found["5"]
    assert (nine.k, nine.name, nine.rep, nine.e, nine.sp, nine.n) == ("attribute", "A <b>", "2", None, "  two ", "007")
    assert (five.k, five.name, five["_source"]) == (None, "B", "s")
    assert [r.file.rsplit("/", 1)[1] for r in corrupt_xml(spark, spec).collect()] == ["bad.xml"]


def test_xml_declared_columns_and_encoding(spark, tmp_path):
    path = put(tmp_path / "in", "a.xml", "<?xml version='1.0' encoding='ISO-8859-1'?><r><record><a>é</a></record></r>".encode("iso-8859-1"))
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    spec = SourceSpec("s", "e", format="xml", base_path=path, schema=schema)
    assert rows(read_source(spark, spec)) == [("é", None, "s")] and read_source(spark, spec).count() == 1


ENCODED = """<rows>é<!-- <record><name>left out</name></record> -->
<record k="ä > b"><name>Jörg <b>é</b></name><t><![CDATA[a </record> & <!-- b]]></t></record >
<record k='s'/><recorder>no</recorder><record><name></name><name>Zoë</name></record><record k="never"><name>x
<record><name>ÿ</name><k>child</k></record></rows>"""


@pytest.mark.parametrize("encoding", ["ISO-8859-1", "UTF-16", "utf_8"])
@pytest.mark.parametrize("streaming", [False, True])
def test_xml_in_the_encoding_the_registry_names(spark, tmp_path, encoding, streaming):
    path = put(tmp_path / "in", "a.xml", ENCODED.encode(encoding.replace("_", "-")))
    put(tmp_path / "in", "none.xml", "<rows/>".encode(encoding.replace("_", "-")))
    spec = SourceSpec("s", "e", format="xml", base_path=path, encoding=encoding)
    if encoding == "utf_8":  # left to Spark's own reader
        assert "recorder" not in source_schema(spark, spec).names
        return
    assert source_schema(spark, spec).names == ["k", "name", "t"]
    df = read_source(spark, spec, streaming)
    if streaming:
        name = f"xml_{encoding[:3].lower()}"
        q = df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
        df = spark.table(name)
    found = sorted(df.collect(), key=str)
    want = [("ä > b", "Jörg <b>é</b>", "a </record> & <!-- b", "s"), ("s", None, None, "s"), (None, "Zoë", None, "s"), ("child", "ÿ", None, "s")]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    lost = corrupt_xml(spark, spec).collect()
    assert [r.file.rsplit("/", 1)[1] for r in lost] == ["a.xml"] and "never" in lost[0]["_corrupt_record"]


def test_xml_of_many_records_is_cut_in_one_pass(spark, tmp_path):
    records = "".join(f'<record id="{i}"/>' if i % 2 else f"<record><id>{i}</id></record>" for i in range(40_000))
    path = put(tmp_path / "in", "a.xml", f"<r>{records}{'<record/>' * 20_000}</r>".encode("iso-8859-1"))
    schema = T.StructType([T.StructField("id", T.StringType())])
    df = read_source(spark, SourceSpec("s", "e", format="xml", base_path=path, schema=schema, encoding="ISO-8859-1"))
    assert df.count() == 60_000 and df.where("id is not null").select("id").distinct().count() == 40_000


def test_csv_options_and_types(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", "id|name\n1|é\n2|b\n".encode("iso-8859-1"))
    spec = SourceSpec("s", "e", format="csv", base_path=path, delimiter="|", encoding="ISO-8859-1")
    assert rows(read_source(spark, spec)) == [(1, "é", "s"), (2, "b", "s")]
    assert dict(read_source(spark, spec).dtypes)["id"] == "bigint"
    bare = SourceSpec("s", "e", format="csv", base_path=path, delimiter="|", has_header=False)
    assert read_source(spark, bare).count() == 3


def test_csv_with_another_header_fails(spark, tmp_path):
    path = put(tmp_path / "in", "a.csv", "id,name\n1,a\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.StringType())])
    spec = SourceSpec("s", "e", format="csv", base_path=path, schema=schema)
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, spec).collect()


def test_rename_and_unknown(spark, tmp_path):
    path = put(tmp_path / "in", "a.json", '{"uid": 1}\n')
    spec = SourceSpec("s", "e", base_path=path, rename={"uid": "user_id"})
    assert read_source(spark, spec).columns == ["user_id", "_source"]
    for bad in (SourceSpec("s", "e", format="dbf", base_path=path), SourceSpec("s", "e", "carrier_pigeon")):
        with pytest.raises(ValueError):
            read_source(spark, bad)


def test_avro_says_what_is_missing(spark, tmp_path):
    spec = SourceSpec("s", "e", format="avro", base_path=put(tmp_path / "in", "a.avro", b""))
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_source(spark, spec)


def test_records(spark, tmp_path):
    documents = [
        {"users": [{"id": 1, "z": {"b": "1  \" 2", "a": [1, 2]}, "ok": True}, {"id": 2, "z": None, "x": "t"}], "total": 2},
        {"users": [], "total": 0},
        {"message": "no records"},
    ]
    for i, document in enumerate(documents):
        path = put(tmp_path / "in", f"{i}.json", json.dumps(document, indent=1))
    got = read_records(spark, path, "users").select("id", "z", "ok", "x")
    want = [("1", '{"b":"1  \\" 2","a":[1,2]}', "true", None), ("2", None, None, "t")]
    assert rows(got) == want
    lines = put(tmp_path / "lines", "all.json", "\n".join(map(json.dumps, documents)))
    assert rows(read_records(spark, lines, "users", lines=True).select("id", "z", "ok", "x")) == want
    with pytest.raises(ValueError):
        read_records(spark, path, "carts")
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert read_records(spark, path, "carts", schema).count() == 0


def book(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def rich_book():
    """Two sheets; shared and inline strings, gaps, dates, booleans, errors and formulas."""
    sheet = f"""<worksheet {NS}><sheetData>
      <row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>when</t></is></c>
        <c r="D1" t="str"><f>X</f><v>made</v></c></row>
      <row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2" s="1"><v>45292</v></c><c r="C2" t="b"><v>1</v></c>
        <c r="D2"><v>1.5</v></c></row>
      <row r="3"/>
      <row r="4"><c r="B4" s="2"><v>45292.75</v></c><c r="C4" t="e"><v>#DIV/0!</v></c><c r="D4"><v>7</v></c></row>
      <row r="5"><c r="A5" s="3"><v>12</v></c><c r="D5" t="s"><v>2</v></c></row>
    </sheetData></worksheet>"""
    return book(**{
        "xl__workbook_dot_xml": f"""<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">
          <sheets><sheet name="First" sheetId="1" r:id="rId7"/><sheet name="Data" sheetId="2" r:id="rId8"/></sheets></workbook>""",
        "xl___rels__workbook_dot_xml_dot_rels": """<Relationships><Relationship Id="rId7" Target="worksheets/one.xml"/>
          <Relationship Id="rId8" Target="/xl/worksheets/two.xml"/></Relationships>""",
        "xl__worksheets__one_dot_xml": f'<worksheet {NS}><sheetData><row><c><v>1</v></c></row></sheetData></worksheet>',
        "xl__worksheets__two_dot_xml": sheet,
        "xl__sharedStrings_dot_xml": f"<sst {NS}><si><t>name</t></si><si><r><t>Ri</t></r><r><t>ch</t></r></si><si><t></t></si></sst>",
        "xl__styles_dot_xml": f"""<styleSheet {NS}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm hh:mm"/>
          <numFmt numFmtId="165" formatCode="0 &quot;days&quot;;[Red]0"/></numFmts>
          <cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>""",
    })


def test_sheet_rows():
    assert list(sheet_rows(rich_book())) == [["1"]]
    want = [
        ["name", "when", None, "made"],
        ["Rich", "2024-01-01", "True", "1.5"],
        [None, "2024-01-01 18:00:00", None, "7"],
        ["12", None, None, None],
    ]
    assert list(sheet_rows(rich_book(), "Data")) == want
    assert list(sheet_rows(rich_book(), "1")) == want
    with pytest.raises(ValueError, match="Data"):
        list(sheet_rows(rich_book(), "Missing"))


def test_header_names():
    assert header_names(["a", None, "a", "b", "a"]) == ["a", "Unnamed: 1", "a.1", "b", "a.2"]


def test_xlsx_folder(spark, tmp_path):
    path = put(tmp_path / "in", "one.xlsx", workbook(["id", "name"], [(1, "a"), (2, None)]))
    put(tmp_path / "in", "two.xlsx", workbook(["name", "extra"], [("b", 2.5), (None, None)]))
    put(tmp_path / "in", "notes.txt", "not a workbook")
    df = read_xlsx(spark, path)
    assert sorted(df.columns) == ["extra", "id", "name"]
    assert rows(df.select("id", "name", "extra")) == [(None, "b", "2.5"), ("1", "a", None), ("2", None, None)]
    assert read_xlsx(spark, path, columns=["id"]).filter("id is not null").count() == 2
    bare = read_xlsx(spark, path, has_header=False)
    assert bare.columns == ["0", "1"] and bare.count() == 5
    # An empty cell is NULL, so a drop rule on the key sees it.
    assert drop_failing(df, [Expectation("known", "id IS NOT NULL", "drop")]).count() == 2
    with pytest.raises(ValueError):
        read_xlsx(spark, put(tmp_path / "none", "x.txt", ""))


def test_schema_grows_and_conflicts_fail(spark, tmp_path, work):
    spec = SourceSpec("s", "e", base_path=str(tmp_path / "in"), on_type_change="fail")
    put(tmp_path / "in", "1.json", '{"id": 1, "v": 2}\n')
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    put(tmp_path / "in", "2.json", '{"id": 2, "w": {"x": 1}}\n')
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b").select("id", "v", "w.x")
    assert rows(got) == [(1, 2, None), (2, None, 1)]
    put(tmp_path / "in", "3.json", '{"id": "three"}\n')
    with pytest.raises(StreamingQueryException, match="column id was bigint"):
        ingest(spark, spec, f"{work}/b", f"{work}/s")


def test_merge_schemas_order_and_widths():
    s = T.StructType.fromDDL
    assert merge_schemas(s("a double, b string"), s("c int, b bigint, a bigint")) == s("a double, b string, c int")
    with pytest.raises(ValueError):
        merge_schemas(s("a bigint"), s("a double"))
    with pytest.raises(ValueError):
        merge_schemas(s("a double"), s("a bigint"), text_format=False)


def test_merge_schemas_grows_structs():
    s = T.StructType.fromDDL
    held, found = s("a struct<x: bigint>, l array<struct<p: string>>"), s("a struct<y: string>, l array<struct<q: int>>")
    assert merge_schemas(held, found) == s("a struct<x: bigint, y: string>, l array<struct<p: string, q: int>>")


def test_sparse_deliveries_go_on(spark, tmp_path, work):
    spec = SourceSpec("s", "e", base_path=str(tmp_path / "in"))
    texts = ['{"id": 1, "v": 2, "w": {"x": 1}}', '{"id": 2, "v": null, "w": {"x": 2, "y": "b"}}', '{"id": 3, "v": 4}']
    for i, text in enumerate(texts):
        put(tmp_path / "in", f"{i}.json", text + "\n")
        ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b").select("id", "v", "w.x", "w.y")
    assert rows(got) == [(1, 2, 1, None), (2, None, 2, "b"), (3, 4, None, None)]


def test_parquet_columns_of_all_files(spark, work):
    spark.range(2).write.parquet(f"{work}/in/p=1")
    spark.range(2).withColumn("more", F.lit(1)).write.parquet(f"{work}/in/p=2")
    spec = SourceSpec("s", "e", format="parquet", base_path=f"{work}/in")
    assert set(source_schema(spark, spec).names) == {"id", "more", "p"}


def test_discovery(spark, tmp_path):
    root = tmp_path / "land"
    for folder in ("alpha/orders_raw", "alpha/carts_raw", "beta/orders_raw", "gamma/orders_raw", "gamma/other",
                   "_hidden/orders_raw", ".dot/orders_raw"):
        (root / folder).mkdir(parents=True)
    put(root, "loose.txt", "")
    put(root / "alpha", "_metadata.json", '{"format": "xml", "row_tag": "r", "has_header": false}')
    put(root / "beta", "_metadata.json", "{not json")
    found = discover_sources(spark, str(root), ["orders_raw", "carts_raw"])
    got = rows(found.select("source_id", "entity", "format", "row_tag", "has_header", "encoding"))
    assert got == [
        ("volume_alpha", "carts_raw", "xml", "r", False, "UTF-8"),
        ("volume_alpha", "orders_raw", "xml", "r", False, "UTF-8"),
        ("volume_beta", "orders_raw", "json", None, None, "UTF-8"),
        ("volume_gamma", "orders_raw", "json", None, None, "UTF-8"),
    ]
    assert all(fs.is_dir(spark, r.base_path) for r in found.collect())
    assert discover_sources(spark, str(tmp_path / "nothing"), ["orders_raw"]).count() == 0


def new_sources(spark, *names, **columns):
    df = spark.createDataFrame([(n, "volume", "orders_raw") for n in names], "source_id string, source_type string, entity string")
    return df.withColumns({c: F.lit(v) for c, v in columns.items()})


def test_registry_round_trip(spark, work):
    path = f"{work}/registry"
    assert reg.load_registry(spark, path).count() == 0
    first = reg.register_sources(spark, path, new_sources(spark, "a", "b", format="csv", delimiter=";"))
    stamps = {r.source_id: r.registered_at for r in first.collect()}
    second = reg.register_sources(spark, path, new_sources(spark, "b", "c"))
    got = {r.source_id: r for r in second.collect()}
    assert set(got) == {"a", "b", "c"} and got["b"].registered_at == stamps["b"]
    assert (got["b"].format, got["b"].delimiter, got["a"].format) == (None, None, "csv")
    assert got["b"].updated_at > stamps["b"] and all(r.active for r in got.values())
    assert second.columns == reg.REGISTRY_SCHEMA.names


def test_registry_refuses_nulls(spark):
    with pytest.raises(Exception, match="source_type must not be NULL"):
        reg.registrations(new_sources(spark, "a").withColumn("source_type", F.lit(None).cast("string"))).collect()


def test_registry_ddl_is_idempotent(spark, work):
    for _ in range(2):
        reg.create_registry(spark, "control_db.source_registry", f"{work}/registry_table")
    assert spark.table("control_db.source_registry").columns == reg.REGISTRY_SCHEMA.names
    spark.sql("DROP TABLE control_db.source_registry")
    spark.sql("DROP SCHEMA control_db")


def test_unified_entity_of_active_sources(spark, tmp_path):
    json_path = put(tmp_path / "j", "a.json", '{"id": 1, "at": "2026-01-01"}\n')
    csv_path = put(tmp_path / "c", "a.csv", "id,at\n2,2026-01-01\n")
    rows_ = [("volume-j", "volume", "e", "", json_path, True), ("volume-c", "volume", "e", "csv", csv_path, True),
             ("volume-off", "volume", "e", "csv", "/nowhere", False)]
    registry = reg.registrations(spark.createDataFrame(
        rows_, "source_id string, source_type string, entity string, format string, base_path string, active boolean"
    ))
    got = unified_entity(spark, registry, "e").select("id", "at", "_source")
    assert rows(got) == [(1, "2026-01-01", "volume-j"), (2, "2026-01-01", "volume-c")]
    schema = T.StructType([T.StructField("x", T.StringType())])
    assert unified_entity(spark, registry, "none", schema=schema).schema == schema
    with pytest.raises(ValueError):
        unified_entity(spark, registry, "none")


def test_registry_as_a_named_table(spark, tmp_path):
    name = "ddl_test.sources"
    for _ in range(2):
        reg.create_registry(spark, name, str(tmp_path / "t"))
    assert spark.catalog.getTable(name).description == "Registered sources" and spark.table(name).count() == 0
    new = spark.createDataFrame([("a", "e", "volume", "csv")], "source_id string, entity string, source_type string, format string")
    reg.fill_registry(spark, name, new)
    reg.fill_registry(spark, name, new.withColumn("format", F.lit("json")))
    reg.create_registry(spark, name, str(tmp_path / "t"))
    assert [(r.source_id, r.format, r.active) for r in spark.table(name).collect()] == [("a", "json", True)]
    with pytest.raises(Exception, match="source_id must not be NULL"):
        reg.fill_registry(spark, name, new.withColumn("source_id", F.lit(None).cast("string")))
    assert spark.table(name).count() == 1 and spark.table(name).columns == reg.REGISTRY_SCHEMA.names
    spark.sql("DROP TABLE ddl_test.sources")
