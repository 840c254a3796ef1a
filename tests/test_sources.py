"""Landed envelopes: layouts, text rules, paging, parents."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from starlode import sources as src
from starlode.sources.shared import materialize, shared_path
from tests.landed import RECORDS, write_pages

PAGES = [
    {"data": [{"id": 1, "flag": True, "list": [], "tags": ["a"], "nest": {"k": 1}}], "meta": {"hasMore": True}},
    {"data": [{"id": "2", "price": 1.5, "extra": "x"}, {"id": None}], "meta": {"hasMore": False}},
    {"data": [], "meta": {"hasMore": True}},
    {"data": [{"id": 9}]},
]
COLUMNS = ["id", "flag", "list", "tags", "nest", "price"]
EXPECTED = {
    ("1", "true", "[]", '["a"]', '{"k":1}', None),
    ("2", None, None, None, None, "1.5"),
    (None,) * 6,
    ("9", None, None, None, None, None),
}


@pytest.fixture
def lines(tmp_path):
    (tmp_path / "pages.json").write_text("\n".join(json.dumps(p) for p in PAGES))
    return str(tmp_path)


@pytest.fixture
def files(tmp_path):
    for number, page in enumerate(PAGES):
        (tmp_path / f"page_{number}.json").write_text(json.dumps(page, indent=2))
    return str(tmp_path)


def rows(df):
    """Rows as a set; nested values keep the blanks they landed with, which do not matter here."""
    return {
        tuple("".join(v.split()) if isinstance(v, str) else v for v in row) for row in df.collect()
    }


@pytest.mark.parametrize("declared", [True, False])
def test_lines_give_text_columns(spark, lines, declared):
    envelopes = src.read_envelopes(spark, lines, COLUMNS if declared else None)
    assert rows(src.project_records(src.explode_records(envelopes), COLUMNS)) == EXPECTED


@pytest.mark.parametrize("declared", [True, False])
def test_one_envelope_per_file(spark, files, declared):
    envelopes = src.read_envelopes(spark, files, COLUMNS if declared else None, file_per_envelope=True)
    assert rows(src.project_records(src.explode_records(envelopes), COLUMNS)) == EXPECTED


def test_payload_column(spark):
    df = spark.createDataFrame([(7, json.dumps(p)) for p in PAGES], "source int, payload string")
    records = src.explode_records(src.parse_envelopes(df, "payload", COLUMNS), ["source"])
    got = rows(src.project_records(records, COLUMNS, ["source"]))
    assert got == {(*r, 7) for r in EXPECTED}


def test_malformed_page_fails(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"id": 1}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        src.read_envelopes(spark, str(tmp_path), ["id"]).collect()


def test_string_schema():
    schema = src.string_schema({"b": 1, "a": 2})
    assert schema.names == ["b", "a", "DT_HR_CARGA"]
    assert [f.dataType for f in schema] == [T.StringType(), T.StringType(), T.TimestampType()]
    assert all(f.nullable for f in schema)


def test_no_field_is_lost(spark, tmp_path):
    """Five thousand undeclared fields, another spelling of a declared one, and a null record."""
    wide = {f"f{i}": str(i) for i in range(5000)}
    page = {"data": [{"id": "1", "Name": "a", **wide}, None, {"ID": "2", "name": None}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    envelopes = src.read_envelopes(spark, str(tmp_path))
    found = src.all_fields(src.explode_records(envelopes), ["id", "name"]).collect()
    assert [(r.id, r.name) for r in found] == [("1", "a"), ("2", None)]
    assert found[0][src.OTHER] == wide and found[1][src.OTHER] is None


@pytest.mark.parametrize(
    ("pages", "complete"),
    [
        ([PAGES[0]], False),
        ([PAGES[0], PAGES[1]], True),
        ([PAGES[0], PAGES[2]], True),
        ([PAGES[0], PAGES[3]], True),
    ],
)
def test_completeness(spark, tmp_path, pages, complete):
    (tmp_path / "pages.json").write_text("\n".join(json.dumps(p) for p in pages))
    report = src.page_completeness(src.read_envelopes(spark, str(tmp_path), ["id"])).first()
    assert (report["pages"], report["complete"]) == (len(pages), complete)


def test_parent_from_path_and_missing_parents(spark, tmp_path):
    for parent in (40, 41):
        page = {"data": [{"resultId": parent * 10, "evaluationId": "ignored"}]}
        (tmp_path / f"parent_{parent}.json").write_text(json.dumps(page, indent=1))
    envelopes = src.read_envelopes(
        spark, str(tmp_path), ["resultId"], file_per_envelope=True,
        parent="evaluationId", parent_pattern=r"parent_(\d+)\.json$",
    )
    children = src.child_records(envelopes, ["resultId", "evaluationId"], "evaluationId")
    assert rows(children) == {("400", "40"), ("410", "41")}
    parents = spark.createDataFrame([("40",), ("42",), ("42",)], "evaluationId string")
    assert rows(src.missing_parents(parents, children, "evaluationId")) == {("42",)}
    with pytest.raises(ValueError, match="parent"):
        src.read_envelopes(spark, str(tmp_path), ["resultId"], parent_pattern="x")


def test_pages_written_as_files(spark, tmp_path):
    write_pages(tmp_path / "items", RECORDS["items"])
    envelopes = src.read_envelopes(spark, str(tmp_path / "items"), ["itemId"], file_per_envelope=True)
    assert src.explode_records(envelopes).count() == len(RECORDS["items"])
    assert src.page_completeness(envelopes).first()["complete"]


def test_shared_path_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "a"), shared_path(spark, "a")
    assert first.startswith(f"{folder}/starlode/a-") and first != second


def test_a_cluster_must_name_its_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_path(Session(), "a")


def test_materialize_cuts_the_lineage(spark):
    df = spark.range(10).groupBy().sum("id")
    stored = materialize(df, "sum")
    assert stored.schema == df.schema and stored.first()[0] == 45
    assert "Aggregate" not in stored._jdf.queryExecution().executedPlan().toString()
