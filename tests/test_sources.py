import datetime as dt
import json

import pytest

from tablesnap import FileSource, FrameSource, JdbcSource, JsonRowsSource, PagedSource, RemoteColumn
from tablesnap.sources.jdbc import select_sql

FIELDS = [
    {"name": "id", "jsonType": "int"},
    {"name": "Modified", "jsonType": "dateTime"},
    {"name": "secret", "jsonType": "string", "hidden": True},
    {"name": "_link_id", "jsonType": "string"},
    {"name": "label"},
]


def test_projection_sql():
    sql = select_sql("lists", 'odd"table', ["RowId", "Display Name", 'weird"column'])
    assert sql == 'SELECT "RowId", "Display Name", "weird""column" FROM "lists"."odd""table"'


def test_jdbc_sends_the_projection_along(spark):
    """No database may be started here, so a stand-in takes what would go to Spark's JDBC reader."""
    asked = []

    class Recorded(JdbcSource):
        def _load_sql(self, dbtable, options):
            asked.append((dbtable, options))
            return spark.sql("SELECT 1 AS Id, 'x' AS Secret, TIMESTAMP_NTZ '2024-01-01' AS Modified, 'n' AS Name")

    split = {"partitionColumn": "Id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    source = Recorded(spark, "lists", "People", {"url": "jdbc:none:", **split}, hidden=["Id", "Secret"])
    fetch = source.fetch()
    assert fetch.rows.columns == ["Modified", "Name"] and fetch.tracked == "Modified"
    assert [table for table, _ in asked] == [
        '"lists"."People"',
        '(SELECT "Modified", "Name", "Id" FROM "lists"."People") t',
    ]
    assert asked[1][1] == {"url": "jdbc:none:", **split}
    asked.clear()
    assert source.probe().first().server_modified == "2024-01-01 00:00:00"
    assert asked[-1] == ('(SELECT MAX("Modified") AS "Modified" FROM "lists"."People") t', {"url": "jdbc:none:"})


def test_captured_rows_and_metadata(spark, new_store, tmp_path):
    (tmp_path / "rows").mkdir()
    rows = ['[1,"2024-01-15T09:30:00.000Z","a"]', '["2","1/16/2024",5]', '[3,null,{"b":1,"a":2}]']
    (tmp_path / "rows" / "page1.txt").write_text("\n".join(rows[:2]) + "\n")
    (tmp_path / "rows" / "page2.txt").write_text(rows[2] + "\n")
    (tmp_path / "fields.json").write_text(json.dumps({"schemaName": "lists", "fields": FIELDS}, indent=1))
    source = JsonRowsSource(spark, str(tmp_path / "rows"), str(tmp_path / "fields.json"), internal_prefix="_link_")
    store = new_store().attach("lists", "T", source)
    df = store.query("lists", "T")
    assert df.dtypes == [("id", "bigint"), ("Modified", "timestamp_ntz"), ("label", "string")]
    assert sorted(map(tuple, df.collect())) == [
        (1, dt.datetime(2024, 1, 15, 9, 30), "a"),
        (2, dt.datetime(2024, 1, 16), "5"),
        (3, None, '{"a":2,"b":1}'),
    ]
    assert store.cache_info().first().server_modified == "2024-01-16 00:00:00"
    (tmp_path / "rows" / "page3.txt").write_text('[4,"2024-02-01",null]\n')
    assert store.query("lists", "T").count() == 4


def test_missing_metadata_is_an_error(spark, tmp_path):
    (tmp_path / "fields.json").write_text('{"exception": "no such query"}')
    with pytest.raises(ValueError, match="No column metadata"):
        JsonRowsSource(spark, "unused", str(tmp_path / "fields.json")).columns()


def make_transport(state):
    class Transport:
        def __init__(self):
            self.state = state

        def fields(self):
            return FIELDS

        def pages(self, columns):
            return [(i * 10, i * 10 + 10) for i in range(self.state["pages"])]

        def fetch(self, page, columns):
            cells = {"id": lambda i: str(i), "Modified": lambda i: "2024-01-01", "label": lambda i: [i, 0.5], "_link_id": str}
            return [[cells[c](i) for c in columns] for i in range(*page)]

        def max_modified(self):
            return self.state["modified"]

    return Transport()


@pytest.mark.parametrize("per_task", [1, 3, 100])
def test_pages(spark, new_store, per_task):
    state = {"pages": 7, "modified": "v1"}
    source = PagedSource(spark, make_transport(state), pages_per_task=per_task, internal_prefix="_link_")
    store = new_store().attach("lists", "T", source)
    df = store.query("lists", "T")
    assert df.columns == ["id", "Modified", "label"]
    assert sorted(r.id for r in df.collect()) == list(range(70))
    assert {r.label for r in df.where("id = 3").collect()} == {"[3,0.5]"}
    assert source.lines(source.visible_columns()).rdd.getNumPartitions() == -(-7 // per_task)
    assert store.cache_info().first().server_modified == "v1"
    state["pages"] = 8
    assert store.query("lists", "T").count() == 70  # the server still reports v1
    state["modified"] = "v2"
    assert store.query("lists", "T").count() == 80


def test_no_pages(spark, new_store):
    source = PagedSource(spark, make_transport({"pages": 0, "modified": None}))
    df = new_store().attach("lists", "T", source).query("lists", "T")
    assert df.count() == 0 and "label" in df.columns


def test_nested_and_narrow_types(spark, new_store):
    def load():
        return spark.sql(
            "SELECT CAST(1 AS SMALLINT) AS a, CAST(2.50 AS DECIMAL(9,2)) AS b, array(1.5D, NULL, 1e-7D) AS c, "
            "named_struct('z', 1, 'y', 'q') AS d, CAST(NULL AS array<int>) AS e, CAST(1.5 AS FLOAT) AS f"
        )

    row = new_store().attach("s", "T", FrameSource(load)).query("s", "T").first()
    assert tuple(row) == (1, 2.5, "[1.5,null,1e-7]", '{"y":"q","z":1}', None, 1.5)


def test_files(spark, new_store, tmp_path):
    schema = "id bigint, day date, note string"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 'a,"b"'), (2, None, None)], schema)
    store = new_store()
    for format in ("csv", "json", "parquet", "orc"):
        df.write.format(format).save(str(tmp_path / format))
        store.attach("files", format, FileSource(spark, str(tmp_path / format), format, schema))
        assert sorted(map(tuple, store.query("files", format).collect())) == sorted(map(tuple, df.collect()))


def test_change_column_is_found_in_any_case(spark):
    source = FrameSource(lambda: spark.sql("SELECT 1 AS id, 'v7' AS MODIFIED"))
    assert source.probe().first().server_modified == "v7"
    assert source.tracked([RemoteColumn("id", "int"), RemoteColumn("MODIFIED", "string")]) == "MODIFIED"
    assert FrameSource(lambda: spark.range(1)).probe() is None


class Numbered:
    """A server with a million numbered pages, some of which are fetched here."""

    def __init__(self, pages, kind):
        self.count, self.kind = pages, kind

    def fields(self):
        return [{"name": "n", "jsonType": "int"}, {"name": "text", "jsonType": "string"}]

    def pages(self, columns):
        return range(self.count)

    def fetch(self, page, columns):
        import pyarrow as pa

        texts = [f'[{page * 3 + i}, "p{page}"]' for i in range(3)]
        if self.kind == "array":
            return [pa.array(texts)]
        if self.kind == "chunked":
            return [pa.chunked_array([texts[:1], [], texts[1:]], pa.large_string())]
        return [texts[0], pa.array(texts[1:2]), [page * 3 + 2, f"p{page}"]]

    def max_modified(self):
        return None


def test_a_million_pages_are_planned_at_once(spark):
    import pickle
    import time

    from tablesnap.sources.paged import _PageReader

    start = time.perf_counter()
    parts = _PageReader(Numbered(1_000_000, "array"), ["n", "text"], 0, 128).partitions()
    assert time.perf_counter() - start < 1 and len(parts) == 128
    assert sum(len(p.pages) for p in parts) == 1_000_000 and len(pickle.dumps(parts)) < 100_000


@pytest.mark.parametrize("kind", ["array", "chunked", "mixed"])
def test_pages_of_arrow_texts(spark, kind):
    source = PagedSource(spark, Numbered(50, kind), pages_per_task=7)
    rows = sorted(map(tuple, source.read(source.columns()).collect()))
    assert rows == [(n, f"p{n // 3}") for n in range(150)]
