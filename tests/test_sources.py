import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from agora import session
from agora.sources import assets, pages, tables
from agora.streaming.ingest import ingest_pages_stream
from tests.conftest import rows


def test_csv_missing_values_quotes_and_float_ids(spark, tmp_path):
    (tmp_path / "q.csv").write_text('question_id,title,score,user_id\n1,"a ""b""\nc",NA,12.0\n2,None,nan,\n3,x,1.5,abc\n')
    schema = "question_id bigint, title string, score double, user_id bigint"
    found = tables.read_table(spark, str(tmp_path / "q.csv"), schema)
    assert rows(found) == [(1, 'a "b"\nc', None, 12), (2, None, None, None), (3, "x", 1.5, None)]


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you'), (2, None)], "k bigint, t string")
    for _ in range(2):
        tables.write_table(df, str(tmp_path / "out"), "csv")
    assert rows(tables.read_table(spark, str(tmp_path / "out"), "k bigint, t string")) == rows(df)


def test_parquet_nan_becomes_null(spark, tmp_path):
    tables.write_table(spark.createDataFrame([(1, float("nan"))], "k bigint, v double"), str(tmp_path / "p"))
    assert rows(tables.read_table(spark, str(tmp_path / "p"), "k bigint, v double", "parquet")) == [(1, None)]


PAGES = [
    {"items": [{"question_id": 1, "score": 2, "tags": ["a"]}], "has_more": True},
    {"items": [{"question_id": 2, "score": 3, "owner": {"user_id": 5}}, {"question_id": 3, "owner": {"user_id": 6, "reputation": 9, "display_name": "n"}}]},
    {"items": [], "has_more": False},
]


def test_stream_equals_batch_and_takes_files_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.json").write_text(json.dumps(PAGES[0]))
    (landing / "2.json").write_text(json.dumps(PAGES[1]))
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")

    def run():
        ingest_pages_stream(spark, str(landing), out, offsets, "questions", files_per_batch=1).awaitTermination()
        return rows(spark.read.parquet(out))

    def batch():
        return rows(pages.flatten_questions(pages.read_pages(spark, str(landing), "questions")))

    want = sorted(
        [(1, ["a"], 2.0, None, None, None, None), (2, None, 3.0, 5, 0, None, None), (3, None, None, 6, 9, "n", None)], key=repr
    )
    assert run() == batch() == want
    (landing / "3.json").write_text(json.dumps(PAGES[2]))
    (landing / "4.json").write_text(json.dumps({"items": [{"question_id": 4}]}))
    assert run() == batch()
    assert run() == batch()


def test_user_pages_badges(spark, tmp_path):
    (tmp_path / "u.json").write_text(
        json.dumps({"items": [{"user_id": 1, "display_name": "a", "badge_counts": {"gold": 2}}, {"user_id": 2, "reputation": 4}]})
    )
    found = pages.flatten_users(pages.read_pages(spark, str(tmp_path), "users"))
    assert rows(found) == [(1, "a", None, 2, 0, 0), (2, None, 4, 0, 0, 0)]


def test_asset_discovery(spark, tmp_path):
    for name in ("a/x.csv", "b/x.CSV", "b/y.Csv", "b/z.txt"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("1")
    found = assets.discover_assets(spark, str(tmp_path), ".csv")
    assert "content" not in found.columns
    targets = {r.name: (r.path.rsplit("/", 2)[1], r.copies) for r in assets.asset_targets(found).collect()}
    assert targets == {"x.csv": ("a", 1), "x.CSV": ("b", 1), "y.Csv": ("b", 1)}


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.checkpoint_dir(spark).startswith("file:" + spark.conf.get("spark.checkpoint.dir"))
    stored = session.materialize(spark.range(5).withColumn("p", F.col("id") % 2), "t", ["p"])
    assert stored.columns == ["id", "p"] and stored.count() == 5
    assert all(f.startswith("file:") and "/tables/t-" in f for f in stored.inputFiles())


def test_scope_removes_its_tables(spark):
    with session.scratch_scope(spark) as folder:
        inside = session.materialize(spark.range(3), "gone")
        assert inside.count() == 3 and folder.removeprefix("file:") in inside.inputFiles()[0]
    assert not Path(folder.removeprefix("file:")).exists()
    assert "/scope-" not in session.scratch_path(spark, "later")


def test_remote_master_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def kinds(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_types_move_up_the_lattice(spark, tmp_path):
    text = "i,d,b,t,none,mixed,late,big,letter\n1,1.5,True,a,,1,1,9,1d\n-2,NA,false,,nan,true,2.5,99999999999999999999,2\n,3e4,,b,None,,3,1,3\n"
    (tmp_path / "t.csv").write_text(text)
    want = [("i", "bigint"), ("d", "double"), ("b", "boolean"), ("t", "string"), ("none", "double"), ("mixed", "string"), ("late", "double")]
    assert kinds(tables.infer_types(spark, str(tmp_path / "t.csv"))) == [*want, ("big", "double"), ("letter", "string")]
    found = [tuple(r) for r in tables.read_table(spark, str(tmp_path / "t.csv")).collect()]
    assert found == [
        (1, 1.5, True, "a", None, "1", 1.0, 9.0, "1d"), (-2, None, False, None, None, "true", 2.5, 1e20, "2"), (None, 3e4, None, "b", None, None, 3.0, 1.0, "3"),
    ]


def test_the_last_row_counts_for_a_type(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n" + "1\n" * 5000 + "x\n")
    assert kinds(tables.infer_types(spark, str(tmp_path))) == [("v", "string")]
    (tmp_path / "a.csv").write_text("v,w.x\n")
    assert kinds(tables.infer_types(spark, str(tmp_path))) == [("v", "double"), ("w.x", "double")]
    assert tables.read_table(spark, str(tmp_path)).collect() == []


def test_quoted_breaks_choose_how_files_are_read(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('k,t\n1,"a, ""b"""\n2,c\n')
    (tmp_path / "broken.csv").write_text('k,t\n1,"a\nb"\n2,c\n')
    assert not tables.has_quoted_breaks(spark, str(tmp_path / "plain.csv")) and tables.has_quoted_breaks(spark, str(tmp_path / "broken.csv"))
    assert rows(tables.read_table(spark, str(tmp_path / "broken.csv"))) == [(1, "a\nb"), (2, "c")]
    found = tables.read_table(spark, str(tmp_path / "plain.csv"))
    assert rows(found) == [(1, 'a, "b"'), (2, "c")]
    assert found.inputFiles() and "multiLine" not in found._jdf.queryExecution().executedPlan().toString()


def test_inferred_parquet_keeps_its_types(spark, tmp_path):
    spark.createDataFrame([(1, float("nan"), "x")], "k int, v double, t string").write.parquet(str(tmp_path / "p"))
    assert rows(tables.read_table(spark, str(tmp_path / "p"), fmt="parquet")) == [(1, None, "x")]
