"""Files in: which ones are opened."""

from __future__ import annotations

from pyspark.sql import functions as F
from saltmarsh.sources import files

TYPES = "date date, close double"


def test_only_the_universes_files_are_opened(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"{k:06d}.csv").write_text(f"date,close\n2025-01-0{k % 9 + 1},{k}\n2025-02-01,x\n")
    (tmp_path / "notes.txt").write_text("date,close\n2025-01-01,9\n")
    universe = spark.createDataFrame([(f"{k:06d}",) for k in (3, 7, 7, 21, 99)], "code string")
    folder = f"file://{tmp_path}"
    rows = files.per_symbol_csv(spark, folder, TYPES, universe)
    assert len(rows.inputFiles()) == 3
    assert sorted((r["symbol"], r["close"]) for r in rows.where("close is not null").collect()) == [("000003", 3.0), ("000007", 7.0), ("000021", 21.0)]
    assert rows.count() == 6
    assert len(files.per_symbol_csv(spark, folder, TYPES).inputFiles()) == 30
    none = files.per_symbol_csv(spark, folder, TYPES, universe.limit(0))
    assert none.count() == 0 and none.columns == rows.columns


def test_csv_files_are_written_by_the_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).selectExpr("lpad(cast(id % 300 as string), 6, '0') AS code", "date_add(DATE'2025-01-01', cast(id % 7 as int)) AS date", "if(id % 5 = 0, null, id / 8) AS close")
    rows = rows.unionByName(rows.limit(1).withColumn("code", F.lit(None).cast("string"))).repartition(7, "code")
    called = []
    kept = files._fs

    class Watched:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            called.append(name)
            return getattr(self.system, name)

    monkeypatch.setattr(files, "_fs", lambda s, path: (lambda system, at: (Watched(system), at))(*kept(s, path)))
    files.csv_files(rows, f"file://{tmp_path}/own", "code")
    assert called.count("rename") == 0 and len(called) < 10  # the driver does nothing for each file
    monkeypatch.setattr(files, "_opened", lambda uri: (_ for _ in ()).throw(OSError(uri)))
    files.csv_files(rows, f"file://{tmp_path}/spark", "code")
    got = [{p.name: sorted(p.read_text().splitlines()) for p in (tmp_path / d).glob("*.csv")} for d in ("own", "spark")]
    assert len(got[0]) == 300 and got[0].items() <= got[1].items() and got[0]["000005.csv"][-1] == "date,close"
    back = files.per_symbol_csv(spark, f"file://{tmp_path}/own", TYPES).selectExpr("symbol AS code", "date", "close")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.where("code is not null").collect()))


def test_a_files_stem(spark, tmp_path):
    for name in ("a.b.csv", "c", "d e+%.csv"):
        (tmp_path / name).write_text("x\n")
    assert sorted(r[0] for r in spark.read.text(f"file://{tmp_path}").select(files.file_stem()).collect()) == ["a.b", "c", "d e+%"]


def test_the_trees_files_grow_in_number_and_not_in_size(spark, tmp_path, monkeypatch):
    from saltmarsh.plans import filing

    from .conftest import SMALL

    size = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    most = []
    for part in (16, 64):
        monkeypatch.setattr(filing, "FILE_BYTES", size // part, raising=False)
        found = files.tree(spark, filing.text_tree(spark, SMALL), ("txt", "json"))
        assert found.where("length(text) > 0").count() >= part * 2 // 3
        most.append(found.selectExpr("max(size)").first()[0])
    assert most[1] < most[0]


def test_json_lines_are_written_and_numbered_by_many_tasks(spark, tmp_path):
    from saltmarsh.plans import filing

    from .conftest import SMALL

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    for k in range(5):  # enough for more than one range
        events.repartition(4).write.mode("append").parquet(f"file://{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = filing.json_lines(spark, f"file://{tmp_path}")
        assert len(spark.read.text(folder).inputFiles()) > 1
        bad = filing.QUERIES["s4_jsonl_errors"](spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ids = sorted(r["event_id"] for r in spark.read.parquet(f"file://{tmp_path}/events.parquet").collect())
    assert sorted(r["line_no"] for r in bad) == [i + 1 for i, k in enumerate(ids) if k % 50 in (7, 8)]
