"""Output folders: line numbers across part files, merging without a shuffle, replacing both reports together, dump cache."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, write_text
from qalens import job
from qalens.functions.order import name_key, sorted_names
from qalens.operators.sort import sort_by_count
from qalens.sinks import files, text as sink
from qalens.sources import ingest_views
from qalens.sources.text import first_line, numbered_lines, scan_lines, strip_header
from test_fixture import ANSWERS, QUESTIONS, TAGS, read_parts


@pytest.fixture()
def dump(tmp_path):
    return (write_text(tmp_path / "Questions.csv", QUESTIONS), write_text(tmp_path / "Answers.csv", ANSWERS),
            write_text(tmp_path / "Tags.csv", TAGS))


@pytest.fixture()
def small_splits(spark):
    """Small outputs in several part files, read in several blocks."""
    new = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def ranked(spark, n, partitions):
    return sort_by_count(spark.range(n).select(F.format_string("t%05d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("tag"), (F.col("id") % 13).alias("n"))
                         .repartition(partitions), "n", "tag")


@pytest.mark.parametrize("single_file", [False, True])
def test_lines_are_numbered_across_part_files_and_blocks(spark, tmp_path, small_splits, single_file):
    path = str(tmp_path / "top")
    report = ranked(spark, 1500, 5)
    sink.write_top_tags(report, path, single_file)
    assert (len([n for n in os.listdir(path) if n.startswith("part-")]) == 1) == single_file
    lines = numbered_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 4
    expected = [(i, f"({r.tag},{r.n})") for i, r in enumerate(report.collect(), 1)]
    assert [tuple(r) for r in lines.orderBy("line_no").collect()] == expected


def test_numbering_holds_no_line_in_the_window(spark, tmp_path):
    path = str(tmp_path / "top")
    sink.write_top_tags(ranked(spark, 300, 4), path)
    plan = numbered_lines(spark, path)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "ReadSchema: struct<>" in below  # one row a block: the lines themselves aren't read for the prefix sum


def test_names_sort_by_their_numbers(spark):
    names = ["part-10", "part-2", "part-00001-a", "part-100000-b", "part-99999-b", "x", "part-2-b", "part-02"]
    expected = ["part-00001-a", "part-02", "part-2", "part-2-b", "part-10", "part-99999-b", "part-100000-b", "x"]
    assert sorted_names(names) == expected
    frame = spark.createDataFrame([(n,) for n in names], "name string").orderBy(name_key(F.col("name")), "name")
    assert [r.name for r in frame.collect()] == expected


def test_header_of_a_folder_is_that_of_the_part_with_the_least_number(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "part-1").write_text("")
    write_text(folder / "part-2", ["Id,Tag", "1,a"])
    write_text(folder / "part-10", ["2,b", "3,c"])
    assert first_line(spark, str(folder)) == "Id,Tag"
    kept = strip_header(scan_lines(spark, str(folder)), path=str(folder))
    assert sorted(r.value for r in kept.collect()) == ["1,a", "2,b", "3,c"]


def test_merging_keeps_the_bytes_of_all_parts_in_order(spark, tmp_path):
    folder = tmp_path / "out"
    folder.mkdir()
    for n in (10, 2, 1):
        (folder / f"part-{n}").write_bytes(f"é{n}\n".encode() * 3)
    (folder / "_SUCCESS").write_text("")
    assert files.merge_parts(spark, str(folder)).endswith("part-00000")
    assert (folder / "part-00000").read_bytes() == b"".join(f"é{n}\n".encode() * 3 for n in (1, 2, 10))
    assert [n for n in os.listdir(folder) if not n.startswith(("_", "."))] == ["part-00000"]
    empty = tmp_path / "none"
    empty.mkdir()
    files.merge_parts(spark, str(empty))
    assert (empty / "part-00000").read_bytes() == b""


def test_a_merged_report_is_not_shuffled_into_one_task(spark, tmp_path, small_splits, monkeypatch):
    plans = []
    merged = sink.merge_parts
    monkeypatch.setattr(sink, "merge_parts", lambda spark, folder: plans.append(len(files.part_files(spark, folder))) or merged(spark, folder))
    sink.write_top_tags(ranked(spark, 20_000, 6), str(tmp_path / "one"), single_file=True)
    assert plans and plans[0] > 1  # several tasks had written it


def snapshot(folder):
    return {name: read_parts(os.path.join(folder, name)) for name in sorted(os.listdir(folder))}


@pytest.mark.parametrize("failing", ["mean_time_answer", "top_tags"])
def test_a_run_that_fails_leaves_the_old_pair(spark, dump, tmp_path, failing, monkeypatch):
    out = str(tmp_path / "out")
    job.run(spark, *dump, out)
    old = snapshot(out)
    assert sorted(old) == ["mean_time_answer", "top_tags"]
    lines = {"mean_time_answer": "mean_time_lines", "top_tags": "count_lines"}[failing]
    monkeypatch.setattr(job, lines, lambda report: report.select(F.raise_error(F.lit("broken report")).cast("string").alias("value")))
    with pytest.raises(Exception, match="broken report"):
        job.run(spark, *dump, out, threshold=1)
    assert snapshot(out) == old
    monkeypatch.undo()
    job.run(spark, *dump, out, threshold=5)
    new = snapshot(out)
    assert sorted(new) == sorted(old) and new["mean_time_answer"] != old["mean_time_answer"]


@pytest.mark.parametrize("at", range(4))
def test_a_move_that_fails_is_undone(spark, tmp_path, at, monkeypatch):
    for name in ("a", "b"):
        for kind in ("old", "new"):
            (tmp_path / kind / name).mkdir(parents=True)
            (tmp_path / kind / name / "part-0").write_text(f"{kind} {name}")
    calls, move = [], files.move

    def breaking(spark, source, target):
        calls.append(source)
        if len(calls) == at + 1:
            raise OSError("no space")
        move(spark, source, target)

    monkeypatch.setattr(files, "move", breaking)
    with pytest.raises(OSError, match="no space"):
        files.replace_together(spark, {str(tmp_path / "new" / n): str(tmp_path / "old" / n) for n in ("a", "b")})
    assert sorted(os.listdir(tmp_path / "old")) == ["a", "b"]
    for name in ("a", "b"):
        assert (tmp_path / "old" / name / "part-0").read_text() == f"old {name}"
        assert (tmp_path / "new" / name / "part-0").read_text() == f"new {name}"


def test_reports_without_old_output_and_other_files_beside(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("mine")
    sink.write_reports({str(tmp_path / "r"): spark.createDataFrame([("x",)], "value string"), str(tmp_path / "s"): spark.createDataFrame([], "value string")}, True)
    assert sorted(os.listdir(tmp_path)) == ["notes.txt", "r", "s"]
    assert read_parts(tmp_path / "r") == ["x"] and read_parts(tmp_path / "s") == []


def test_dumps_follow_their_tables(spark, tmp_path):
    folder = tmp_path / "tables"
    folder.mkdir()
    for name in ("orders", "lineitem", "part", "documents", "events"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", folder / f"{name}.parquet")  # not the mode: the tables may be read-only
    query = ingest_views.queries()["ingest_tags"]
    before = query(spark, str(folder))
    paths = ingest_views.order_dumps(spark, str(folder))
    assert ingest_views.order_dumps(spark, str(folder)) == paths  # the same files: read again
    n = before.count()
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(100).toPandas()
    half.to_parquet(folder / "lineitem.parquet", coerce_timestamps="us")
    (folder / ".lineitem.parquet.crc").unlink(missing_ok=True)
    changed = ingest_views.order_dumps(spark, str(folder))
    assert changed[0] == paths[0] and changed[1] != paths[1] and changed[2] != paths[2]
    assert query(spark, str(folder)).count() == 100 < n


def own_tables(spark, folder, n):
    """Tables of the orders view with ``n`` line items, one a minute, and documents that are noise lines."""
    ts = "CAST(timestamp'2021-01-01' + make_interval(0, 0, 0, 0, 0, id) AS TIMESTAMP_NTZ)"
    rows = spark.range(n)
    for name, columns in {
            "orders": ["id AS o_orderkey", f"{ts} AS o_orderdate"], "part": ["id AS p_partkey", "'b' AS p_brand"], "documents": ["concat('a,b\\n', id) AS text"],
            "lineitem": ["id AS l_orderkey", "id AS l_partkey", "1 AS l_linenumber", "2.5D AS l_quantity", f"{ts} AS l_shipdate",
                         "if(id % 2 = 0, 'O', 'F') AS l_linestatus", "if(id % 3 = 0, 'R', if(id % 3 = 1, 'A', 'N')) AS l_returnflag"]}.items():
        rows.selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name, rows", [("answers", 66), ("tags", 100)])
def test_ingest_writes_only_its_own_dump(spark, tmp_path, name, rows):
    folder = own_tables(spark, tmp_path, 100)
    assert ingest_views.queries()[f"ingest_{name}"](spark, folder).count() == rows
    assert {key[2] for key in ingest_views._WRITTEN if key[1] == folder} == {name}


def test_dumps_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest_views, "LINES_PER_FILE", 20)
    folder = own_tables(spark, tmp_path, 100)
    path = ingest_views.order_answers_dump(spark, folder)
    parts = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert parts and all(f.endswith(".gz") for f in parts)
    sizes = [spark.read.text(os.path.join(path, f)).count() for f in parts]
    assert max(sizes) <= 20 and sum(sizes) == 1 + 100 + 200
    lines = ingest_views.lineitem_answer_lines(spark, folder)
    assert sorted(spark.read.text(path).collect()) == sorted(lines.collect())
    assert ingest_views.strip_header(spark.read.text(path), path=path).count() == 300
