"""Hand-worked dump fixture, end to end from text files to text reports; fail-fast tag parsing."""

import os

import pytest

from conftest import write_text
from qalens.job import run
from qalens.model import QAData
from qalens.plans.reports import mean_time_answer, top_tags
from qalens.sources.ingest import parse_questions, parse_tags, read_dump

QUESTIONS = [
    "Id,OwnerUserId,CreationDate,ClosedDate,Score,Title,Body",
    '1,NA,2021-01-01T00:00:00Z,NA,1,t,"first',
    "second, with comma",
    '"',
    "2,7,2021-01-01T00:00:00Z,NA,1,t,b",
    "3,7,2021-01-01T00:00:00Z,NA,1,t,b",
    "4,7,2021-01-01T00:00:00Z,NA,1,t,b",
    "5,7,2021-01-01T00:00:00,NA,1,t,b",
    "6,7,2021-01-01T00:00:00Z,NA,1,t,b",
    "7,7,2021-01-01T00:00:00Z,NA,1,t,b",
    "8,7,2021-01-01T00:00Z,NA,1,t,b",
]
ANSWERS = [
    "Id,OwnerUserId,CreationDate,ParentId,Score,Body",
    "10,1,2021-01-01T00:10:59Z,1,5,x",
    "11,1,2021-01-01T03:00:00+03:00,2,0,x",
    "12,1,2021-01-02T00:00:00Z,6,0,x",
    "13,1,2020-12-31T23:59:30Z,7,1,x",
    "14,1,2021-01-01T00:01:00Z,1,NA,x",
    "15,1,2021-01-01T05:00:00Z,4,1,x",
    "16,1,2021-01-01T01:00:00Z,1,2,x",
    "17,1,2021-01-01T23:59:59Z,8,0,x",
    "18,1,2021-01-01T00:05:00Z,5,0,x",
]
TAGS = ["Id,Tag", "1,java", "1,spark", "2,java", "3,java", "5,java", "6,spark", "6,slow", "7,java", "7,java",
        "8,edge", "99,orphan"]


@pytest.fixture()
def dump(tmp_path):
    return (write_text(tmp_path / "Questions.csv", QUESTIONS), write_text(tmp_path / "Answers.csv", ANSWERS),
            write_text(tmp_path / "Tags.csv", TAGS))


def read_parts(path):
    lines = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as f:
                lines.extend(f.read().splitlines())
    return lines


def test_ingest_drops_malformed_questions_and_answers(spark, dump):
    data = read_dump(spark, *dump)
    assert sorted(r.id for r in data.questions.collect()) == [1, 2, 3, 4, 6, 7, 8]
    # answer 14 (score NA) and nothing else is dropped at ingest; answer 18 goes later with question 5
    assert data.answers.count() == 8


def test_reports_match_hand_worked_values(spark, dump):
    data = read_dump(spark, *dump)
    mean = {r.tag: (r.mean_minutes, r.probability) for r in mean_time_answer(data).collect()}
    assert mean == {"edge": (1439, 1.0), "java": (2, 1.0), "spark": (10, 0.5)}
    assert [(r.tag, r.n) for r in top_tags(data).collect()] == [("java", 4), ("spark", 2), ("edge", 1), ("slow", 1)]


def test_job_writes_text_reports_and_overwrites(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run replaces the first
        mean_path, top_path = run(spark, *dump, out)
    assert sorted(read_parts(mean_path)) == ["(edge,(1439,1.0))", "(java,(2,1.0))", "(spark,(10,0.5))"]
    assert read_parts(top_path) == ["(java,4)", "(spark,2)", "(edge,1)", "(slow,1)"]


def test_job_single_file(spark, dump, tmp_path):
    _, top_path = run(spark, *dump, str(tmp_path / "one"), single_file=True)
    parts = [n for n in os.listdir(top_path) if n.startswith("part-")]
    assert len(parts) == 1
    assert read_parts(top_path) == ["(java,4)", "(spark,2)", "(edge,1)", "(slow,1)"]


def test_job_cli_usage_error():
    from qalens.job import main
    with pytest.raises(SystemExit) as err:
        main([])
    assert err.value.code != 0


def test_duplicate_question_ids_weight_tags(spark):
    q = spark.createDataFrame([(1, "2021-01-01T00:00:00Z"), (1, "2021-01-01T00:00:00Z"), (2, "2021-01-01T00:00:00Z")],
                              "id int, ts string").selectExpr("id", "cast(ts as timestamp) as creation_ts")
    a = spark.createDataFrame([(1, "2021-01-01T00:05:00Z", 1), (2, "2021-01-01T00:07:00Z", 1)],
                              "question_id int, ts string, score int") \
        .selectExpr("question_id", "cast(ts as timestamp) as creation_ts", "score")
    t = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a"), (3, "z")], "question_id int, tag string")
    data = QAData.keyed_by_question(q, a, t)
    assert [(r.tag, r.n) for r in top_tags(data).collect()] == [("a", 5), ("b", 2)]


@pytest.mark.parametrize("bad", ["x,y", "5", "5,", "", ",,,", " 5,x"])
def test_bad_tag_line_fails_the_job(spark, tmp_path, bad):
    path = write_text(tmp_path / "tags.csv", ["Id,Tag", "1,ok", bad])
    from qalens.sources.text import scan_lines, strip_header
    tags = parse_tags(strip_header(scan_lines(spark, path), "Id,Tag"))
    for column in ("question_id", "tag"):  # the check survives pruning to either column
        with pytest.raises(Exception, match="malformed tag line"):
            tags.select(column).collect()


def test_tag_line_with_empty_name_and_extra_fields(spark, tmp_path):
    path = write_text(tmp_path / "tags.csv", ["Id,Tag", "5,,x", "6,java,extra,,", "+7,go,"])
    from qalens.sources.text import scan_lines, strip_header
    rows = parse_tags(strip_header(scan_lines(spark, path))).collect()
    assert sorted((r.question_id, r.tag) for r in rows) == [(5, ""), (6, "java"), (7, "go")]


def test_strict_question_parsing(spark, tmp_path):
    lines = ["h", "1,x,2021-01-01T00:00:00Z", " 2,x,2021-01-01T00:00:00Z", "3,x,2021-01-01", "4,x,2021-01-01T00:00:00",
             "5,x,2021-01-01T00:00:00.123456789+01:00", "6,x,2021-01-01T00:00-05:30", "99999999999,x,2021-01-01T00:00Z",
             "8,x,2021-02-30T00:00:00Z", "9,x", "10,x,2021-01-01T00:00:00z"]
    from qalens.sources.text import scan_lines, strip_header
    rows = parse_questions(strip_header(scan_lines(spark, write_text(tmp_path / "q.csv", lines)))) \
        .selectExpr("id", "unix_micros(creation_ts) AS us").collect()
    got = {r.id: r.us for r in rows}
    assert set(got) == {1, 5, 6, 10}
    assert got[5] == 1609455600123456  # 2020-12-31T23:00:00.123456Z
    assert got[6] == 1609479000000000  # 2021-01-01T05:30:00Z


def test_command_line_job_in_its_own_process(dump, tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = str(tmp_path / "cli")
    env = dict(os.environ, PYTHONPATH=root, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false "
               f"--conf spark.checkpoint.dir={tmp_path / 'ck'} pyspark-shell")
    q, a, t = dump
    done = subprocess.run([sys.executable, "-m", "qalens.job", out, "--questions", q, "--answers", a, "--tags", t,
                           "--single-file"], env=env, cwd=root, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert read_parts(os.path.join(out, "top_tags")) == ["(java,4)", "(spark,2)", "(edge,1)", "(slow,1)"]
    assert sorted(read_parts(os.path.join(out, "mean_time_answer"))) == \
        ["(edge,(1439,1.0))", "(java,(2,1.0))", "(spark,(10,0.5))"]


def test_empty_dumps_give_empty_reports(spark, tmp_path):
    paths = []
    for name in ("q.csv", "a.csv", "t.csv"):
        (tmp_path / name).write_text("", encoding="utf-8")
        paths.append(str(tmp_path / name))
    mean_path, top_path = run(spark, *paths, str(tmp_path / "out"))
    assert read_parts(mean_path) == [] and read_parts(top_path) == []


def test_header_only_dumps_give_empty_reports(spark, tmp_path):
    paths = [write_text(tmp_path / "q.csv", QUESTIONS[:1]), write_text(tmp_path / "a.csv", ANSWERS[:1]),
             write_text(tmp_path / "t.csv", TAGS[:1])]
    mean_path, top_path = run(spark, *paths, str(tmp_path / "out"))
    assert read_parts(mean_path) == [] and read_parts(top_path) == []


def test_job_removes_its_scratch_tables(spark, dump, tmp_path):
    from qalens.session import shared_dir
    root = shared_dir(spark)
    local = root[len("file:"):] if root.startswith("file:") else root
    before = set(os.listdir(local))
    run(spark, *dump, str(tmp_path / "out"))
    assert not [n for n in set(os.listdir(local)) - before if n.startswith("run-")]


def test_header_removed_by_value_in_every_file_of_a_directory(spark, tmp_path):
    folder = tmp_path / "questions"
    folder.mkdir()
    write_text(folder / "part-1.csv", QUESTIONS[:5])
    write_text(folder / "part-2.csv", [QUESTIONS[0]] + QUESTIONS[5:])
    from qalens.sources.text import scan_lines, strip_header
    lines = strip_header(scan_lines(spark, str(folder)), QUESTIONS[0])
    assert lines.where(f"value = '{QUESTIONS[0]}'").count() == 0
    assert lines.count() == len(QUESTIONS) - 1
    assert sorted(r.id for r in parse_questions(lines).collect()) == [1, 2, 3, 4, 6, 7, 8]


@pytest.mark.parametrize("layout", ["first part only", "every part", "an empty part beside it"])
def test_header_of_a_directory_is_found(spark, tmp_path, layout):
    folder = tmp_path / "many"
    folder.mkdir()
    if layout == "an empty part beside it":
        (folder / "a.csv").write_text("")
        write_text(folder / "b.csv", QUESTIONS)
    else:
        write_text(folder / "a.csv", QUESTIONS[:3])
        write_text(folder / "b.csv", ([QUESTIONS[0]] if layout == "every part" else []) + QUESTIONS[3:])
    from qalens.sources.text import scan_lines, strip_header
    lines = strip_header(scan_lines(spark, str(folder)), path=str(folder))
    assert sorted(r[0] for r in lines.collect()) == sorted(QUESTIONS[1:])


def test_header_of_empty_input(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    from qalens.sources.text import scan_lines, strip_header
    path = str(tmp_path / "empty.csv")
    assert strip_header(scan_lines(spark, path), path=path).count() == 0


def test_single_file_is_in_order_above_a_sort_of_many_partitions(spark, tmp_path):
    from qalens.operators.sort import sort_by_count
    from qalens.sinks.text import write_top_tags
    rows = spark.range(2000).selectExpr("concat('t', id) AS tag", "(id * 7919) % 997 AS n").repartition(8)
    path = str(tmp_path / "one")
    write_top_tags(sort_by_count(rows, "n", "tag"), path, single_file=True)
    expected = [f"({r.tag},{r.n})" for r in sorted(rows.collect(), key=lambda r: (-r.n, r.tag))]
    assert read_parts(path) == expected


def test_two_runs_on_one_session_keep_apart(spark, dump, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(2) as pool:
        outs = list(pool.map(lambda k: run(spark, *dump, str(tmp_path / f"o{k}")), range(2)))
    for mean_path, top_path in outs:
        assert sorted(read_parts(mean_path)) == ["(edge,(1439,1.0))", "(java,(2,1.0))", "(spark,(10,0.5))"]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from qalens.session import shared_dir
    conf = SimpleNamespace(get=lambda key, default: default)
    for master, ok in (("spark://host:7077", False), ("yarn", False), ("local-cluster[2,1,1024]", False), ("local[4]", True)):
        seen = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: seen[-1] if seen else None, setCheckpointDir=seen.append)
        session = SimpleNamespace(sparkContext=sc, conf=conf)
        if ok:
            assert shared_dir(session)
        else:
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                shared_dir(session)


@pytest.mark.parametrize("date, kept", [("2021-01-01T00:00:00Z", True), ("+12021-01-01T00:00:00Z", False), ("-2021-01-01T00:00:00Z", False),
                                        ("2021-01-01t00:00z", True), ("2021-01-01", False), ("2021-13-01T00:00:00Z", False)])
def test_only_four_digit_years(spark, date, kept):
    lines = spark.createDataFrame([(f"1,NA,{date},NA",)], "value string")
    assert (parse_questions(lines).count() == 1) == kept


@pytest.mark.parametrize("scan_partitions", [1, 7])
def test_job_output_does_not_depend_on_scan_partitions(spark, dump, tmp_path, scan_partitions):
    mean_path, top_path = run(spark, *dump, str(tmp_path / "p"), scan_partitions=scan_partitions)
    assert sorted(read_parts(mean_path)) == ["(edge,(1439,1.0))", "(java,(2,1.0))", "(spark,(10,0.5))"]
    assert read_parts(top_path) == ["(java,4)", "(spark,2)", "(edge,1)", "(slow,1)"]
