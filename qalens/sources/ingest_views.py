"""Registered ingest and job queries (I1-I5, K3-K6, and both reports from text lines).

Stand-in dumps are text files written once an application and state of the table files (names, sizes, times); their lines are built from the driver
tables: the builders below only format rows into the dump's line layout (plus a header and, as noise, every line of every document);
all parsing, header removal and reporting is done by the library's own code. The DuckDB
side builds the same lines and parses them with the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens import job
from qalens.functions.render import parse_mean_time_line
from qalens.model import QAData
from qalens.plans import reports
from qalens.plans.oracle import PAIRS_SQL, TOP_TAGS_SQL, mean_time_sql
from qalens.session import fresh_path, listing
from qalens.sources import ingest
from qalens.sources.text import numbered_lines, scan_lines, strip_header
from qalens.sources.views import ORDERS_THRESHOLD, table

# Dump header lines.
QUESTION_HEADER = "Id,OwnerUserId,CreationDate,ClosedDate,Score,Title,Body"
ANSWER_HEADER = "Id,OwnerUserId,CreationDate,ParentId,Score,Body"
TAG_HEADER = "Id,Tag"


# --- line builders (Spark) -------------------------------------------------------------------

def _iso(ts: Column, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def _header(spark: SparkSession, header: str) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.lit(header).alias("value"))


def document_lines(documents: DataFrame) -> DataFrame:
    """Every line of every document text (noise for the dumps)."""
    return documents.select(F.explode(F.split("text", "\n", -1)).alias("value"))


def event_question_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.select(F.concat_ws(
        ",", F.col("event_id").cast("string"), F.lit("NA"),
        F.concat(_iso(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")), F.lit("NA"),
        F.floor("value").cast("string"), F.lit("t"), F.lit("b")).alias("value"))
    return (_header(spark, QUESTION_HEADER).unionByName(rows)
            .unionByName(document_lines(table(spark, sf_dir, "documents"))))


def order_question_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), F.lit("NA"),
        F.concat(_iso(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.lit("NA"), F.lit("1"),
        F.lit("t"), F.lit("b")).alias("value"))
    return _header(spark, QUESTION_HEADER).unionByName(rows)


def lineitem_answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer lines with varied date forms: no seconds, ``Z`` or a ``+03:00`` offset; some scores ``NA``."""
    li = table(spark, sf_dir, "lineitem")
    shifted = F.when(F.col("l_linestatus") == "O", F.col("l_shipdate") + F.expr("INTERVAL 3 HOURS")) \
        .otherwise(F.col("l_shipdate"))
    local = F.when(F.col("l_returnflag") == "A", _iso(shifted, "yyyy-MM-dd'T'HH:mm")) \
        .otherwise(_iso(shifted, "yyyy-MM-dd'T'HH:mm:ss"))
    date = F.concat(local, F.when(F.col("l_linestatus") == "O", F.lit("+03:00")).otherwise(F.lit("Z")))
    score = F.when(F.col("l_returnflag") == "R", F.lit("NA")).otherwise(F.floor("l_quantity").cast("string"))
    rows = li.select(F.concat_ws(",", F.col("l_linenumber").cast("string"), F.lit("NA"), date,
                                 F.col("l_orderkey").cast("string"), score, F.lit("x")).alias("value"))
    return (_header(spark, ANSWER_HEADER).unionByName(rows)
            .unionByName(document_lines(table(spark, sf_dir, "documents"))))


def lineitem_tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lines ``order,brand`` (open line items carry a trailing comma)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    rows = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.concat(F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("p_brand")),
                             F.when(F.col("l_linestatus") == "O", F.lit(",")).otherwise(F.lit("")))
                    .alias("value")))
    return _header(spark, TAG_HEADER).unionByName(rows)


# --- registered queries -------------------------------------------------------------------------

#: Folders of stand-in dumps already written by this application, by name and the files they were made from.
_WRITTEN: dict[tuple, str] = {}

#: Lines in a file of a stand-in dump: its files are compressed, so each is read by one task.
LINES_PER_FILE = 500_000


def dump_folder(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], lines: DataFrame) -> str:
    """Folder of gzip part files of a stand-in dump of ``tables``, written again once any of their files is another."""
    state = tuple(listing(spark, f"{sf_dir}/{t}.parquet") for t in tables)
    key = (spark.sparkContext.applicationId, sf_dir, name, state)
    if key not in _WRITTEN:
        path = fresh_path(spark, f"dump-{name}")
        lines.write.option("maxRecordsPerFile", LINES_PER_FILE).text(path, compression="gzip")
        _WRITTEN[key] = path
    return _WRITTEN[key]


def event_questions_dump(spark: SparkSession, sf_dir: str) -> str:
    return dump_folder(spark, sf_dir, "event-questions", ("events", "documents"), event_question_lines(spark, sf_dir))


def order_questions_dump(spark: SparkSession, sf_dir: str) -> str:
    return dump_folder(spark, sf_dir, "questions", ("orders",), order_question_lines(spark, sf_dir))


def order_answers_dump(spark: SparkSession, sf_dir: str) -> str:
    return dump_folder(spark, sf_dir, "answers", ("lineitem", "documents"), lineitem_answer_lines(spark, sf_dir))


def order_tags_dump(spark: SparkSession, sf_dir: str) -> str:
    return dump_folder(spark, sf_dir, "tags", ("lineitem", "part"), lineitem_tag_lines(spark, sf_dir))


def order_dumps(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Folders of the question, answer and tag dumps of the orders tables."""
    return order_questions_dump(spark, sf_dir), order_answers_dump(spark, sf_dir), order_tags_dump(spark, sf_dir)


def _scan_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan the question lines from text files."""
    return scan_lines(spark, event_questions_dump(spark, sf_dir)).select(F.col("value").alias("line"))


def _strip_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the header of a folder of part files, found as the first line of its first file."""
    path = event_questions_dump(spark, sf_dir)
    return strip_header(scan_lines(spark, path), path=path).select(F.col("value").alias("line"))


def _ingest_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = strip_header(scan_lines(spark, event_questions_dump(spark, sf_dir)), QUESTION_HEADER)
    return ingest.parse_questions(lines).select("id", F.unix_micros("creation_ts").alias("creation_us"))


def _ingest_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = strip_header(scan_lines(spark, order_answers_dump(spark, sf_dir)), ANSWER_HEADER)
    return ingest.parse_answers(lines).select("question_id", F.unix_micros("creation_ts").alias("creation_us"),
                                              "score")


def _ingest_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_tags(strip_header(scan_lines(spark, order_tags_dump(spark, sf_dir)), TAG_HEADER))


def dump_tables(spark: SparkSession, sf_dir: str) -> QAData:
    """The three dumps (orders, line items, part brands) read by the library's ingest."""
    return ingest.read_dump(spark, *order_dumps(spark, sf_dir))


def job_output(spark: SparkSession, sf_dir: str, report: str, runs: int = 1, single_file: bool = False) -> str:
    """Run the whole job on the dumps, ``runs`` times into one output folder; the folder of a report."""
    out = output_folder(spark, sf_dir, f"job-{report}-{runs}-{single_file}")
    for _ in range(runs):
        job.run(spark, *order_dumps(spark, sf_dir), out, ORDERS_THRESHOLD, single_file=single_file)
    return f"{out}/{report}"


def output_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The output folder of a job query: one an application and table folder, replaced by each run."""
    return _WRITTEN.setdefault((spark.sparkContext.applicationId, sf_dir, name), fresh_path(spark, name))


def _job_mean_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K3, K5, K6: the lines of the second of two runs into one folder, whole, parsed back."""
    lines = scan_lines(spark, job_output(spark, sf_dir, "mean_time_answer", runs=2))
    return parse_mean_time_line(lines.select(F.col("value").alias("line")))


def _job_top_tags(single_file: bool):
    """K2, S1 (K4): the lines of the report with their numbers across its part files."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = numbered_lines(spark, job_output(spark, sf_dir, "top_tags", single_file=single_file))
        return lines.select("line_no", F.col("value").alias("line"))
    return run


def queries():
    return {
        "scan_text_lines": _scan_text_lines,
        "strip_header": _strip_header,
        "ingest_questions": _ingest_questions,
        "ingest_answers": _ingest_answers,
        "ingest_tags": _ingest_tags,
        "dump_mean_time_answer": lambda spark, sf: reports.mean_time_answer(dump_tables(spark, sf), ORDERS_THRESHOLD),
        "dump_top_tags": lambda spark, sf: reports.top_tags(dump_tables(spark, sf)),
        "job_mean_time_answer": _job_mean_time,
        "job_top_tags": _job_top_tags(single_file=False),
        "job_top_tags_single_file": _job_top_tags(single_file=True),
    }


# --- DuckDB side ---------------------------------------------------------------------------------

DOC_LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"

EVENT_QUESTION_LINES_SQL = f"""
ql AS (SELECT '{QUESTION_HEADER}' AS line
       UNION ALL SELECT concat_ws(',', event_id, 'NA', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z', 'NA',
                                  CAST(floor(value) AS BIGINT), 't', 'b') FROM events
       UNION ALL {DOC_LINES_SQL})"""

ORDER_QUESTION_LINES_SQL = f"""
ql AS (SELECT '{QUESTION_HEADER}' AS line
       UNION ALL SELECT concat_ws(',', o_orderkey, 'NA', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z', 'NA',
                                  '1', 't', 'b') FROM orders)"""

ANSWER_LINES_SQL = f"""
al AS (SELECT '{ANSWER_HEADER}' AS line
       UNION ALL SELECT concat_ws(',', l_linenumber, 'NA',
           CASE WHEN l_returnflag = 'A'
                THEN strftime(CASE WHEN l_linestatus = 'O' THEN l_shipdate + INTERVAL 3 HOUR ELSE l_shipdate END,
                              '%Y-%m-%dT%H:%M')
                ELSE strftime(CASE WHEN l_linestatus = 'O' THEN l_shipdate + INTERVAL 3 HOUR ELSE l_shipdate END,
                              '%Y-%m-%dT%H:%M:%S') END
           || CASE WHEN l_linestatus = 'O' THEN '+03:00' ELSE 'Z' END,
           l_orderkey,
           CASE WHEN l_returnflag = 'R' THEN 'NA' ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END,
           'x') FROM lineitem
       UNION ALL {DOC_LINES_SQL})"""

TAG_LINES_SQL = f"""
tl AS (SELECT '{TAG_HEADER}' AS line
       UNION ALL SELECT concat_ws(',', l_orderkey, p_brand) || CASE WHEN l_linestatus = 'O' THEN ',' ELSE '' END
       FROM lineitem JOIN part ON l_partkey = p_partkey)"""

INT_RE = r"^[+-]?\d+$"
DT_RE = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([Zz]|[+-]\d{2}:\d{2})$"


def _int(e: str) -> str:
    return f"CASE WHEN regexp_matches({e}, '{INT_RE}') THEN TRY_CAST({e} AS INTEGER) END"


def _dt(e: str) -> str:
    fixed = f"regexp_replace(upper({e}), 'T(\\d{{2}}:\\d{{2}})(Z|[+-])', 'T\\1:00\\2')"
    return f"CASE WHEN regexp_matches({e}, '{DT_RE}') THEN TRY_CAST({fixed} AS TIMESTAMPTZ) END"


PARSED_SQL = f"""
q AS (SELECT * FROM (SELECT {_int('f[1]')} AS id, {_dt('f[3]')} AS creation_ts
                     FROM (SELECT string_split(line, ',') AS f FROM ql WHERE line <> '{QUESTION_HEADER}'))
      WHERE id IS NOT NULL AND creation_ts IS NOT NULL),
a AS (SELECT * FROM (SELECT {_int('f[4]')} AS question_id, {_dt('f[3]')} AS creation_ts, {_int('f[5]')} AS score
                     FROM (SELECT string_split(line, ',') AS f FROM al WHERE line <> '{ANSWER_HEADER}'))
      WHERE question_id IS NOT NULL AND creation_ts IS NOT NULL AND score IS NOT NULL),
t AS (SELECT CAST(f[1] AS INTEGER) AS question_id, f[2] AS tag
      FROM (SELECT string_split(regexp_replace(line, ',+$', ''), ',') AS f FROM tl WHERE line <> '{TAG_HEADER}'))"""


def oracle_sql():
    all_lines = f"{EVENT_QUESTION_LINES_SQL},{ANSWER_LINES_SQL},{TAG_LINES_SQL},{PARSED_SQL}"
    dump = f"{ORDER_QUESTION_LINES_SQL},{ANSWER_LINES_SQL},{TAG_LINES_SQL},{PARSED_SQL},{PAIRS_SQL}"
    numbered = f"SELECT row_number() OVER (ORDER BY n DESC, tag) AS line_no, '(' || tag || ',' || n || ')' AS line FROM ({TOP_TAGS_SQL})"
    return {
        "scan_text_lines": f"WITH {EVENT_QUESTION_LINES_SQL} SELECT line FROM ql",
        "strip_header": f"WITH {EVENT_QUESTION_LINES_SQL} SELECT line FROM ql WHERE line <> '{QUESTION_HEADER}'",
        "ingest_questions": f"WITH {all_lines} SELECT id, epoch_us(creation_ts) AS creation_us FROM q",
        "ingest_answers": f"WITH {all_lines} SELECT question_id, epoch_us(creation_ts) AS creation_us, score FROM a",
        "ingest_tags": f"WITH {all_lines} SELECT question_id, tag FROM t",
        "dump_mean_time_answer": f"WITH {dump} {mean_time_sql(ORDERS_THRESHOLD)}",
        "dump_top_tags": f"WITH {dump} {TOP_TAGS_SQL}",
        "job_mean_time_answer": f"WITH {dump} {mean_time_sql(ORDERS_THRESHOLD)}",
        "job_top_tags": f"WITH {dump} {numbered}",
        "job_top_tags_single_file": f"WITH {dump} {numbered}",
    }
