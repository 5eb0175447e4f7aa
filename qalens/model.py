"""The three tables every report is computed from.

``questions``  ``id, creation_ts, link``
``answers``    ``link, creation_ts, score``
``tags``       ``question_id, tag``

An answer belongs to every question copy with the same ``link``. For the Q&A dumps the
link of a question is its own id and the link of an answer is its parent question id,
so answers hang off questions exactly as in the source data. A view may instead link
answers through a shared key (e.g. every view event of a user is answered by that
user's purchases) without ever materialising the question x answer pairs: the
nearest-answer scan works on the link key directly.

Question ids may repeat (C10): an id is one question, dated by its earliest copy, and every copy
counts (tag weight = number of copies). All copies of an id have the same link. Rows with a NULL
timestamp or an answer with a NULL link cannot take part in a latency and are dropped by the scan.

``materialize_scan`` tells the nearest-answer scan to write its narrow input once before the
range exchange too (whose sampling pass would otherwise recompute the inputs). That pays off
when the inputs are expensive to recompute (text dumps that are scanned and parsed); plain
columnar scans are cheaper to read twice.

``scan_rows`` optionally gives the scan its input ``id, link, creation_ts, is_q`` directly,
for views whose questions and answers come from one table and can be read in one scan.

``scratch`` optionally names the folder that the scan writes to (default: the shared folder).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(c: Column | str) -> Column:
    """A timestamp column as an instant (TIMESTAMP under the pinned UTC session zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp")


@dataclass(frozen=True)
class QAData:
    questions: DataFrame
    answers: DataFrame
    tags: DataFrame
    materialize_scan: bool = True
    scan_rows: DataFrame | None = None
    scratch: str | None = None

    @staticmethod
    def keyed_by_question(questions: DataFrame, answers: DataFrame, tags: DataFrame,
                          materialize_scan: bool = True, scratch: str | None = None) -> "QAData":
        """Tables in the dump layout: answers carry their parent ``question_id``."""
        return QAData(
            questions=questions.select("id", instant("creation_ts").alias("creation_ts"),
                                       F.col("id").alias("link")),
            answers=answers.select(F.col("question_id").alias("link"),
                                   instant("creation_ts").alias("creation_ts"), "score"),
            tags=tags.select("question_id", "tag"),
            materialize_scan=materialize_scan,
            scratch=scratch,
        )
