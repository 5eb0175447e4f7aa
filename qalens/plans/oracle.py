"""DuckDB building blocks shared by the registered oracle statements.

The oracle computes each result the literal way the reference job defines it: every question
copy paired with every tag row and with every answer of its question (for the events view,
every purchase of the same user). That is only affordable on the small check data; the Spark
side never forms those pairs.
"""

# Tables region ... conversations are registered as views by the checker.

EVENTS_SQL = """
q AS (SELECT event_id AS id, ts AS creation_ts FROM events WHERE event_type = 'view'),
a AS (SELECT v.event_id AS question_id, p.ts AS creation_ts, CAST(floor(p.value) AS INTEGER) AS score
      FROM events v JOIN events p ON p.user_id = v.user_id
      WHERE v.event_type = 'view' AND p.event_type = 'purchase'),
vk AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'view'),
t AS (SELECT event_id AS question_id, 'k' || (k % 10) AS tag FROM vk
      UNION ALL SELECT event_id AS question_id, 'k' || (k // 10) AS tag FROM vk)"""

ORDERS_SQL = """
q AS (SELECT o_orderkey AS id, o_orderdate AS creation_ts FROM orders),
a AS (SELECT l_orderkey AS question_id, l_shipdate AS creation_ts, CAST(l_quantity AS INTEGER) AS score FROM lineitem),
t AS (SELECT l_orderkey AS question_id, p_brand AS tag FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# Question ids that repeat: every order, line item and brand under the customer's key.
CUSTOMERS_SQL = """
q AS (SELECT o_custkey AS id, o_orderdate AS creation_ts FROM orders),
a AS (SELECT o_custkey AS question_id, l_shipdate AS creation_ts, CAST(l_quantity AS INTEGER) AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT o_custkey AS question_id, p_brand AS tag FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

# The literal model: question copy x tag row; nearest answer over pairs of the id's earliest copy and its answers.
PAIRS_SQL = """
qt AS (SELECT q.id, t.tag FROM q JOIN t ON t.question_id = q.id),
m AS (SELECT q1.id, min(abs(epoch_us(a.creation_ts) - epoch_us(q1.creation_ts))) // 60000000 AS minutes
      FROM (SELECT id, min(creation_ts) AS creation_ts FROM q GROUP BY id) AS q1 JOIN a ON a.question_id = q1.id GROUP BY q1.id),
pairs AS (SELECT qt.id, qt.tag, m.minutes FROM qt JOIN m ON qt.id = m.id)"""


def mean_time_sql(threshold: int) -> str:
    fast = f"FILTER (WHERE minutes < {threshold})"
    return (f"SELECT tag, CAST(sum(minutes) {fast} AS BIGINT) // count(*) {fast} AS mean_minutes, "
            f"(count(*) {fast})::DOUBLE / count(*) AS probability "
            f"FROM pairs GROUP BY tag HAVING count(*) {fast} > 0")


TOP_TAGS_SQL = "SELECT tag, count(*) AS n FROM pairs GROUP BY tag"


def with_views(view_sql: str, body: str) -> str:
    return f"WITH {view_sql},{PAIRS_SQL}\n{body}"



def answers_nested_sql(answers: str, segment: int) -> str:
    """``answers``: a query of (link, us, score); its rows numbered by time within the link and cut into lists."""
    return (f"SELECT link, r // {segment} AS segment, string_agg(us || ':' || coalesce(CAST(score AS VARCHAR), ''), '|' ORDER BY us, score) AS answer_list "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY us, score) - 1 AS r FROM ({answers})) GROUP BY link, r // {segment}")


def whole_questions_sql(answers: str, segment: int) -> str:
    """The lists of ``answers_nested_sql`` under their question, the first with its date and tags."""
    return (f"SELECT s.link AS id, s.segment, c.copies, CASE WHEN s.segment = 0 THEN c.creation_us END AS creation_us, s.answer_list, "
            f"CASE WHEN s.segment = 0 THEN c.tag_list END AS tag_list FROM ({answers_nested_sql(answers, segment)}) AS s JOIN "
            "(SELECT d.id, d.copies, d.creation_us, string_agg(k.tag || ':' || k.n, '|' ORDER BY k.tag) AS tag_list "
            "FROM (SELECT id, count(*) AS copies, min(epoch_us(creation_ts)) AS creation_us FROM q GROUP BY id) AS d "
            "JOIN (SELECT id, tag, count(*) AS n FROM qt GROUP BY id, tag) AS k ON k.id = d.id GROUP BY d.id, d.copies, d.creation_us) AS c ON c.id = s.link")


# The answers of the links that have a question.
EVENT_ANSWERS_SQL = ("SELECT user_id AS link, epoch_us(ts) AS us, CAST(floor(value) AS INTEGER) AS score FROM events "
                     "WHERE event_type = 'purchase' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'view')")
CUSTOMER_ANSWERS_SQL = ("SELECT o_custkey AS link, epoch_us(l_shipdate) AS us, CAST(l_quantity AS INTEGER) AS score "
                        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
ORDER_ANSWERS_SQL = ("SELECT l_orderkey AS link, epoch_us(l_shipdate) AS us, CAST(l_quantity AS INTEGER) AS score "
                     "FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)")
