"""Projections, filters, joins, aggregates, windows, sorts and union."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions.keys import hash_key
from quirework.functions.text import is_blank
from quirework.operators import aggregates as A
from quirework.operators import joins as J
from quirework.operators import ordering as O
from quirework.operators import predicates as F_
from quirework.operators import projections as P
from quirework.operators import windows as W
from quirework.queries.derive import OPTION_ORDER, table

c = F.col
_ORDER_SQL = ", ".join(OPTION_ORDER)


def conform_schema(spark, d):
    schema = T.StructType.fromDDL("doc_key string, language string, n_chars int, size_kb double")
    docs = P.rename(table(spark, d, "documents"), {"doc_id": "doc_key", "lang": "language"})
    return P.conform(P.compute(docs, {"size_kb": c("n_chars") / 1024}), schema)


def cast_reject_counts(spark, d):
    props = table(spark, d, "events").select(
        F.when(c("event_type") == "error", "n/a")
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("k"),
        c("event_id").cast("string").alias("event_id"),
    )
    return P.cast_rejects(props, T.StructType.fromDDL("k int, event_id bigint"))


def column_subset(spark, d):
    return P.subset(table(spark, d, "part"), "p_partkey", "p_brand")


def computed_columns(spark, d):
    part = P.subset(table(spark, d, "part"), "p_partkey", "p_name", "p_size")
    return P.compute(
        part,
        {
            "p_title": F.initcap("p_name"),
            "p_even": c("p_size") % 2 == 0,
            "p_size": c("p_size") + 1,
        },
    )


def fill_nulls(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.when(c("lang") != "en", c("text")).alias("raw_text")
    )
    return P.fill_text(docs, "raw_text")


def batch_stamp(spark, d):
    stamped = P.stamp_date(
        table(spark, d, "events").select("event_id"), "processed_on", "2025-03-01"
    )
    return P.stamp_time(stamped, "processed_at", "2025-03-01T00:00:00+00:00")


def suffix_filter(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return part.filter(F_.has_suffix(c("p_name"), "bolt"))


def range_filter(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size")
    return part.filter(F_.at_least(c("p_size"), 30))


def type_filter(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return part.filter(
        F_.equals_ignoring_case(c("p_type"), "economy")
        & F_.has_suffix_ignoring_case(c("p_name"), "Widget")
    )


def non_blank_filter(spark, d):
    lines = table(spark, d, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.filter(F_.not_blank(c("line")))


def conjunction_filter(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.filter(
        F_.all_of(c("lang") == "en", c("source") == "src1", c("n_chars") >= 100)
    )


def broadcast_join(spark, d):
    return J.equi_join(
        table(spark, d, "supplier").withColumnRenamed("s_nationkey", "nationkey"),
        table(spark, d, "nation").withColumnRenamed("n_nationkey", "nationkey"),
        "nationkey",
    ).select("s_suppkey", "s_name", "n_name")


def shuffled_join(spark, d):
    lines = table(spark, d, "lineitem").select(
        c("l_orderkey").alias("orderkey"), "l_partkey", "l_linenumber"
    )
    orders = table(spark, d, "orders").select(
        c("o_orderkey").alias("orderkey"), "o_custkey", "o_orderpriority"
    )
    return J.equi_join(lines, orders, "orderkey")


def left_join(spark, d):
    orders = table(spark, d, "orders").select(c("o_orderkey").alias("orderkey"), "o_custkey")
    lines = table(spark, d, "lineitem").select(
        c("l_orderkey").alias("orderkey"), "l_partkey", "l_linenumber"
    )
    return J.left_join(orders, lines, "orderkey", many_matches=True)


def hot_left_join(spark, d):
    """Orders with lines of which a third have the first order's key."""
    orders = table(spark, d, "orders").select(c("o_orderkey").alias("orderkey"), "o_custkey")
    lines = table(spark, d, "lineitem").select(
        F.when(c("l_orderkey") % 3 == 0, F.lit(1)).otherwise(c("l_orderkey")).alias("orderkey"),
        c("l_orderkey").alias("line_order"),
        "l_linenumber",
        "l_partkey",
    )
    return J.left_join(orders, lines, "orderkey", many_matches=True)


def semi_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return J.keep_existing(docs, table(spark, d, "labels"), "doc_id")


def gap_fill(spark, d):
    per_line = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.sum(c("l_quantity").cast("bigint")).alias("quantity"))
    )
    return J.fill_gaps(per_line, ["l_orderkey"], "l_linenumber", "quantity", 0, "line_count")


def spread_gap_fill(spark, d):
    """Order numbers of a priority as a line of numbers, one of which is a third of all rows."""
    orders = table(spark, d, "orders").select(
        F.when(c("o_orderkey") % 3 == 0, F.lit("0-ALL")).otherwise(c("o_orderpriority")).alias("line"),
        c("o_orderkey").alias("number"),
        "o_orderstatus",
    )
    dense = J.fill_gaps(orders, ["line"], "number", "o_orderstatus", "-", "last", spread=True)
    return dense.filter("number % 10 < 5")


def distinct_rows(spark, d):
    return A.distinct_rows(table(spark, d, "documents").select("text", "lang"))


def distinct_values(spark, d):
    return A.distinct_values(table(spark, d, "lineitem"), "l_linenumber")


def option_order(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", *OPTION_ORDER)
    return W.number_rows(lines, ["l_orderkey"], [c(o) for o in OPTION_ORDER], "option_pos")


def pivot_options(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", *OPTION_ORDER)
    first = W.first_rows(lines, ["l_orderkey"], [c(o) for o in OPTION_ORDER], 4, "pos")
    return A.pivot_slots(first, ["l_orderkey"], "pos", [1, 2, 3, 4], "l_partkey", "answer_")


def ordered_options(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", *OPTION_ORDER)
    return A.ordered_collect(lines, ["l_orderkey"], [c(o) for o in OPTION_ORDER], "l_partkey")


def row_counts(spark, d):
    names = ["documents", "events", "lineitem", "orders", "pages"]
    return A.row_counts({n: table(spark, d, n) for n in names})


def keep_first(spark, d):
    docs = table(spark, d, "documents").select(
        hash_key("text").alias("text_key"), "doc_id", "source"
    )
    return A.keep_first(docs, ["text_key"], ["doc_id"])


def first_non_null(spark, d):
    docs = table(spark, d, "documents").select(
        "source", "doc_id", F.nullif(c("lang"), F.lit("en")).alias("other_lang")
    )
    return A.first_non_null(docs, ["source"], "other_lang", "doc_id", c("source"))


def group_max(spark, d):
    return A.group_max(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", "page_count")


def distribution_map(spark, d):
    orders = table(spark, d, "orders")
    maps = A.category_maps(orders, ["o_custkey"], "o_orderstatus", "m")
    return maps.select("o_custkey", F.explode("m").alias("status", "n"))


def distribution_rows(spark, d):
    return A.category_rows(table(spark, d, "documents"), ["source"], "lang")


def topic_frequency(spark, d):
    return A.frequency(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


def term_coverage(spark, d):
    docs = table(spark, d, "documents")
    terms = F.filter(F.split(c("text"), r"[ \n]+"), lambda t: t != "")
    return A.term_coverage(docs, ["lang"], terms)


def run_audit(spark, d):
    docs = table(spark, d, "documents")
    state = (
        F.when(is_blank(c("text")), "blank").when(c("lang") == "fr", "failed").otherwise("ok")
    )
    labels = table(spark, d, "labels").withColumn(
        "kept", F.when(c("quality") == 1, "kept").otherwise("seen")
    )
    return A.run_audit({"page": (docs.withColumn("s", state), "s"), "question": (labels, "kept")})


def _in_one_group(spark, d):
    """Line items of which a third are one group, and their order in all."""
    lines = table(spark, d, "lineitem").select("l_orderkey", *OPTION_ORDER)
    group = F.when(c("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(c("l_orderkey"))
    return lines.withColumn("group", group)


def tree_numbers(spark, d):
    """Row numbers in groups of any size, with nearly as many chunks as rows."""
    order = [c("l_orderkey"), *[c(o) for o in OPTION_ORDER]]
    numbered = W.number_rows(_in_one_group(spark, d), ["group"], order, "n", {"o": c("l_orderkey")}, tree=True)
    return numbered.select("group", "l_orderkey", "l_linenumber", "l_partkey", "n")


def tree_carry_forward(spark, d):
    """The last part of the first line of an order, carried over groups of any size."""
    first = F.when((c("l_linenumber") == 1) & (c("l_partkey") % 2 == 0), c("l_partkey"))
    lines = _in_one_group(spark, d).withColumn("first_part", first)
    order = ["l_orderkey", *OPTION_ORDER]
    carried = W.carry_forward(lines, "first_part", ["group"], order, "part", -1, {"o": c("l_orderkey")}, tree=True)
    return carried.select("group", "l_orderkey", "l_linenumber", "l_partkey", "part")


def carry_forward(spark, d):
    events = table(spark, d, "events").select(
        "user_id",
        "ts",
        "event_id",
        F.when(c("event_type") == "purchase", c("event_id")).alias("purchase"),
    )
    return W.carry_forward(
        events,
        "purchase",
        ["user_id"],
        ["ts", "event_id"],
        "last_purchase",
        default=-1,
        chunk={"_day": F.date_trunc("day", "ts")},
    ).select("event_id", "user_id", "last_purchase")


def position_numbering(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("pages"))
    return W.number_items(lines, "pages", "raw_text", "page_number")


def sorted_rows(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return O.sort_rows(orders, "o_custkey", "o_orderkey")


def top_preview(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return O.top_rows(docs, 25, F.desc("n_chars"), "doc_id")


def union_inputs(spark, d):
    docs = table(spark, d, "documents").select(F.lit("documents").alias("origin"), "text")
    bench = table(spark, d, "benchmark").select(F.lit("benchmark").alias("origin"), "text")
    turns = table(spark, d, "conversations").select(F.lit("turns").alias("origin"), "text")
    return O.union_all(docs, bench, turns)


QUERIES = {
    "conform_schema": (
        conform_schema,
        """SELECT CAST(doc_id AS VARCHAR) AS doc_key, lang AS language,
        CAST(n_chars AS INTEGER) AS n_chars, n_chars / 1024 AS size_kb FROM documents""",
    ),
    "cast_reject_counts": (
        cast_reject_counts,
        """SELECT count(*) FILTER (event_type = 'error') AS k, CAST(0 AS BIGINT) AS event_id
        FROM events""",
    ),
    "column_subset": (column_subset, "SELECT p_partkey, p_brand FROM part"),
    "computed_columns": (
        computed_columns,
        """SELECT p_partkey, p_name, p_size + 1 AS p_size, p_size % 2 = 0 AS p_even,
        array_to_string(list_transform(string_split(p_name, ' '),
          lambda w: upper(w[1]) || w[2:]), ' ') AS p_title FROM part""",
    ),
    "fill_nulls": (
        fill_nulls,
        "SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE text END AS raw_text FROM documents",
    ),
    "batch_stamp": (
        batch_stamp,
        """SELECT event_id, DATE '2025-03-01' AS processed_on,
        '2025-03-01T00:00:00+00:00' AS processed_at FROM events""",
    ),
    "suffix_filter": (
        suffix_filter,
        "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'",
    ),
    "range_filter": (range_filter, "SELECT p_partkey, p_size FROM part WHERE p_size >= 30"),
    "type_filter": (
        type_filter,
        """SELECT p_partkey, p_name, p_type FROM part
        WHERE lower(p_type) = 'economy' AND lower(p_name) LIKE '%widget'""",
    ),
    "non_blank_filter": (
        non_blank_filter,
        r"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line FROM (
          SELECT doc_id, string_split(text, chr(10)) AS lines,
            unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
        WHERE regexp_matches(lines[i], '[^\s\x{a0}\x{3000}]')""",
    ),
    "conjunction_filter": (
        conjunction_filter,
        """SELECT doc_id, lang, source, n_chars FROM documents
        WHERE lang = 'en' AND source = 'src1' AND n_chars >= 100""",
    ),
    "broadcast_join": (
        broadcast_join,
        "SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    ),
    "shuffled_join": (
        shuffled_join,
        """SELECT l_orderkey AS orderkey, l_partkey, l_linenumber, o_custkey, o_orderpriority
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "left_join": (
        left_join,
        """SELECT o_orderkey AS orderkey, o_custkey, l_partkey, l_linenumber
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    ),
    "hot_left_join": (
        hot_left_join,
        """SELECT o_orderkey AS orderkey, o_custkey, l_orderkey AS line_order, l_linenumber, l_partkey
        FROM orders LEFT JOIN lineitem
          ON o_orderkey = CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_orderkey END""",
    ),
    "spread_gap_fill": (
        spread_gap_fill,
        """WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '0-ALL' ELSE o_orderpriority END AS line,
            o_orderkey AS number, o_orderstatus FROM orders),
          n AS (SELECT line, last, unnest(range(1, last + 1)) AS number FROM (
            SELECT line, max(number) AS last FROM o GROUP BY 1))
        SELECT line, number, last, coalesce(o_orderstatus, '-') AS o_orderstatus
        FROM n LEFT JOIN o USING (line, number) WHERE number % 10 < 5""",
    ),
    "semi_join": (
        semi_join,
        """SELECT doc_id, lang, source FROM documents d
        WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    ),
    "gap_fill": (
        gap_fill,
        """WITH q AS (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS quantity
            FROM lineitem GROUP BY ALL),
          spine AS (SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS line_count
            FROM lineitem GROUP BY 1),
          dense AS (SELECT l_orderkey, line_count,
            CAST(unnest(range(1, line_count + 1)) AS INTEGER) AS l_linenumber FROM spine)
        SELECT l_orderkey, l_linenumber, line_count, coalesce(quantity, 0) AS quantity
        FROM dense LEFT JOIN q USING (l_orderkey, l_linenumber)""",
    ),
    "distinct_rows": (distinct_rows, "SELECT DISTINCT text, lang FROM documents"),
    "distinct_values": (distinct_values, "SELECT DISTINCT l_linenumber FROM lineitem"),
    "option_order": (
        option_order,
        f"""SELECT l_orderkey, {_ORDER_SQL}, CAST(row_number() OVER
        (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS INTEGER) AS option_pos FROM lineitem""",
    ),
    "pivot_options": (
        pivot_options,
        f"""WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER
          (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS n FROM lineitem)
        SELECT l_orderkey, max(l_partkey) FILTER (n = 1) AS answer_1,
          max(l_partkey) FILTER (n = 2) AS answer_2, max(l_partkey) FILTER (n = 3) AS answer_3,
          max(l_partkey) FILTER (n = 4) AS answer_4 FROM r GROUP BY 1""",
    ),
    "ordered_options": (
        ordered_options,
        f"""SELECT l_orderkey, l_partkey, CAST(row_number() OVER
        (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS INTEGER) AS position FROM lineitem""",
    ),
    "row_counts": (
        row_counts,
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}"
            for n in ["documents", "events", "lineitem", "orders", "pages"]
        ),
    ),
    "keep_first": (
        keep_first,
        """SELECT sha256(text) AS text_key, min(doc_id) AS doc_id,
        arg_min(source, doc_id) AS source FROM documents GROUP BY 1""",
    ),
    "first_non_null": (
        first_non_null,
        """SELECT source, coalesce(arg_min(lang, doc_id) FILTER (lang <> 'en'), source)
        AS other_lang FROM documents GROUP BY 1""",
    ),
    "group_max": (
        group_max,
        "SELECT l_orderkey, max(l_linenumber) AS page_count FROM lineitem GROUP BY 1",
    ),
    "distribution_map": (
        distribution_map,
        """SELECT o_custkey, o_orderstatus AS status, CAST(count(*) AS INTEGER) AS n
        FROM orders GROUP BY 1, 2""",
    ),
    "distribution_rows": (
        distribution_rows,
        "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2",
    ),
    "topic_frequency": (
        topic_frequency,
        "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2",
    ),
    "term_coverage": (
        term_coverage,
        r"""SELECT lang, count(DISTINCT term) AS distinct_terms, count(*) AS total_terms FROM (
          SELECT lang, unnest(regexp_extract_all(text, '[^ \n]+')) AS term FROM documents)
        GROUP BY 1""",
    ),
    "run_audit": (
        run_audit,
        r"""SELECT 'page' AS stage, CASE WHEN
          NOT regexp_matches(text, '[^\s\x{a0}\x{3000}]') THEN 'blank' WHEN lang = 'fr'
          THEN 'failed' ELSE 'ok' END AS status, count(*) AS n_rows FROM documents GROUP BY 2
        UNION ALL SELECT 'question', CASE WHEN quality = 1 THEN 'kept' ELSE 'seen' END, count(*)
        FROM labels GROUP BY 2""",
    ),
    "tree_numbers": (
        tree_numbers,
        f"""SELECT g AS "group", l_orderkey, l_linenumber, l_partkey,
          row_number() OVER (PARTITION BY g ORDER BY l_orderkey, {_ORDER_SQL}) AS n
        FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END AS g FROM lineitem)""",
    ),
    "tree_carry_forward": (
        tree_carry_forward,
        f"""SELECT g AS "group", l_orderkey, l_linenumber, l_partkey, coalesce(last_value(
            CASE WHEN l_linenumber = 1 AND l_partkey % 2 = 0 THEN l_partkey END IGNORE NULLS) OVER (
            PARTITION BY g ORDER BY l_orderkey, {_ORDER_SQL}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS part
        FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END AS g FROM lineitem)""",
    ),
    "carry_forward": (
        carry_forward,
        """SELECT event_id, user_id, coalesce(last_value(
          CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (
            PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS last_purchase
        FROM events""",
    ),
    "position_numbering": (
        position_numbering,
        """SELECT doc_id, CAST(i AS INTEGER) AS page_number, lines[i] AS raw_text FROM (
          SELECT doc_id, string_split(text, chr(10)) AS lines,
            unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)""",
    ),
    "sorted_rows": (
        sorted_rows,
        "SELECT o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY 1, 2",
    ),
    "top_preview": (
        top_preview,
        "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25",
    ),
    "union_inputs": (
        union_inputs,
        """SELECT 'documents' AS origin, text FROM documents
        UNION ALL SELECT 'benchmark', text FROM benchmark
        UNION ALL SELECT 'turns', text FROM conversations""",
    ),
}
