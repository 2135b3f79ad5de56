"""The registered queries: each takes a session and a folder of benchmark tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..functions.json import long_of, parse_once, text_of
from ..operators import changes, dims, envelope, facts, keywords, logs, segment, traffic
from ..operators.versions import lookup_as_of
from ..session import run_dir
from ..sources import changelog, routes, tables, topics
from ..sources.schemas import CHANGE, TOPIC_COMMENT, TOPIC_DB, TOPIC_PAGE, TRAFFIC_WINDOW
from ..streaming import held, jobs, sinks, visitors
from ..streaming.runner import finish, run_file_sink
from . import adapters
from .adapters import DATABASE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"


def query(fn: Query) -> Query:
    QUERIES[f"q_{fn.__name__}"] = fn
    return fn


def _keys(data: Column) -> Column:
    """The key names of a map or a JSON object as one text."""
    return F.array_join(F.array_sort(data), ",")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_logs(adapters.log_topic(spark, sf_dir).select("seq", "value"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page log read as a table straight from the log text."""
    topic = adapters.log_topic(spark, sf_dir).select("seq", "value")
    return topics.page_table(topic, watermark=None).filter(F.col("page").isNotNull())


def _user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension changes of the change topic, routed and pruned."""
    changed = changes.dim_changes(adapters.quoted_change_topic(spark, sf_dir), DATABASE)
    return changes.prune_columns(changes.route_dims(changed, routes.dim_routes(spark)))


# Sources ------------------------------------------------------------------------------------------------


@query
def topic_source(spark, sf_dir):
    """The log topic read as a stream, copied through an exactly-once file sink."""
    root = run_dir(spark, "topic-source")
    adapters.log_topic(spark, sf_dir).select("seq", "value").write.parquet(f"{root}/in")
    stream = topics.read_topic(spark, path=f"{root}/in")
    finish(run_file_sink(stream, f"{root}/out", f"{root}/checkpoint"))
    return topics.read_topic(spark, path=f"{root}/out", streaming=False).select(
        "seq", F.get_json_object("value", "$.ts").cast("bigint").alias("ts")
    )


@query
def typed_topic(spark, sf_dir):
    changed = topics.typed(adapters.broken_change_topic(spark, sf_dir), CHANGE)
    return changed.select(
        "seq", "database", F.col("table").alias("source_table"), "type", "ts", F.col("data")["id"].alias("id"),
        F.cardinality("data").alias("n_fields"),
    )


@query
def change_table(spark, sf_dir):
    table = topics.change_table(adapters.change_topic(spark, sf_dir))
    return table.select(
        "seq", "database", F.col("table").alias("source_table"), "type", F.col("data")["order_id"].alias("order_id"),
        F.date_format("et", times.DATE_TIME).alias("et"), F.col("pt").isNotNull().alias("has_pt"),
    )


@query
def page_table(spark, sf_dir):
    page = F.col("page")
    return _pages(spark, sf_dir).select(
        "seq", page["page_id"].alias("page_id"), page["item"].alias("item"), "ts",
        F.date_format("et", MILLIS).alias("et"),
    )


@query
def changelog_source(spark, sf_dir):
    """Snapshot then changes: the last state of every user."""
    captures = changelog.read_captures(adapters.capture_topic(spark, sf_dir), ["user_info"])
    history = changelog.snapshot_then_changes(adapters.customer_snapshot(spark, sf_dir), captures)
    latest = changelog.latest_rows(history.filter(F.col("source.db") == DATABASE), "id")
    return latest.filter(F.col("key").isNotNull()).select(
        F.col("key").alias("id"), "op", F.col("row")["name"].alias("name")
    )


@query
def changelog_chunks(spark, sf_dir):
    """Snapshot by key ranges between marks of the change log: the last state of every user, whatever the chunk's size."""
    captures = changelog.read_captures(adapters.capture_topic(spark, sf_dir), ["user_info"]).filter(F.col("source.db") == DATABASE)
    out = []
    for size in (100, 1000):
        chunk_of = F.floor(F.col("key").cast("bigint") / size)
        marks = adapters.chunk_marks(spark, sf_dir, size)
        chunks = adapters.customer_chunks(spark, sf_dir, captures, marks, chunk_of)
        history = changelog.merge_chunks(chunks, marks.select("chunk", "low", "high"), captures, "id", chunk_of)
        latest = changelog.latest_rows(history, "id").filter(F.col("key").isNotNull())
        out.append(latest.select(
            F.lit(size).alias("chunk_size"), F.col("key").alias("id"), F.when(F.col("op") != "d", F.col("row")["name"]).alias("name"),
            (F.col("op") != "d").alias("alive"),
        ))
    return reduce(DataFrame.unionByName, out)


@query
def config_snapshot(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/customer.parquet", camel=True).select(
        "cCustkey", "cName", "cNationkey", "cMktsegment"
    )


# Sinks --------------------------------------------------------------------------------------------------


@query
def topic_sink(spark, sf_dir):
    """The log fan-out as a streaming job, its topics read back."""
    root = run_dir(spark, "topic-sink")
    adapters.log_topic(spark, sf_dir).select("seq", "value").write.parquet(f"{root}/in")
    finish(jobs.split_logs(topics.read_topic(spark, path=f"{root}/in"), root))
    back = spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics")
    return _topic_fields(back)


def _topic_fields(rows: DataFrame) -> DataFrame:
    """Topic rows of logs with the fields inside their JSON."""

    def either(*paths: str) -> Column:
        return F.coalesce(*[F.get_json_object("value", path) for path in paths])

    return rows.select(
        "seq", "topic", either("$.common.mid", "$.mid").alias("mid"), either("$.common.is_new", "$.is_new").alias("is_new"),
        either("$.ts").cast("bigint").alias("ts"), either("$.item", "$.page.item").alias("item"),
        either("$.pos", "$.err.error_code", "$.page.during_time").cast("bigint").alias("number"),
    )


@query
def topic_route(spark, sf_dir):
    """Routed facts as topic rows; the JSON is parsed back to show its fields."""
    routed = changes.route_facts(
        changes.fact_changes(adapters.change_topic(spark, sf_dir), DATABASE), routes.fact_routes(spark)
    )
    rows = changes.fact_topic_rows(changes.prune_columns(routed))
    return rows.select("seq", "topic", *_fact_fields(), _keys(F.json_object_keys("value")).alias("fields"))


def _fact_fields() -> list[Column]:
    names = ("id", "user_id", "coupon_id", "coupon_status", "create_time")
    return [F.get_json_object("value", f"$.{name}").alias(name) for name in names]


@query
def fact_job(spark, sf_dir):
    """The fact job on two parts of the change topic; the captured routes change between them."""
    root = run_dir(spark, "fact-job")
    topic = adapters.change_topic(spark, sf_dir)
    late = F.expr("(seq div 4) % 2 = 1")
    first = routes.fact_routes(spark)
    moved = first.filter("source_table = 'favor_info'").withColumns(
        {"sink_table": F.lit("dwd_favor_moved"), "sink_columns": F.lit("id,user_id")}
    )
    gone = first.filter("source_table = 'user_info'")
    captured = [adapters.route_captures(first, "routes", "r", 0)]
    read = jobs.live_fact_routes(lambda: reduce(DataFrame.unionByName, captured), "routes")
    for number, condition in enumerate((~late, late)):
        _write_phase(topic, root, number, condition)
        finish(jobs.route_facts(topics.read_topic(spark, path=f"{root}/in/phase=*"), root, DATABASE, read))
        captured += [adapters.route_captures(moved, "routes", "u", 1), adapters.route_captures(gone, "routes", "d", 2)]
    back = spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics")
    return back.select("seq", "topic", *_fact_fields(), _keys(F.json_object_keys("value")).alias("fields"))


@query
def comment_job(spark, sf_dir):
    """The comment job; its JSON rows read back as a table."""
    root = run_dir(spark, "comment-job")
    _write_phase(adapters.change_topic(spark, sf_dir), root, 0, F.lit(True))
    stream = topics.read_topic(spark, path=f"{root}/in/phase=*")
    finish(jobs.publish_comments(stream, root, DATABASE, lambda: tables.dictionary(adapters.ratings(spark))))
    back = topics.read_topic(spark, path=sinks.topic_files(f"{root}/topics", TOPIC_COMMENT), streaming=False)
    schema = "id string, user_id string, sku_id string, appraise string, appraise_name string, comment_txt string, ts bigint"
    return topics.typed(back, schema)


@query
def ods_job(spark, sf_dir):
    """Captures published as the change topic, read back."""
    root = run_dir(spark, "ods-job")
    _write_phase(adapters.capture_topic(spark, sf_dir), root, 0, F.lit(True))
    finish(jobs.publish_captures(topics.read_topic(spark, path=f"{root}/in/phase=*"), root))
    return _change_fields(topics.read_topic(spark, path=f"{root}/{TOPIC_DB}", streaming=False))


@query
def upsert_latest(spark, sf_dir):
    """Orders as a keyed topic: the last order per customer, where a deleted one removes the key."""
    orders = adapters.table(spark, sf_dir, "orders")
    keyed = orders.select(
        F.col("o_custkey").alias("key"),
        F.when(F.col("o_orderstatus") != "P", F.concat_ws(":", "o_orderkey", "o_orderpriority")).alias("value"),
        F.col("o_orderkey").alias("seq"),
    )
    return dims.upsert_latest(keyed)


@query
def window_sink(spark, sf_dir):
    """Keyword windows as a streaming job into the report table, read back; a closing row ends the last windows."""
    root = run_dir(spark, "window-sink")
    topic = adapters.log_topic(spark, sf_dir).select("seq", "value")
    topic.unionByName(topics.closing_row(topic)).write.parquet(f"{root}/in")
    finish(jobs.count_keywords(topics.read_topic(spark, path=f"{root}/in"), root))
    return sinks.read_report(
        spark, f"{root}/keyword_windows", "stt string, edt string, cur_date string, keyword string, keyword_count bigint"
    )


def _both_merges(changed: DataFrame) -> DataFrame:
    """Dimension rows merged by column and by whole row, from one aggregation."""
    merged = [F.struct(F.lit(m).alias("merge"), dims.live_data(m).alias("data")) for m in ("column", "row")]
    rows = dims.reduce_changes(changed).select("sink_table", "row_key", F.inline(F.array(*merged)))
    return _user_fields(rows.filter(F.cardinality("data") > 0), "merge")


def _user_fields(rows: DataFrame, *kept: str) -> DataFrame:
    data = F.col("data")
    return rows.select(
        *kept, "sink_table", "row_key", data["name"].alias("name"), data["login_name"].alias("login_name"),
        _keys(F.map_keys(data)).alias("fields"),
    )


@query
def dim_upsert(spark, sf_dir):
    """The user dimension, merged by column and by whole row."""
    return _both_merges(_user_changes(spark, sf_dir))


@query
def dim_upsert_partitions(spark, sf_dir):
    """As ``dim_upsert`` with changes that came over sixteen partitions of a keyed topic."""
    changed = changes.dim_changes(adapters.partitioned_change_topic(spark, sf_dir), DATABASE)
    return _both_merges(changes.prune_columns(changes.route_dims(changed, routes.dim_routes(spark))))


@query
def dim_job(spark, sf_dir):
    """The dimension job on three parts of the change topic, for a table that is emptied at change 400.

    The second part's routes leave the name out.
    """
    root = run_dir(spark, "dim-job")
    topic = adapters.quoted_change_topic(spark, sf_dir)
    every = routes.dim_routes(spark)
    nameless = every.withColumn("sink_columns", F.replace("sink_columns", F.lit("login_name,name,"), F.lit("login_name,")))
    captured = [adapters.route_captures(every, "routes", "r", 0)]
    read = jobs.live_dim_routes(lambda: reduce(DataFrame.unionByName, captured), "routes")
    for number, at in enumerate((nameless, every, None)):
        _write_phase(topic, root, number, F.expr(f"(seq div 4) % 3 = {number}"))
        finish(jobs.update_dimensions(topics.read_topic(spark, path=f"{root}/in/phase=*"), root, DATABASE, read))
        if at is not None:
            captured.append(adapters.route_captures(at, "routes", "u", 400 if number else 300))
    lifecycle = jobs.live_lifecycle(lambda: reduce(DataFrame.unionByName, captured), "routes")
    return _user_fields(sinks.DimensionTables(spark, f"{root}/dims").rows(lifecycle=lifecycle()))


@query
def dim_delete(spark, sf_dir):
    """Per user key: the last delete, and whether the row lives."""
    reduced = dims.reduce_changes(_user_changes(spark, sf_dir), [])
    return reduced.select(
        "row_key", "deleted_at",
        (F.coalesce(F.col("put_at"), F.lit(-1)) > F.coalesce("deleted_at", F.lit(-1))).alias("alive"),
    )


# Life of the dimension tables: operations on sink tables at places in the order of changes.
LIFECYCLE = [
    (0, "r", "dim_coupon_use"), (400, "u", "dim_coupon_use"),
    (0, "c", "dim_favor_info"), (300, "d", "dim_favor_info"),
    (0, "r", "dim_user_info"), (200, "d", "dim_user_info"), (500, "c", "dim_user_info"), (800, "c", "dim_user_info"),
]


@query
def dim_lifecycle(spark, sf_dir):
    """Changes that count after tables were created, emptied and dropped."""
    changed = changes.dim_changes(adapters.quoted_change_topic(spark, sf_dir), DATABASE)
    written = changed.withColumn("sink_table", F.concat(F.lit("dim_"), "table"))
    config = spark.createDataFrame(LIFECYCLE, "seq bigint, op string, sink_table string")
    kept = dims.apply_lifecycle(written, dims.table_lifecycle(config))
    return kept.select("sink_table", "seq", "type", F.col("data")["id"].alias("id"))


# Filters and reshaping ----------------------------------------------------------------------------------


@query
def log_json_filter(spark, sf_dir):
    kept = logs.json_logs(adapters.log_topic(spark, sf_dir))
    return kept.select("seq", "event_type", long_of(F.col("log"), "ts").alias("ts"))


def _by_table(changed: DataFrame) -> DataFrame:
    return changed.select("seq", F.col("table").alias("source_table"), "type", F.col("data")["id"].alias("id"))


@query
def change_filter_dwd(spark, sf_dir):
    return _by_table(changes.fact_changes(adapters.change_topic(spark, sf_dir), DATABASE))


@query
def change_filter_dim(spark, sf_dir):
    return _by_table(changes.dim_changes(adapters.quoted_change_topic(spark, sf_dir), DATABASE))


@query
def config_current(spark, sf_dir):
    """The routes in force after a history of routing changes."""
    captures = changelog.read_captures(adapters.config_topic(spark, sf_dir))
    return changes.fact_config(captures)


@query
def config_multi_route(spark, sf_dir):
    """As ``config_current`` with every live sink of a source kept."""
    captures = changelog.read_captures(adapters.config_topic(spark, sf_dir))
    return changes.fact_config(captures, multi_route=True)


@query
def column_prune(spark, sf_dir):
    routed = changes.route_facts(
        changes.fact_changes(adapters.change_topic(spark, sf_dir), DATABASE), routes.fact_routes(spark)
    )
    data = F.col("data")
    return changes.prune_columns(routed).select(
        "seq", "sink_table", data["id"].alias("id"), data["order_id"].alias("order_id"), _keys(F.map_keys(data)).alias("fields")
    )


@query
def comment_extract(spark, sf_dir):
    table = topics.change_table(adapters.change_topic(spark, sf_dir))
    return facts.extract_comments(table, DATABASE).drop("et", "pt")


@query
def kw_filter(spark, sf_dir):
    return keywords.search_phrases(_pages(spark, sf_dir)).select("seq", "kw")


@query
def traffic_json(spark, sf_dir):
    """Traffic report lines as JSON, read back."""
    report = traffic.report_json(traffic.traffic_report(_views(spark, sf_dir), "1 hour"))
    line = F.col("line")
    return parse_once(report, F.from_json("value", "map<string,string>"), "line").select(
        *[line[f].alias(f) for f in ("stt", "cur_date", "vc", "ch", "ar", "is_new", "pv_ct")],
        _keys(F.map_keys(line)).alias("fields"),
    )


@query
def debezium_normalize(spark, sf_dir):
    """Captures as change records, through the JSON of the change topic."""
    records = envelope.to_change_records(changelog.read_captures(adapters.capture_topic(spark, sf_dir)))
    return _change_fields(envelope.change_json(records))


def _change_fields(topic: DataFrame) -> DataFrame:
    return topics.typed(topic, CHANGE).select(
        "seq", "database", F.col("table").alias("source_table"), "type", "ts", F.col("data")["id"].alias("id"),
        F.col("data")["name"].alias("name"), _keys(F.map_keys("old")).alias("changed"),
        F.col("old")["name"].alias("old_name"),
    )


# Log branches -------------------------------------------------------------------------------------------


def _records(branch: DataFrame) -> DataFrame:
    rec = F.col("record")
    return branch.select(
        "seq", F.try_variant_get(rec["common"], "$.mid", "string").alias("mid"), long_of(rec, "ts").alias("ts"),
        _keys(F.map_keys(rec)).alias("fields"),
    )


@query
def log_start(spark, sf_dir):
    return _records(logs.start_records(_parsed(spark, sf_dir)))


@query
def log_err(spark, sf_dir):
    return _records(logs.err_records(_parsed(spark, sf_dir)))


@query
def log_page(spark, sf_dir):
    return _records(logs.page_records(_parsed(spark, sf_dir)))


def _element_rows(branch: DataFrame) -> DataFrame:
    rec = F.col("record")
    return branch.select(
        "seq", text_of(rec, "mid").alias("mid"), text_of(rec, "item").alias("item"), long_of(rec, "pos").alias("pos"),
        text_of(rec, "ch").alias("ch"), long_of(rec, "ts").alias("ts"), _keys(F.map_keys(rec)).alias("fields"),
    )


@query
def log_display(spark, sf_dir):
    return _element_rows(logs.display_records(_parsed(spark, sf_dir)))


@query
def log_action(spark, sf_dir):
    return _element_rows(logs.action_records(_parsed(spark, sf_dir)))


@query
def log_fanout(spark, sf_dir):
    """All branches in one pass, with the corrected new-visitor flag inside."""
    return _topic_fields(logs.fan_out(logs.fix_new_visitors(_parsed(spark, sf_dir))))


# Joins --------------------------------------------------------------------------------------------------


@query
def config_route(spark, sf_dir):
    changed = changes.fact_changes(adapters.change_topic(spark, sf_dir), DATABASE)
    routed = changes.route_facts(changed, routes.fact_routes(spark))
    return routed.select("seq", "sink_table", F.col("data")["id"].alias("id"), F.col("data")["order_id"].alias("order_id"))


@query
def config_route_large(spark, sf_dir):
    """Routing by a configuration that grows with the data and is not broadcast."""
    live = changes.fact_config(changelog.read_captures(adapters.config_topic(spark, sf_dir)))
    orders = adapters.table(spark, sf_dir, "orders")
    changed = orders.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("t"), F.col("o_custkey") % 900).alias("table"),
        F.when(F.col("o_orderstatus") == "F", "insert").otherwise("update").alias("type"),
    )
    return changes.route_facts(changed, live, max_broadcast_rows=0).select("seq", "sink_table", "sink_columns")


@query
def dim_route(spark, sf_dir):
    changed = changes.dim_changes(adapters.quoted_change_topic(spark, sf_dir), DATABASE)
    routed = changes.route_dims(changed, routes.dim_routes(spark))
    return routed.select("seq", "sink_table", "row_key", "op_type", F.col("data")["order_id"].alias("order_id"))


@query
def comment_lookup(spark, sf_dir):
    table = topics.change_table(adapters.change_topic(spark, sf_dir))
    dictionary = tables.dictionary(adapters.ratings(spark))
    return facts.lookup_comments(facts.extract_comments(table, DATABASE), dictionary)


@query
def comment_lookup_asof(spark, sf_dir):
    """Comments with the name that their rating had at their time."""
    comments = facts.extract_comments(topics.change_table(adapters.change_topic(spark, sf_dir), watermark=None), DATABASE)
    named = lookup_as_of(comments, adapters.rating_versions(spark, sf_dir), ["appraise"], "ts", "since", "dic", width=30 * 86400)
    return named.select("seq", "id", "appraise", "ts", F.col("dic.dic_name").alias("appraise_name"), F.col("dic.since").alias("since"))


@query
def config_route_late(spark, sf_dir):
    """Facts that come before their routes, the job stopped and resumed between three parts of the input."""
    root = run_dir(spark, "route-late")
    topic = adapters.quoted_change_topic(spark, sf_dir, "o_orderdate")
    plain, at, known = changes.unquoted(topic), F.col("o_orderdate"), routes.fact_routes(spark)
    late = F.col("source_table") == "user_info"
    parts = [at < "1997-01-01", (at >= "1997-01-01") & (at < "1999-01-01"), at >= "1999-01-01"]
    # Milliseconds at which the routes are captured: before the first part and at the start of the second.
    captured = [(known.filter(~late), 788_918_400_000), (known.filter(late), 852_076_800_000)]
    for number, condition in enumerate(parts):
        _write_phase(plain, root, number, condition)
        if number < 2:
            adapters.route_captures(captured[number][0], "table_process_dwd", "c", captured[number][1]).write.parquet(f"{root}/config/phase={number}")
        if number == 2:
            adapters.closing_change(spark).write.parquet(f"{root}/in/phase=closing")
        stream, config = (topics.read_topic(spark, path=f"{root}/{name}/phase=*") for name in ("in", "config"))
        finish(jobs.route_late_facts(stream, config, root, DATABASE, keep_ms=adapters.TEN_YEARS_MS))
    routed = spark.read.schema(held.ROUTED).parquet(f"{root}/routed")
    return routed.select("seq", F.col("table").alias("source_table"), "type", F.get_json_object("value", "$.id").alias("id"), "sink_table")


@query
def dead_counts(spark, sf_dir):
    """Rows and dead letters of each micro-batch, observed while the letters are written."""
    root = run_dir(spark, "dead-counts")
    topic, at = _timed_topic(spark, sf_dir), F.col("at")
    phases = [at < "2024-01-10", (at >= "2024-01-10") & (at < "2024-01-20"), at >= "2024-01-20"]
    for number, condition in enumerate(phases):
        _write_phase(topic, root, number, condition)
        finish(jobs.check_logs(topics.read_topic(spark, path=f"{root}/in/phase=*"), root))
    counts = spark.read.schema("n_rows long, n_dead long, batch_id bigint").parquet(f"{root}/counts")
    letters = spark.read.schema("seq bigint, batch_id bigint").parquet(f"{root}/dead").groupBy("batch_id").agg(F.count("seq").alias("n_letters"))
    return counts.join(letters, "batch_id", "left").select("batch_id", "n_rows", "n_dead", F.coalesce("n_letters", F.lit(0).cast("long")).alias("n_letters"))


@query
def dim_enrich(spark, sf_dir):
    """Every order with the name its customer has in the user dimension, which is not broadcast."""
    dim = dims.upsert(_user_changes(spark, sf_dir), ["login_name", "name"])
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    enriched = dims.enrich(
        orders, dim, F.col("o_custkey").cast("string"), ["login_name", "name"], F.col("o_orderkey"),
        table=None, max_broadcast_rows=0,
    )
    return enriched.select("o_orderkey", "login_name", "name", "matched")


@query
def dim_enrich_tables(spark, sf_dir):
    """As ``dim_enrich`` beside a second table that has the same row keys."""
    users = dims.upsert(_user_changes(spark, sf_dir), ["login_name", "name"])
    other = users.withColumns({"sink_table": F.lit("dim_other"), "data": F.create_map(F.lit("name"), F.col("row_key"))})
    orders = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    enriched = dims.enrich(
        orders, other.unionByName(users), F.col("o_custkey").cast("string"), ["login_name", "name"], F.col("o_orderkey"),
        table="dim_user_info", max_broadcast_rows=0,
    )
    return enriched.select("o_orderkey", "login_name", "name", "matched")


@query
def kw_split(spark, sf_dir):
    return keywords.split_words(keywords.search_phrases(_pages(spark, sf_dir))).select("seq", "keyword")


@query
def kw_split_documents(spark, sf_dir):
    """For each word the number of documents that contain it."""
    documents = adapters.table(spark, sf_dir, "documents").select("text")
    found = keywords.split_words(documents, "text")
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_documents"))


@query
def kw_segment(spark, sf_dir):
    """For each dictionary word the number of texts it is cut from."""
    texts = adapters.han_documents(spark, sf_dir)
    found = segment.segment_words(texts, "doc_id", "text", adapters.han_dictionary(spark, sf_dir))
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_documents"))


@query
def kw_segment_large(spark, sf_dir):
    """As ``kw_segment`` with a dictionary that is joined and not sent to the executors."""
    texts = adapters.han_documents(spark, sf_dir)
    found = segment.segment_words(texts, "doc_id", "text", adapters.han_dictionary(spark, sf_dir), max_words=0)
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_documents"))


@query
def kw_segment_smart(spark, sf_dir):
    """As ``kw_segment`` by the lattice path of fewest words."""
    texts = adapters.han_documents(spark, sf_dir)
    found = segment.segment_words(texts, "doc_id", "text", adapters.han_dictionary(spark, sf_dir), mode="smart")
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_documents"))


# Windows ------------------------------------------------------------------------------------------------


@query
def kw_window(spark, sf_dir):
    """The flagship: log text, page table, search phrases, words, 5-second windows."""
    return keywords.keyword_windows(_pages(spark, sf_dir))


@query
def kw_window_1h(spark, sf_dir):
    return keywords.keyword_windows(_pages(spark, sf_dir), "1 hour")


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.parse_pages(logs.fix_new_visitors(_parsed(spark, sf_dir)))


@query
def traffic_parse(spark, sf_dir):
    return _views(spark, sf_dir)


@query
def uv_sv_flags(spark, sf_dir):
    return traffic.flag_visits(traffic.parse_pages(_parsed(spark, sf_dir))).select("seq", "uv", "sv")


@query
def traffic_window(spark, sf_dir):
    return traffic.traffic_report(_views(spark, sf_dir))


@query
def traffic_window_1h(spark, sf_dir):
    return traffic.traffic_report(_views(spark, sf_dir), "1 hour")


# State and streams --------------------------------------------------------------------------------------


@query
def new_visitor_fix(spark, sf_dir):
    fixed = logs.fix_new_visitors(_parsed(spark, sf_dir))
    return fixed.select("seq", "mid", "is_new", text_of(F.col("common"), "is_new").alias("record_is_new"))


def _write_phase(topic: DataFrame, root: str, phase: int, condition: Column) -> None:
    topic.filter(condition).select("seq", "value").write.parquet(f"{root}/in/phase={phase}")


def _timed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    times_of = adapters.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("ts").alias("at"))
    return adapters.log_topic(spark, sf_dir).join(times_of, "seq")


@query
def watermark_late(spark, sf_dir):
    """Keyword windows of a stream whose last micro-batch is late by days: its rows count nowhere."""
    root = run_dir(spark, "watermark-late")
    topic, at = _timed_topic(spark, sf_dir), F.col("at")
    late = (at >= "2024-01-10") & (at < "2024-01-12")
    phases = [at < "2024-01-10", (at >= "2024-01-12") & (at < "2024-01-25"), at >= "2024-01-25", late]
    for number, condition in enumerate(phases):
        _write_phase(topic, root, number, condition)
        finish(jobs.count_keywords(topics.read_topic(spark, path=f"{root}/in/phase=*"), root, "1 hour"))
    return sinks.read_report(
        spark, f"{root}/keyword_windows", "stt string, edt string, cur_date string, keyword string, keyword_count bigint"
    )


@query
def restart(spark, sf_dir):
    """The log job stopped and resumed between three parts of the input: every visitor's state is kept."""
    root = run_dir(spark, "restart")
    topic, at = _timed_topic(spark, sf_dir), F.col("at")
    phases = [at < "2024-01-10", (at >= "2024-01-10") & (at < "2024-01-20"), at >= "2024-01-20"]
    for number, condition in enumerate(phases):
        _write_phase(topic, root, number, condition)
        finish(jobs.split_logs(topics.read_topic(spark, path=f"{root}/in/phase=*"), root))
    return _topic_fields(spark.read.schema(sinks.TOPIC_ROWS).parquet(f"{root}/topics"))


@query
def visitor_stream(spark, sf_dir):
    """New-visitor flags by keyed state, the job stopped and resumed between three parts that mix all times."""
    root = run_dir(spark, "visitor-stream")
    topic = adapters.log_topic(spark, sf_dir)
    for number in range(3):
        _write_phase(topic, root, number, F.col("seq") % 3 == number)
        rows = visitors.fixed_logs(topics.read_topic(spark, path=f"{root}/in/phase=*")).select("seq", "mid", "is_new")
        finish(run_file_sink(rows, f"{root}/flags", f"{root}/_checkpoints/flags"))
    return spark.read.parquet(f"{root}/flags")


@query
def traffic_job(spark, sf_dir):
    """The traffic job stopped and resumed between three parts: visitors' days, sessions and windows are kept as state."""
    root = run_dir(spark, "traffic-job")
    parsed = logs.parse_logs(adapters.log_topic(spark, sf_dir, dealt=True).select("seq", "value"))
    fixed = logs.fan_out(logs.fix_new_visitors(parsed)).filter(F.col("topic") == TOPIC_PAGE)
    times_of = adapters.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("ts").alias("at"))
    pages, at = stored_topic(fixed.select("seq", "value"), root).join(times_of, "seq"), F.col("at")
    phases = [at < "2024-01-10", (at >= "2024-01-10") & (at < "2024-01-20"), at >= "2024-01-20"]
    for number, condition in enumerate(phases):
        _write_phase(pages, root, number, condition)
        if number == 2:
            topics.closing_row(pages).write.parquet(f"{root}/in/phase=closing")
        finish(jobs.sum_traffic(topics.read_topic(spark, path=f"{root}/in/phase=*"), root))
    report = ", ".join(f"{c} {'bigint' if c.endswith(('_ct', '_sum')) else 'string'}" for c in TRAFFIC_WINDOW)
    return sinks.read_report(spark, f"{root}/traffic_windows", report)


def stored_topic(rows: DataFrame, root: str) -> DataFrame:
    """Topic rows written down once, so that each part is taken from them and not computed anew."""
    rows.write.parquet(f"{root}/pages")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/pages")


# Functions ----------------------------------------------------------------------------------------------


@query
def time_funcs(spark, sf_dir):
    events = adapters.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.lit("event").alias("kind"), F.unix_millis("ts").alias("ms")
    )
    orders = adapters.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.unix_millis("o_orderdate").alias("ms")
    )
    shown = events.unionByName(orders).select(
        "id", "kind", "ms",
        times.ms_to_date("ms").alias("day"),
        times.ms_to_date_time("ms").alias("date_time"),
        times.ms_to_partition("ms").alias("cur_date"),
        F.date_format(times.ms_to_timestamp("ms"), MILLIS).alias("et_ms"),
        F.date_format(times.seconds_to_timestamp(F.expr("ms div 1000")), times.DATE_TIME).alias("et_s"),
    )
    return shown.select(
        "*", times.date_time_to_ms("date_time").alias("date_time_ms"), times.date_to_ms("day").alias("day_ms")
    )
