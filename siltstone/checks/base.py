"""Sources, sinks, schema operators, cleaning and rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.checks.registry import Tables, query
from siltstone.functions import clean
from siltstone.operators import dedup, rules, schema
from siltstone.sources import ingest, readers, sinks
from siltstone.sources.layout import Layout, Source, read_batch
from siltstone.sources.staging import stage, staging_path

# DuckDB spellings of the cleaning functions, for the oracles.
NULLS = "('', 'null', 'NULL', 'None', 'N/A', 'na', 'NA')"


def d_clean(c: str) -> str:
    return f"CASE WHEN trim({c}) IN {NULLS} THEN NULL ELSE trim({c}) END"


def d_long(c: str, kind: str = "BIGINT") -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9\\-]', '', 'g') AS {kind})"


def d_double(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9\\.\\-]', '', 'g') AS DOUBLE)"


def d_bool(c: str, strict: bool = False) -> str:
    other = "NULL" if strict else f"TRY_CAST({c} AS BOOLEAN)"
    return (f"CASE WHEN lower({c}) IN ('true', '1', 'yes') THEN TRUE "
            f"WHEN lower({c}) IN ('false', '0', 'no') THEN FALSE ELSE {other} END")


def d_html(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


def d_issues(*pairs: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs)
    return f"NULLIF(concat_ws('|', {cases}), '')"


TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
D_TIME = "'%Y-%m-%d %H:%M:%S'"


# ---- sources and sinks -------------------------------------------------------

@query("src_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_roundtrip(t: Tables):
    """Customer as CSV and back, with a schema."""
    path = staging_path(t.spark, "customer-csv")
    customer = t.customer
    customer.write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, schema=customer.schema)


@query("src_json_props", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def src_json_props(t: Tables):
    return t.events.select("event_id", readers.parse_json("props", "k int").alias("p")).select("event_id", "p.k")


@query("sink_partitioned_roundtrip", """
    SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1""")
def sink_partitioned_roundtrip(t: Tables):
    path = staging_path(t.spark, "customer-by-segment")
    sinks.write_parquet(t.customer, path, partition_cols=["c_mktsegment"])
    return (readers.read_parquet(t.spark, path).groupBy("c_mktsegment")
            .agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys")))


@query("ingest_bronze", """
    SELECT 'customers' AS source_name, '2024-01-01' AS batch_date, count(*) AS n,
      CAST(sum(c_custkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS no_file FROM customer
    UNION ALL
    SELECT 'parts', '2024-01-01', count(*), CAST(sum(p_partkey) AS BIGINT), 0 FROM part
    UNION ALL
    SELECT 'nations', '2024-01-01', count(*), CAST(sum(n_nationkey) AS BIGINT), 0 FROM nation""")
def ingest_bronze(t: Tables):
    """Raw CSV and JSON files of whole tables through the ingest job, read back from bronze."""
    sources = [
        Source("customers", "customers/batch_date={batch}/*.csv"),
        Source("parts", "parts/batch_date={batch}/*.csv.gz"),
        Source("nations", "nations/batch_date={batch}/*.json", "json", schema="n_nationkey bigint, n_name string, n_regionkey int"),
    ]
    layout = Layout(staging_path(t.spark, "ingest"), sources)
    batch = t.ctx.batch_date

    def raw(source: Source) -> str:
        return layout.raw(source, batch).rsplit("/", 1)[0]

    t.customer.write.option("header", True).csv(raw(sources[0]))
    t.part.write.option("header", True).option("compression", "gzip").csv(raw(sources[1]))
    t.nation.write.json(raw(sources[2]))
    ingest.ingest(t.spark, layout, t.ctx)
    keys = {"customers": "c_custkey", "parts": "p_partkey", "nations": "n_nationkey"}
    return schema.union_all(
        t.spark.read.parquet(layout.bronze(name))
        .groupBy("source_name", F.col("batch_date").cast("string").alias("batch_date"))
        .agg(F.count("*").alias("n"), F.sum(F.col(key).cast("bigint")).alias("keys"),
             F.count_if(F.col("source_file").isNull() | F.col("bronze_ingested_at").isNull()).alias("no_file"))
        for name, key in keys.items())


@query("src_optional_empty", """
    SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'gone', 0""")
def src_optional_empty(t: Tables):
    """A table that is there, and one that is not and counts as an empty one with the same columns."""
    found = {name: readers.read_optional(t.spark, f"{t.path}/{name}.parquet") for name in ("customer", "gone")}
    kind = found["customer"].schema
    return schema.union_all(
        (readers.empty(t.spark, kind) if df is None else df).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        for name, df in found.items())


@query("profile_metadata", """
    SELECT p_partkey, 'part' AS source_name, '2024-01-01 00:00:00' AS ingested FROM part""")
def profile_metadata(t: Tables):
    """The metadata that the profile adds: the time and the source, neither batch nor file."""
    tagged = ingest.with_ingest_metadata(t.part, t.ctx, "part", file_column=None, batch_column=None, time_column="ingestion_ts")
    added = [c for c in tagged.columns if c not in t.part.columns]
    if added != ["ingestion_ts", "source_name"]:
        raise ValueError(f"added {added}")
    return tagged.select("p_partkey", "source_name", F.date_format("ingestion_ts", TIME_TEXT).alias("ingested"))


@query("stamp_columns", """
    SELECT c_custkey, '2024-01-01' AS batch_date, '2024-01-01 00:00:00' AS processed, DATE '2024-01-31' AS last_release FROM customer""")
def stamp_columns(t: Tables):
    """One processing time and batch date for all rows of a run, and the run's own today."""
    return t.customer.select(
        "c_custkey", t.ctx.batch().alias("batch_date"), F.date_format(t.ctx.stamp(), TIME_TEXT).alias("processed"),
        F.date_add(F.lit(t.ctx.today), 30).alias("last_release"))


@query("sink_sized", """
    SELECT 'all' AS output, count(*) AS n, TRUE AS files_fit FROM lineitem
    UNION ALL SELECT 'few', count(*), TRUE FROM lineitem WHERE l_quantity = 1 AND l_linenumber = 7
    UNION ALL SELECT 'skewed', count(*), TRUE FROM lineitem""")
def sink_sized(t: Tables):
    """Files of about the asked size, whether an output is large, small or mostly in one task."""
    measured = stage(t.lineitem, "lineitem")
    outputs = {"all": measured, "few": measured.filter("l_quantity = 1 and l_linenumber = 7"),
               "skewed": measured.repartition(4, F.when(F.col("l_partkey") % 20 > 0, 0).otherwise(F.col("l_partkey")))}
    frames = []
    for name, df in outputs.items():
        path, target = staging_path(t.spark, f"sized-{name}"), 256 * 1024
        sinks.write_sized(df, path, target, sinks.bytes_per_row(measured))
        sizes = sinks.file_bytes(t.spark, path)
        whole = sum(sizes)
        fit = max(sizes, default=0) <= 2 * target and len(sizes) <= 2 + 2 * whole / target
        frames.append(t.spark.read.schema(df.schema).parquet(path).agg(
            F.lit(name).alias("output"), F.count("*").alias("n"), F.lit(fit).alias("files_fit")))
    return schema.union_all(frames)


@query("report_order", """
    SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment, c_nationkey) AS BIGINT) AS place, c_mktsegment, c_nationkey,
      count(*) AS customers FROM customer GROUP BY c_mktsegment, c_nationkey""")
def report_order(t: Tables):
    """A report in one file, in the order that was asked for, read back with the place of each row."""
    path = staging_path(t.spark, "ordered-report")
    counts = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("customers"))
    sinks.write_batch(counts, path, "2024-01-01", num_partitions=1, order=[F.desc("customers"), "c_mktsegment", "c_nationkey"])
    rows = read_batch(t.spark, path, "2024-01-01", row_id=True)
    return rows.select((F.col("_row") + 1).alias("place"), "c_mktsegment", "c_nationkey", "customers")


@query("write_metrics", """
    SELECT 'customer' AS table_name, count(*) AS row_count, count(*) FILTER (c_acctbal < 0) AS flagged FROM customer
    UNION ALL SELECT 'events', count(*), count(*) FILTER (value > 90) FROM events
    UNION ALL SELECT 'none', 0, 0""")
def write_metrics(t: Tables):
    """Counts that the writes themselves have made, read from the table of metrics and not from the data."""
    path, batch = staging_path(t.spark, "metrics"), t.ctx.batch_date
    tables = {"customer": (t.customer, F.col("c_acctbal") < 0), "events": (t.events, F.col("value") > 90),
              "none": (t.region.filter("r_regionkey < 0"), F.col("r_regionkey") > 0)}
    for name, (df, flag) in tables.items():
        sinks.write_measured(df, f"{path}/{name}", batch, f"{path}/_metrics", name, flagged=flag)
    return sinks.written_counts(t.spark, f"{path}/_metrics", batch).select("table_name", "row_count", "flagged")


@query("verify_row_counts", """
    SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""")
def verify_row_counts(t: Tables):
    return sinks.row_counts({n: t.table(n) for n in ("customer", "part", "lineitem", "events")})


@query("sink_batch_overwrite", """
    SELECT '2024-01-01' AS batch_date, count(*) AS n FROM customer WHERE c_custkey % 2 = 1
    UNION ALL SELECT '2024-01-02', count(*) FROM customer
    UNION ALL SELECT 'empty', 0""")
def sink_batch_overwrite(t: Tables):
    """A second batch keeps the first; a re-run replaces its own batch, also by nothing."""
    path = staging_path(t.spark, "batches")
    sinks.write_batch(t.customer, path, "2024-01-01")
    sinks.write_batch(t.customer, path, "2024-01-02")
    sinks.write_batch(t.customer.filter("c_custkey % 2 = 1"), path, "2024-01-01")
    sinks.write_batch(t.customer, path, "2024-01-03")
    sinks.write_batch(t.customer.limit(0), path, "2024-01-03")
    sinks.write_batch(t.customer.limit(0), f"{path}-empty", "2024-01-01")
    batches = (t.spark.read.parquet(path).groupBy(F.col("batch_date").cast("string").alias("batch_date"))
               .agg(F.count("*").alias("n")))
    empty = t.spark.read.parquet(f"{path}-empty").agg(F.lit("empty").alias("batch_date"), F.count("*").alias("n"))
    return batches.unionByName(empty)


@query("publish_tables", """
    SELECT 'gold_parts' AS table_name, count(*) AS row_count FROM part
    UNION ALL SELECT 'gold_customers', count(*) FROM customer""")
def publish_tables(t: Tables):
    path = staging_path(t.spark, "published")
    names = ["gold_parts", "gold_customers"]
    sinks.publish_tables(dict(zip(names, (t.part, t.customer))), path=path)
    return sinks.row_counts(sinks.published(t.spark, names, path=path))


# ---- schema ------------------------------------------------------------------

@query("schema_normalize_names", """
    SELECT c_custkey AS customer_key_id, c_acctbal AS acct_bal, c_mktsegment AS market_segment FROM customer""")
def schema_normalize_names(t: Tables):
    return schema.normalize_names(t.customer.select(
        F.col("c_custkey").alias(" Customer-Key (ID)".replace(" (", "/(")),
        F.col("c_acctbal").alias("Acct.Bal "), F.col("c_mktsegment").alias("Market Segment")))


@query("schema_rename_map", """
    SELECT event_id AS review_id, user_id, event_type AS review_text, value AS votes_up, value AS helpful
    FROM events""")
def schema_rename_map(t: Tables):
    """An old name is renamed only where the new one is free."""
    raw = t.events.select(
        F.col("event_id").alias("recommendationid"), "user_id", F.col("event_type").alias("review"),
        F.col("value").alias("votes_up"), F.col("value").alias("helpful"))
    return schema.rename_present(raw, {
        "recommendationid": "review_id", "review": "review_text", "votes_up": "helpful", "appid": "app_id"})


@query("schema_drop_meta", "SELECT n_nationkey, n_name FROM nation")
def schema_drop_meta(t: Tables):
    tagged = t.nation.select("n_nationkey", "n_name", t.ctx.batch().alias("batch_date"),
                             t.ctx.stamp().alias("bronze_ingested_at"))
    return schema.drop_metadata(tagged)


@query("schema_conform", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS BIGINT) AS p_size,
      CAST(p_size AS DOUBLE) AS size_as_double, TRY_CAST(p_type AS BIGINT) AS type_as_long FROM part""")
def schema_conform(t: Tables):
    target = T.StructType().add("p_partkey", "string").add("p_size", "long").add(
        "size_as_double", "double").add("not_there", "string").add("type_as_long", "long")
    return schema.conform(t.part.select(
        "p_partkey", "p_size", F.col("p_size").alias("size_as_double"), F.col("p_type").alias("type_as_long")), target)


@query("clean_all_strings", f"""
    SELECT src_key, {d_clean('user_id')} AS user_id, {d_clean('products')} AS products,
      {d_clean('reviews')} AS reviews FROM dirty_customer""")
def clean_all_strings(t: Tables):
    return clean.clean_strings(t.fixture("dirty_customer"))


# ---- cleaning ----------------------------------------------------------------

@query("clean_string", f"SELECT app_id, {d_clean('title')} AS title FROM dirty_part")
def clean_string(t: Tables):
    return t.fixture("dirty_part").select("app_id", clean.clean_string(F.col("title")).alias("title"))


@query("clean_long", f"""
    SELECT src_key, {d_long('user_id')} AS user_id, {d_long('products')} AS products,
      CAST(trunc(c_acctbal) AS BIGINT) AS balance
    FROM dirty_customer JOIN customer ON src_key = c_custkey""")
def clean_long(t: Tables):
    """Text is stripped; a double keeps its value instead of losing its point."""
    df = t.fixture("dirty_customer").join(t.customer, F.col("src_key") == F.col("c_custkey"))
    return df.select("src_key", clean.to_long(df, "user_id").alias("user_id"),
                     clean.to_long(df, "products").alias("products"),
                     clean.to_long(df, "c_acctbal").alias("balance"))


@query("clean_int", f"""
    SELECT src_key, {d_long('products', 'INTEGER')} AS products,
      {d_long("concat(reviews, '000000000')", 'INTEGER')} AS too_large FROM dirty_customer""")
def clean_int(t: Tables):
    df = t.fixture("dirty_customer").withColumn("big", F.concat("reviews", F.lit("000000000")))
    return df.select("src_key", clean.to_int(df, "products").alias("products"),
                     clean.to_int(df, "big").alias("too_large"))


@query("clean_double", f"""
    SELECT p_partkey, {d_double("concat('$', CAST(p_size AS VARCHAR), '.5 USD')")} AS price,
      {d_double("concat(p_type, '-')")} AS no_number, p_retailprice FROM part""")
def clean_double(t: Tables):
    df = t.select("""
        SELECT p_partkey, concat('$', CAST(p_size AS STRING), '.5 USD') AS price,
          concat(p_type, '-') AS no_number, p_retailprice FROM {part}""", "part")
    return df.select("p_partkey", *[clean.to_double(df, c).alias(c) for c in df.columns[1:]])


@query("clean_epoch", f"""
    SELECT event_id,
      CASE WHEN event_id % 9 = 0 THEN NULL
           ELSE strftime(make_timestamp(event_id * 86400 * 1000000), {D_TIME}) END AS happened
    FROM events""")
def clean_epoch(t: Tables):
    df = t.select("""
        SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'never'
          ELSE CAST(event_id * 86400 AS STRING) END AS epoch FROM {events}""", "events")
    # Spark writes years beyond 9999 with a sign.
    text = F.date_format(clean.epoch_to_timestamp(F.col("epoch")), TIME_TEXT)
    return df.select("event_id", F.ltrim(text, F.lit("+")).alias("happened"))


@query("clean_html_pages", f"SELECT page_id, {d_html('html')} AS body FROM pages")
def clean_html_pages(t: Tables):
    return t.pages.select("page_id", clean.clean_html(F.col("html")).alias("body"))


@query("clean_bool", f"SELECT src_key, {d_bool('is_recommended')} AS is_recommended FROM dirty_events")
def clean_bool(t: Tables):
    return t.fixture("dirty_events").select(
        "src_key", clean.to_boolean(F.col("is_recommended")).alias("is_recommended"))


@query("clean_bool_strict", f"SELECT appid, votes_up, {d_bool('voted_up', True)} AS voted_up FROM item_reviews")
def clean_bool_strict(t: Tables):
    return t.fixture("item_reviews").select(
        "appid", "votes_up", clean.to_boolean(F.col("voted_up"), strict=True).alias("voted_up"))


@query("clean_flag", """
    SELECT app_id, CASE WHEN TRY_CAST(is_free AS INTEGER) = 1 THEN TRUE
      WHEN TRY_CAST(is_free AS INTEGER) = 0 THEN FALSE ELSE TRY_CAST(is_free AS BOOLEAN) END AS is_free
    FROM dirty_part""")
def clean_flag(t: Tables):
    df = t.fixture("dirty_part")
    return df.select("app_id", clean.flag_to_boolean(df, "is_free").alias("is_free"))


@query("clean_timestamp", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL
      ELSE strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 90 MINUTE, {D_TIME}) END AS from_text,
      strftime(make_timestamp(o_orderkey * 1000000), {D_TIME}) AS from_number,
      strftime(o_orderdate, {D_TIME}) AS from_time
    FROM orders""")
def clean_timestamp(t: Tables):
    df = t.select("""
        SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'soon'
          ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 01:30:00') END AS from_text,
          o_orderkey AS from_number, o_orderdate AS from_time FROM {orders}""", "orders")
    return df.select("o_orderkey", *[
        F.date_format(clean.to_timestamp(df, c), TIME_TEXT).alias(c) for c in df.columns[1:]])


@query("clean_date", """
    SELECT app_id, CAST(TRY_CAST(date_release AS DATE) AS VARCHAR) AS date_release FROM dirty_part""")
def clean_date(t: Tables):
    return t.fixture("dirty_part").select(
        "app_id", clean.to_date(F.col("date_release")).cast("string").alias("date_release"))


@query("clean_ancient_ts", f"""
    SELECT src_key, CASE WHEN timestamp_created >= TIMESTAMP '1900-01-01 00:00:00'
        THEN strftime(timestamp_created, {D_TIME}) END AS created,
      {d_issues(('ancient_timestamp_created', "timestamp_created < TIMESTAMP '1900-01-01 00:00:00'"))} AS quality_issue
    FROM dirty_events""")
def clean_ancient_ts(t: Tables):
    """The rule sees the time before it is nulled."""
    oldest = F.to_timestamp(F.lit("1900-01-01 00:00:00"))
    judged = rules.annotate(t.fixture("dirty_events"), [
        rules.earlier_than("timestamp_created", oldest, "ancient_timestamp_created")])
    kept = F.when(F.col("timestamp_created") >= oldest, F.col("timestamp_created"))
    return judged.select("src_key", F.date_format(kept, TIME_TEXT).alias("created"),
                         rules.as_text(F.col(rules.ISSUES)).alias("quality_issue"))


@query("text_length_features", """
    SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, CAST(length(lang) AS INTEGER) AS lang_length
    FROM documents""")
def text_length_features(t: Tables):
    return t.documents.select("doc_id", F.length("text").alias("text_length"), F.length("lang").alias("lang_length"))


@query("coalesce_candidates", f"""
    SELECT app_id, coalesce({d_clean('title')}, p_brand) AS game_name
    FROM dirty_part JOIN part ON app_id = p_partkey""")
def coalesce_candidates(t: Tables):
    """A candidate column that does not exist is passed over."""
    names = t.part.select(F.col("p_partkey").alias("app_id"), F.col("p_brand").alias("store_name"))
    df = clean.clean_strings(t.fixture("dirty_part")).join(names, "app_id")
    return df.select("app_id", clean.first_present(df, ["title", "other", "store_name"]).alias("game_name"))


# ---- rules -------------------------------------------------------------------

CUSTOMER_RULES = [
    ("missing_user_id", "user_id IS NULL"),
    ("negative_products", "products < 0"),
    ("hard_limit_exceeded_products", "products > 10000000"),
    ("negative_reviews", "reviews < 0"),
]
CLEAN_CUSTOMER = f"""clean_customer AS (
    SELECT src_key, {d_long(d_clean('user_id'))} AS user_id, {d_long(d_clean('products'), 'INTEGER')} AS products,
      {d_long(d_clean('reviews'), 'INTEGER')} AS reviews FROM dirty_customer)"""


def clean_customer(t: Tables):
    df = clean.clean_strings(t.fixture("dirty_customer"))
    return df.select("src_key", clean.to_long(df, "user_id").alias("user_id"),
                     *[clean.to_int(df, c).alias(c) for c in ("products", "reviews")])


def customer_rules():
    return [
        rules.not_null("user_id", "missing_user_id"), rules.non_negative("products"),
        rules.upper_limit("products", 10_000_000), rules.non_negative("reviews", hard=False)]


def issue_query(name: str, pairs, cte: str, source: str, key: str, build):
    """Register a rule check: key and issue text of every row of a fixture."""
    @query(name, f"WITH {cte}SELECT {key}, {d_issues(*pairs)} AS quality_issue FROM {source}"
           if cte else f"SELECT {key}, {d_issues(*pairs)} AS quality_issue FROM {source}")
    def run(t: Tables):
        df, rule_set = build(t)
        return rules.annotate(df, rule_set).select(key, rules.as_text(F.col(rules.ISSUES)).alias("quality_issue"))
    run.__name__ = name


issue_query("rules_append_all", CUSTOMER_RULES, CLEAN_CUSTOMER + " ", "clean_customer", "src_key",
            lambda t: (clean_customer(t), customer_rules()))
issue_query("rule_not_null", CUSTOMER_RULES[:1], CLEAN_CUSTOMER + " ", "clean_customer", "src_key",
            lambda t: (clean_customer(t), [rules.not_null("user_id", "missing_user_id")]))
issue_query("rule_non_negative", [("negative_hours", "hours < 0")], "", "dirty_events", "src_key",
            lambda t: (t.fixture("dirty_events"), [rules.non_negative("hours")]))
issue_query("rule_range", [("invalid_weighted_vote_score", "weighted_vote_score < 0 OR weighted_vote_score > 1"),
                           ("invalid_range_hours", "hours > 400")], "", "dirty_events", "src_key",
            lambda t: (t.fixture("dirty_events"), [
                rules.in_range("weighted_vote_score", 0.0, 1.0, "invalid_weighted_vote_score"),
                rules.in_range("hours", high=400.0)]))
issue_query("rule_upper_limit", CUSTOMER_RULES[2:3], CLEAN_CUSTOMER + " ", "clean_customer", "src_key",
            lambda t: (clean_customer(t), [rules.upper_limit("products", 10_000_000)]))
issue_query("rule_empty_text", [("empty_review_text", "review_text IS NULL OR length(trim(review_text)) = 0")],
            "", "dirty_events", "src_key",
            lambda t: (t.fixture("dirty_events"), [rules.empty_text("review_text", "empty_review_text")]))
issue_query("rule_all_empty", [("all_text_fields_empty", "(title IS NULL OR title = '') AND (note IS NULL OR note = '')")],
            f"""noted AS (SELECT app_id, {d_clean('title')} AS title,
                  CASE WHEN app_id % 2 = 0 THEN '' ELSE is_free END AS note FROM dirty_part) """, "noted", "app_id",
            lambda t: (clean.clean_strings(t.fixture("dirty_part")).withColumn(
                "note", F.when(F.col("app_id") % 2 == 0, F.lit("")).otherwise(F.col("is_free"))),
                [rules.all_empty(["title", "note"], "all_text_fields_empty")]))
issue_query("rule_invalid_bool", [("invalid_boolean_is_recommended", f"({d_bool('is_recommended')}) IS NULL")],
            "", "dirty_events", "src_key",
            lambda t: (t.fixture("dirty_events").withColumn(
                "is_recommended", clean.to_boolean(F.col("is_recommended"))),
                [rules.invalid_boolean("is_recommended")]))
issue_query("rule_future_date", [("release_date_too_far_in_future",
                                  "TRY_CAST(date_release AS DATE) > DATE '2024-01-31'")],
            "", "dirty_part", "app_id",
            lambda t: (t.fixture("dirty_part").withColumn("date_release", clean.to_date(F.col("date_release"))),
                       [rules.too_far_ahead("date_release", t.ctx.today, 30, "release_date_too_far_in_future")]))
issue_query("rule_missing_column", [("missing_user_id_column", "TRUE")], "", "part", "p_partkey",
            lambda t: (t.part, rules.column_exists(t.part, "user_id")))


@query("rule_ts_order", f"""
    SELECT l_orderkey, l_linenumber, {d_issues(('shipped_before_order', 'l_shipdate < o_orderdate'))} AS quality_issue
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def rule_ts_order(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    # An order has a handful of lines: no key is hot, so the lines are read once.
    judged = rules.annotate(lines.join(orders, "l_orderkey", "left"), [
        rules.time_order("o_orderdate", "l_shipdate", "shipped_before_order")])
    return judged.select("l_orderkey", "l_linenumber", rules.as_text(F.col(rules.ISSUES)).alias("quality_issue"))


@query("rules_first_wins", f"""WITH {CLEAN_CUSTOMER} SELECT src_key,
    CASE {' '.join(f"WHEN {c} THEN '{n}'" for n, c in CUSTOMER_RULES)} END AS quality_issue FROM clean_customer""")
def rules_first_wins(t: Tables):
    return clean_customer(t).select("src_key", rules.first_issue(customer_rules()).alias("quality_issue"))


@query("split_valid", f"""WITH {CLEAN_CUSTOMER} SELECT src_key, user_id, products, reviews FROM clean_customer
    WHERE {d_issues(*CUSTOMER_RULES)} IS NULL""")
def split_valid(t: Tables):
    return rules.annotate(clean_customer(t), customer_rules()).filter(rules.is_valid()).drop(rules.ISSUES)


@query("split_rejected", f"""WITH {CLEAN_CUSTOMER} SELECT src_key, {d_issues(*CUSTOMER_RULES)} AS quality_issue
    FROM clean_customer WHERE {d_issues(*CUSTOMER_RULES)} IS NOT NULL""")
def split_rejected(t: Tables):
    judged = rules.annotate(clean_customer(t), customer_rules()).filter(~rules.is_valid())
    return judged.select("src_key", rules.as_text(F.col(rules.ISSUES)).alias("quality_issue"))


@query("split_hard_soft", f"""WITH {CLEAN_CUSTOMER} SELECT src_key, {d_issues(*CUSTOMER_RULES)} AS quality_issue,
    coalesce({' OR '.join(f'coalesce({c}, FALSE)' for _, c in CUSTOMER_RULES[:3])}, FALSE) AS rejected
    FROM clean_customer""")
def split_hard_soft(t: Tables):
    """Soft issues stay on valid rows; only a hard one rejects."""
    rule_set = customer_rules()
    return rules.annotate(clean_customer(t), rule_set).select(
        "src_key", rules.as_text(F.col(rules.ISSUES)).alias("quality_issue"),
        rules.is_rejected(rule_set).alias("rejected"))


@query("dup_reject_all", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicate FROM lineitem""")
def dup_reject_all(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dedup.mark_all_copies(lines, ["l_orderkey", "l_linenumber"])


@query("dup_reject_rest", f"""WITH {CLEAN_CUSTOMER} SELECT src_key, user_id,
    user_id IS NOT NULL AND row_number() OVER (PARTITION BY user_id ORDER BY src_key) > 1 AS is_duplicate
    FROM clean_customer""")
def dup_reject_rest(t: Tables):
    return dedup.mark_later_copies(clean_customer(t).select("src_key", "user_id"), ["user_id"], ["src_key"])


@query("dedup_keep_first", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_first(t: Tables):
    """By the values first and the file position then, so that the winners are fetched by keys and order alone."""
    lines = readers.with_row_id(t.lineitem).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", *readers.ROW_ID)
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", *readers.ROW_ID]
    return dedup.keep_first(lines, ["l_orderkey", "l_linenumber"], order, unique=True).drop(*readers.ROW_ID)
