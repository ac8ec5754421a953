"""Queries over the driver's tables, one or more for every operator, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import places, scalars, tokens
from siltbed.operators import reconcile as rc
from siltbed.operators import scan_range, sink, ttl
from siltbed.operators.shared import new_folder
from siltbed.plans.loader import load_table
from siltbed.plans.views import CELLS_SQL, NOW, event_cells, line_cells, table
from siltbed.sources.sstable.datasource import File, describe_files, find_files, read_files
from siltbed.sources.sstable.writer import Layout, write_sstables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_COLUMNS = ["key", "name", "ts", "value", "expires_at"]


def query(sql: str | None = None, cells: bool = False):
    """Register a function under its name; sql may use the common table expressions over events if ``cells``."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = (f"WITH {CELLS_SQL} " if cells else "") + sql
        return f

    return add


def _winners(spark: SparkSession, d: str) -> DataFrame:
    return rc.latest(event_cells(spark, d))


@query("SELECT src, key, name, ts, deleted, ttl, expires_at, value, pos FROM e", cells=True)
def q01_cells_scan(spark, d):
    return event_cells(spark, d).where("kind = 'cell'").select("src", "key", "name", "ts", "deleted", "ttl", "expires_at", "value", "pos")


_LWW = "SELECT key, name, ts, deleted, value, expires_at FROM w"


@query(_LWW, cells=True)
def q02_lww(spark, d):
    return _winners(spark, d).select("key", "name", "ts", "deleted", "value", "expires_at")


@query(_LWW, cells=True)
def q03_lww_window(spark, d):
    return rc.latest_by_window(event_cells(spark, d)).select("key", "name", "ts", "deleted", "value", "expires_at")


@query("SELECT key, name, ts, value, expires_at FROM live", cells=True)
def q04_cell_tombstone(spark, d):
    return rc.live_cells(_winners(spark, d)).select(*_COLUMNS)


@query("SELECT l.key, l.name, l.ts, l.value, l.expires_at FROM live l LEFT JOIN pd ON l.key = pd.key WHERE pd.del_ts IS NULL OR pd.del_ts < l.ts", cells=True)
def q05_partition_tombstone(spark, d):
    return rc.drop_deleted_rows(rc.live_cells(_winners(spark, d)), rc.deletions(event_cells(spark, d))).select(*_COLUMNS)


_RANGES = "SELECT key, name, ts, value, expires_at FROM live l WHERE NOT EXISTS (SELECT 1 FROM rt WHERE rt.key = l.key AND l.name BETWEEN rt.lo AND rt.hi AND l.ts <= rt.rts)"


@query(_RANGES, cells=True)
def q06_range_tombstone_anti(spark, d):
    return rc.drop_covered(rc.live_cells(_winners(spark, d)), rc.ranges(event_cells(spark, d))).select(*_COLUMNS)


@query(_RANGES, cells=True)
def q07_range_tombstone_exists(spark, d):
    return rc.drop_covered_by_arrays(rc.live_cells(_winners(spark, d)), rc.ranges(event_cells(spark, d))).select(*_COLUMNS)


_MERGED = "SELECT key, name, ts, value, expires_at FROM merged"


@query(_MERGED, cells=True)
def q08_merge_full(spark, d):
    return rc.exploded(rc.reconcile(event_cells(spark, d))).select(*_COLUMNS)


@query(_MERGED, cells=True)
def q08_merge_by_joins(spark, d):
    return rc.merge(event_cells(spark, d)).select(*_COLUMNS)


@query("SELECT k.key, coalesce(string_agg(m.name || '=' || CAST(m.ts AS VARCHAR), ',' ORDER BY m.name), '') AS columns FROM kept k LEFT JOIN merged m ON k.key = m.key GROUP BY k.key", cells=True)
def q09_row_assembly(spark, d):
    text = F.array_join(F.transform("columns", lambda c: F.concat(c["name"], F.lit("="), c["ts"].cast("string"))), ",")
    return rc.reconcile(event_cells(spark, d)).select("key", text.alias("columns"))


@query("SELECT k.key, CAST(k.n AS BIGINT) AS n_columns, pd.del_ts IS NOT NULL AS has_deletion FROM kept k LEFT JOIN pd ON k.key = pd.key", cells=True)
def q10_empty_rows(spark, d):
    rows = rc.reconcile(event_cells(spark, d))
    return rows.select("key", F.size("columns").cast("long").alias("n_columns"), F.col("del_ts").isNotNull().alias("has_deletion"))


@query("SELECT key, CAST(latest AS BIGINT) AS expiry FROM fold", cells=True)
def q11_expiry_latest(spark, d):
    return rc.reconcile(event_cells(spark, d)).select("key", ttl.expiry(mode="latest").cast("long").alias("expiry"))


@query("SELECT key, CAST(nearest AS BIGINT) AS expiry FROM fold", cells=True)
def q12_expiry_nearest(spark, d):
    return rc.reconcile(event_cells(spark, d)).select("key", ttl.expiry(mode="nearest").cast("long").alias("expiry"))


@query("SELECT key, CASE WHEN bool_or(expires_at IS NULL) THEN NULL ELSE max(expires_at) END AS expiry FROM merged GROUP BY key", cells=True)
def q12_expiry_by_aggregate(spark, d):
    return ttl.fold_expiry(rc.merge(event_cells(spark, d)))


@query(f"SELECT key, t.min_ttl, CAST(latest AS BIGINT) AS expiry FROM fold, (VALUES (1), (86400), (864000)) t(min_ttl) WHERE latest IS NULL OR latest >= {NOW} + t.min_ttl", cells=True)
def q13_min_ttl_filter(spark, d):
    folded = rc.reconcile(event_cells(spark, d)).select("key", ttl.expiry().cast("long").alias("expiry"))
    limits = F.explode(F.array_compact(F.array(*[F.when(ttl.is_alive("expiry", NOW, x), F.lit(x)) for x in (1, 86400, 864000)])))
    return folded.select("key", limits.alias("min_ttl"), "expiry")


@query(f"SELECT key, CAST(coalesce(latest - {NOW}, -1) AS BIGINT) AS ttl FROM fold WHERE latest IS NULL OR latest >= {NOW} + 1", cells=True)
def q14_eternal_default(spark, d):
    folded = rc.reconcile(event_cells(spark, d)).select("key", ttl.expiry().cast("long").alias("expiry"))
    return folded.where(ttl.is_alive("expiry", NOW)).select("key", scalars.remaining_ttl("expiry", NOW, -1).alias("ttl"))


_TOKEN = """lower(lpad(hex(CASE WHEN x < 170141183460469231731687303715884105728::uhugeint THEN x
 ELSE 340282366920938463463374607431768211455::uhugeint - x + 1::uhugeint END), 32, '0'))"""
_ORDERS = f"o AS (SELECT key, {_TOKEN} AS token FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST('0x' || md5(CAST(o_orderkey AS VARCHAR)) AS uhugeint) AS x FROM orders))"


def _order_keys(spark, d) -> DataFrame:
    keys = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    return keys.withColumn("token", tokens.random_token("key"))


@query(f"WITH {_ORDERS} SELECT key, token FROM o")
def q15_random_token(spark, d):
    return _order_keys(spark, d)


@query(f"WITH {_ORDERS} SELECT key, token, row_number() OVER (ORDER BY token, key) AS ordinal FROM o")
def q16_token_order(spark, d):
    return scan_range.ordinals(_order_keys(spark, d), ["token", "key"])


def _start(key: str):
    return tokens.random_token(F.lit(key)), F.lit(key)


@query(f"WITH {_ORDERS} SELECT key, token FROM o WHERE (token, key) >= (SELECT (token, key) FROM o WHERE key = '7')")
def q17_seek_from_key(spark, d):
    return scan_range.seek(_order_keys(spark, d), *_start("7"))


@query(f"WITH {_ORDERS} SELECT token, key FROM o WHERE (token, key) > (SELECT (token, key) FROM o WHERE key = '7') ORDER BY token, key LIMIT 1")
def q18_next_key(spark, d):
    return scan_range.next_key(_order_keys(spark, d), *_start("7"))


@query(f"WITH {_ORDERS}, s AS (SELECT (token, key) AS start_at FROM o WHERE key = '7') SELECT count(*) FILTER (WHERE (token, key) < (SELECT start_at FROM s)) AS n_before, count(*) FILTER (WHERE (token, key) >= (SELECT start_at FROM s)) AS n_after, count(*) AS n_all, count(DISTINCT key) AS n_keys FROM o")
def q19_resume_union(spark, d):
    keys = _order_keys(spark, d)
    after = scan_range.at_or_after(F.col("token"), F.col("key"), *_start("7"))
    return keys.agg(F.count_if(~after).alias("n_before"), F.count_if(after).alias("n_after"), F.count(F.lit(1)).alias("n_all"), F.count_distinct("key").alias("n_keys"))


def _load(spark, d) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"))
    return orders, orders.where("key % 2 = 0").select("key")


@query("SELECT o_orderkey AS key, o_totalprice AS value FROM orders WHERE o_orderkey % 2 <> 0")
def q20_insert_if_absent(spark, d):
    return sink.insert_if_absent(*_load(spark, d), ["key"])


@query("SELECT count(*) AS n_existing FROM orders WHERE o_orderkey % 2 = 0")
def q21_existing_count(spark, d):
    return sink.existing(*_load(spark, d), ["key"]).agg(F.count(F.lit(1)).alias("n_existing"))


_STATUS = f"""st AS (SELECT k.key, CASE WHEN pd.del_ts IS NOT NULL AND f.key IS NULL THEN 'skipped' WHEN NOT (latest IS NULL OR latest >= {NOW} + 1) THEN 'expired'
  WHEN k.key % 3 = 0 THEN 'existing' WHEN k.key % 7 = 0 THEN 'failed' ELSE 'exported' END AS status
  FROM keys k LEFT JOIN pd ON k.key = pd.key LEFT JOIN fold f ON k.key = f.key)"""


def _statuses(spark, d) -> DataFrame:
    rows = rc.reconcile(event_cells(spark, d), keep_deleted=True).withColumn("expiry", ttl.expiry())
    there = table(spark, d, "events").select(F.col("user_id").alias("key")).where("key % 3 = 0")
    skipped = F.col("del_ts").isNotNull() & (F.size("columns") == 0)
    return sink.with_status(rows, there, ["key"], skipped, ttl.is_alive("expiry", NOW), F.col("key") % 7 == 0)


@query(f"SELECT {', '.join(f'''CAST(count(*) FILTER (WHERE status = '{s}') AS BIGINT) AS {s}''' for s in sink.STATUSES)} FROM ({_STATUS[7:-1]})", cells=True)
def q22_run_summary(spark, d):
    return sink.summary(_statuses(spark, d))


@query(f"SELECT min(key) AS key, min(key) AS ordinal FROM ({_STATUS[7:-1]}) WHERE status = 'failed' HAVING min(key) IS NOT NULL", cells=True)
def q23_first_unsent(spark, d):
    return sink.first_unsent(_statuses(spark, d).withColumn("ordinal", F.col("key")))


def _props(spark, d) -> DataFrame:
    """Event ids and bytes, of which every fifth ends with one that isn't printable."""
    e = table(spark, d, "events").select("event_id", F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("t"))
    return e.select("event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.col("t"), F.lit("\t"))).otherwise(F.col("t")).cast("binary").alias("b"))


_PROPS = "p AS (SELECT event_id, event_type || ':' || CAST(user_id AS VARCHAR) || CASE WHEN event_id % 5 = 0 THEN chr(9) ELSE '' END AS t FROM events)"


@query(f"WITH {_PROPS} SELECT event_id, lower(hex(encode(t))) AS hex FROM p")
def q24_hex(spark, d):
    return _props(spark, d).select("event_id", scalars.to_hex("b").alias("hex"))


@query(f"WITH {_PROPS} SELECT event_id, NOT regexp_matches(t, '[^ -~]') AS printable FROM p")
def q25_printable(spark, d):
    return _props(spark, d).select("event_id", scalars.is_printable("b").alias("printable"))


@query(f"WITH {_PROPS} SELECT event_id, CASE WHEN regexp_matches(t, '[^ -~]') THEN lower(hex(encode(t))) ELSE t END AS shown FROM p")
def q26_display(spark, d):
    return _props(spark, d).select("event_id", scalars.display("b").alias("shown"))


@query(f"WITH {_PROPS} SELECT event_id, t AS decoded FROM p")
def q27_hex_decode(spark, d):
    return _props(spark, d).select("event_id", scalars.from_hex(scalars.to_hex("b")).cast("string").alias("decoded"))


@query("SELECT CAST(pos % 7 AS INTEGER) AS source, min(CAST(ts AS BIGINT)) AS first_ts, CAST(row_number() OVER (ORDER BY min(ts), pos % 7) - 1 AS INTEGER) AS src FROM e GROUP BY pos % 7", cells=True)
def q28_src_order(spark, d):
    cells = event_cells(spark, d).where("kind = 'cell'").select((F.col("pos") % 7).cast("int").alias("source"), F.col("ts").alias("token"), "key")
    return scan_range.source_order(cells).select("source", F.col("first_token").alias("first_ts"), "src")


@query("SELECT key, name, ts, src, value FROM w", cells=True)
def q29_nway_outer(spark, d):
    cells = event_cells(spark, d)
    return rc.merge_two_by_two([cells.where(F.col("src") == i) for i in range(3)])


@query("SELECT count(DISTINCT event_type) AS n_types, count(DISTINCT user_id % 1) = 1 AS consistent FROM events")
def q30_source_consistency(spark, d):
    e = table(spark, d, "events").select("event_type", (F.col("user_id") % 1).alias("part"))
    return e.agg(F.count_distinct("event_type").alias("n_types"), (F.count_distinct("part") == 1).alias("consistent"))


_NAMES = """n AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '/data/ks' || s_suppkey || '/tbl-' || s_suppkey || '/mc-' || s_suppkey || '-big-Data.db'
  WHEN 1 THEN '/data/x/ks-tbl' || s_suppkey || '-jb-' || s_suppkey || '-Data.db' WHEN 2 THEN '/data/x/ks-tbl' || s_suppkey || '-d-1-Data.db'
  WHEN 3 THEN '/data/x/zz-tbl-ka-' || s_suppkey || '-Data.db' ELSE '/data/x/readme.txt' END AS path FROM supplier),
m AS (SELECT s_suppkey, path, string_split(path, '/') AS ps, regexp_extract(string_split(path, '/')[-1], '^([l-z][a-z])-[0-9a-z_]+-[a-z]+-Data\\.db$', 1) AS nv,
  regexp_extract(string_split(path, '/')[-1], '^([^-]+)-([^-]+)-([a-z][a-z]|[a-d])-[0-9a-z_]+-Data\\.db$', 1) AS ok,
  regexp_extract(string_split(path, '/')[-1], '^([^-]+)-([^-]+)-([a-z][a-z]|[a-d])-[0-9a-z_]+-Data\\.db$', 2) AS ot,
  regexp_extract(string_split(path, '/')[-1], '^([^-]+)-([^-]+)-([a-z][a-z]|[a-d])-[0-9a-z_]+-Data\\.db$', 3) AS ov FROM n)"""


@query(
    f"""WITH {_NAMES}, v AS (SELECT *, CASE WHEN nv <> '' THEN nv ELSE ov END AS vv FROM m)
SELECT s_suppkey, CASE WHEN vv = '' THEN NULL ELSE CAST((ascii(vv) - 97) * 26 + CASE WHEN length(vv) > 1 THEN ascii(substr(vv, 2, 1)) - 97 ELSE 0 END AS INTEGER) END AS version,
  CASE WHEN nv <> '' THEN ps[-3] WHEN ok <> '' THEN ok END AS keyspace, CASE WHEN nv <> '' THEN ps[-2] WHEN ot <> '' THEN ot END AS "table" FROM v"""
)
def q31_name_parse(spark, d):
    k = F.col("s_suppkey").cast("string")
    s = F.col("s_suppkey") % 5
    path = (
        F.when(s == 0, F.concat(F.lit("/data/ks"), k, F.lit("/tbl-"), k, F.lit("/mc-"), k, F.lit("-big-Data.db")))
        .when(s == 1, F.concat(F.lit("/data/x/ks-tbl"), k, F.lit("-jb-"), k, F.lit("-Data.db")))
        .when(s == 2, F.concat(F.lit("/data/x/ks-tbl"), k, F.lit("-d-1-Data.db")))
        .when(s == 3, F.concat(F.lit("/data/x/zz-tbl-ka-"), k, F.lit("-Data.db")))
        .otherwise("/data/x/readme.txt")
    )
    paths = table(spark, d, "supplier").select("s_suppkey", path.alias("path"))
    name = F.element_at(F.split("path", "/"), -1)
    return paths.select("s_suppkey", scalars.file_version(name).alias("version"), scalars.file_keyspace("path").alias("keyspace"), scalars.file_table("path").alias("table"))


@query()
def q32_murmur_token(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    return keys.withColumn("token", tokens.murmur_token("key"))


@query("SELECT k.key, CAST(k.key AS VARCHAR) || ':' || coalesce(string_agg(chr(10) || m.name || '=' || CAST(m.ts AS VARCHAR) || CASE WHEN m.expires_at IS NULL THEN '' ELSE ' (timeout=' || CAST(m.expires_at AS VARCHAR) || ')' END, '' ORDER BY m.name), '') AS text FROM kept k LEFT JOIN merged m ON k.key = m.key GROUP BY k.key", cells=True)
def q33_dry_run_text(spark, d):
    rows = rc.reconcile(event_cells(spark, d))
    shown = F.transform("columns", lambda c: F.struct(c["name"].alias("name"), c["ts"].cast("string").cast("binary").alias("value"), c["expires_at"].alias("expires_at")))
    return rows.select("key", sink.record_text(F.col("key").cast("string").cast("binary"), shown).alias("text"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, row_number() OVER (ORDER BY encode(CAST(c_custkey AS VARCHAR))) AS ordinal FROM customer")
def q34_byte_order(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key")).withColumn("b", F.encode("key", "utf-8"))
    return scan_range.ordinals(keys, ["b"]).select("key", "ordinal")


@query("SELECT l_orderkey AS key, l_linenumber AS name, epoch_us(l_shipdate) AS ts, l_quantity AS value FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1")
def q35_wide_lww(spark, d):
    return rc.latest(line_cells(spark, d), kept=("ts", "value"))


@query("SELECT l_orderkey AS key, count(*) AS n_columns, max(ts) AS newest FROM (SELECT l_orderkey, epoch_us(l_shipdate) AS ts FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1) GROUP BY 1")
def q36_wide_rows(spark, d):
    w = rc.latest(line_cells(spark, d), kept=("ts", "value"))
    return w.groupBy("key").agg(F.count(F.lit(1)).alias("n_columns"), F.max("ts").alias("newest"))


@query(f"SELECT k.key, m.name, m.value, CAST(coalesce(f.latest - {NOW}, 0) AS BIGINT) AS ttl FROM kept k JOIN fold f ON k.key = f.key JOIN merged m ON m.key = k.key WHERE (f.latest IS NULL OR f.latest >= {NOW} + 1) AND k.key % 3 <> 0", cells=True)
def q37_load_records(spark, d):
    """What a whole load writes: reconcile, expire, leave out what is there, bins."""
    s = _statuses(spark, d).where("status in ('exported', 'failed')")
    recs = s.select("key", sink.bins().alias("bins"), scalars.remaining_ttl("expiry", NOW, 0).alias("ttl"))
    return recs.select("key", F.explode("bins").alias("name", "value"), "ttl")


@query(f"WITH {_PROPS} SELECT event_id, CASE WHEN regexp_matches(t, '[^ -~]') THEN '-S ' || lower(hex(encode(t))) ELSE '-s ' || t END AS hint FROM p")
def q38_resume_hint(spark, d):
    return _props(spark, d).select("event_id", sink.resume_hint("b").alias("hint"))


@query("SELECT s_suppkey, 'host' || s_suppkey AS host, CASE WHEN s_suppkey % 2 = 0 THEN CAST(4000 + s_suppkey AS INTEGER) ELSE 3000 END AS port FROM supplier")
def q39_hosts(spark, d):
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("host"), k, F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit(":"), (F.col("s_suppkey") + 4000).cast("string"))).otherwise(""))
    return table(spark, d, "supplier").select("s_suppkey", scalars.host_and_port(text).alias("h")).select("s_suppkey", "h.host", "h.port")


@query("SELECT event_type AS source, CAST(sum(length(props)) AS BIGINT) AS bytes, count(*) AS n FROM events GROUP BY event_type")
def q40_sizes(spark, d):
    e = table(spark, d, "events").select("event_type", "props")
    return e.groupBy(F.col("event_type").alias("source")).agg(F.sum(F.length("props")).alias("bytes"), F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT event_id % 3 AS src, coalesce(list_sort(list(DISTINCT event_type) FILTER (event_type IS NOT NULL)), []) AS types FROM events WHERE event_id IS NOT NULL GROUP BY 1)
SELECT CAST(src AS INTEGER) AS src, len(types) AS n_types, types = (SELECT arg_min(types, src) FROM s) AS consistent FROM s""")
def q41_source_verdicts(spark, d):
    """For each source, whether it has the event types of the first one. q30 asks of user_id % 1, which never differs."""
    e = table(spark, d, "events").where("event_id is not null").select((F.col("event_id") % 3).cast("int").alias("src"), "event_type")
    s = e.groupBy("src").agg(F.sort_array(F.collect_set("event_type")).alias("types"))
    first = s.agg(F.min_by("types", "src").alias("wanted"))
    return s.crossJoin(first).select("src", F.size("types").cast("long").alias("n_types"), (F.col("types") == F.col("wanted")).alias("consistent"))


# Queries over table files, which hold the cells of events: each writes them first, to a new folder that the cluster shares.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _event_files(spark, d, layout: Layout, rows: bool = False, ranges: bool = False) -> list[File]:
    """The files of events in a layout, one for each source, each with one version of a cell. With ``rows`` event types are clustering
    values of rows with one column ``v``; every 101st event deletes its partition and every 37th its row, or with ``ranges`` the rows
    from click to purchase."""
    e = event_cells(spark, d).withColumn("text", F.col("value").cast("string").cast("binary"))
    kept = ("ts", "deleted", "ttl", "expires_at", "text")
    cells = rc.latest(e, ("src", "key"), kept).select("src", "key", F.lit("cell").alias("kind"), "name", F.lit(None).cast("string").alias("range_end"), *kept)
    null = F.lit(None)
    marks = e.where("kind <> 'cell'").groupBy("src", "key", "kind", "name", "range_end").agg(F.max("ts").alias("ts"))
    marks = marks.select("src", "key", "kind", "name", "range_end", "ts", F.lit(False).alias("deleted"), null.cast("long").alias("ttl"), null.cast("long").alias("expires_at"), null.cast("binary").alias("text"))
    if rows:
        row = F.array(F.col("name").cast("binary"))
        cells = cells.withColumn("clustering", row).withColumn("name", F.lit("v"))
        gone = e.where("kind = 'cell' and pos % 37 = 0").groupBy("src", "key", "name").agg(F.max("ts").alias("ts"))
        gone = gone.select("src", "key", F.lit("row_deletion").alias("kind"), row.alias("clustering"), "ts", F.lit(False).alias("deleted"))
        at = lambda c: places.place(F.array(F.col(c).cast("binary")), layout.order)
        spans = marks.where("kind = 'range_tombstone'").select("src", "key", F.lit("rows_deletion").alias("kind"), at("name").alias("name"), F.concat(at("range_end"), F.lit(places.BEYOND)).alias("range_end"), "ts", "deleted")
        marks = marks.where("kind = 'row_deletion'").unionByName(spans if ranges else gone, allowMissingColumns=True)
    out = cells.unionByName(marks, allowMissingColumns=True).withColumnRenamed("text", "value").withColumn("key", F.col("key").cast("string").cast("binary"))
    folder = new_folder(spark, "event-files")
    write_sstables(out, folder, "ks", "events", layout).collect()  # one row a file
    return find_files([f"{folder}/ks/events"])


_text = lambda c: F.col(c).cast("string")
_FILE_MERGED = "SELECT CAST(key AS VARCHAR) AS key, name, ts, value, expires_at FROM merged"


def _file_merged(spark, files: list[File], **options) -> DataFrame:
    cells = rc.exploded(rc.reconcile(read_files(spark, files, **options)))
    return cells.select(_text("key").alias("key"), "name", "ts", _text("value").cast("double").alias("value"), "expires_at")


@query(_FILE_MERGED, cells=True)
def q42_merge_of_counted_files(spark, d):
    """Rows with a count of columns, no compression, in small ranges."""
    return _file_merged(spark, _event_files(spark, d, Layout("hc", "RandomPartitioner", None, every=4)), split_bytes=4096)


@query(_FILE_MERGED, cells=True)
def q43_merge_of_older_files(spark, d):
    """Snappy, checksums over what is compressed, columns up to an empty name."""
    return _file_merged(spark, _event_files(spark, d, Layout("jb", codec="SnappyCompressor", chunk=1 << 12, every=4)), split_bytes=4096)


@query(_FILE_MERGED, cells=True)
def q44_merge_of_files_with_checked_data(spark, d):
    """Deflate, checksums over what was compressed."""
    return _file_merged(spark, _event_files(spark, d, Layout("ib", codec="DeflateCompressor", chunk=1 << 12)))


_ROWS = """rd AS (SELECT key, name, max(ts) AS rts FROM e WHERE pos % 37 = 0 GROUP BY key, name),
l2 AS (SELECT l.* FROM live l LEFT JOIN pd ON l.key = pd.key LEFT JOIN rd ON l.key = rd.key AND l.name = rd.name
  WHERE (pd.del_ts IS NULL OR pd.del_ts < l.ts) AND (rts IS NULL OR rts < l.ts))"""


def _row_files(spark, d, ranges: bool = False) -> list[File]:
    return _event_files(spark, d, Layout("mc", regular=(("u", "LongType"), ("v", "UTF8Type")), clustering=("UTF8Type",), chunk=1 << 12, every=4), rows=True, ranges=ranges)


@query(f", {_ROWS} SELECT CAST(key AS VARCHAR) AS key, name AS place, 'v' AS name, ts, value, ttl, expires_at FROM l2", cells=True)
def q45_merge_of_newer_files(spark, d):
    """Clustering columns, a subset of the columns in each row, delta-coded times, LZ4."""
    cells = rc.exploded(rc.reconcile_wide(read_files(spark, _row_files(spark, d), split_bytes=4096)), ("key", "clustering"))
    return cells.select(_text("key").alias("key"), F.col("clustering")[0].cast("string").alias("place"), "name", "ts", _text("value").cast("double").alias("value"), "ttl", "expires_at")


@query(f", {_ROWS} SELECT CAST(key AS VARCHAR) AS key, name AS place, value, CAST(expires_at - {NOW} AS BIGINT) AS ttl FROM l2 WHERE expires_at IS NULL OR expires_at >= {NOW} + 1", cells=True)
def q46_load_of_a_clustered_table(spark, d):
    """Every row of a partition is a record of its own."""
    run = load_table(spark, [], files=_row_files(spark, d), now=NOW)
    out = run.exported().where(F.size("clustering") > 0)
    return out.select(_text("key").alias("key"), F.col("clustering")[0].cast("string").alias("place"), F.col("bins")["v"].cast("string").cast("double").alias("value"), "ttl")


@query("SELECT key, name AS place, ts, value, expires_at FROM merged", cells=True)
def q55_rows_deleted_in_ranges(spark, d):
    """Ranges of rows, from one clustering value to another, instead of ranges of columns in a row."""
    e, order = event_cells(spark, d), (("UTF8Type", False),)
    row = lambda c: F.array(F.col(c).cast("binary"))
    is_cell, of_rows = F.col("kind") == "cell", F.col("kind") == "range_tombstone"
    cells = e.select(
        "src", "key", F.when(is_cell, row("name")).alias("clustering"), F.lit(False).alias("is_static"), F.when(of_rows, "rows_deletion").otherwise(F.col("kind")).alias("kind"),
        F.when(is_cell, "v").when(of_rows, places.place(row("name"), order)).alias("name"), F.when(of_rows, F.concat(places.place(row("range_end"), order), F.lit(places.BEYOND))).alias("range_end"),
        "ts", "deleted", "ttl", "expires_at", "value", "pos",
    )
    rows = rc.exploded(rc.reconcile_wide(cells, order=order), ("key", "clustering"))
    return rows.select("key", F.col("clustering")[0].cast("string").alias("place"), "ts", "value", "expires_at")


@query(f"SELECT CAST(key AS VARCHAR) AS key, name AS place, value, CAST(expires_at - {NOW} AS BIGINT) AS ttl FROM merged WHERE expires_at IS NULL OR expires_at >= {NOW} + 1", cells=True)
def q56_load_of_files_with_ranges_of_rows(spark, d):
    """Range tombstones over clustering columns, written, read and loaded."""
    out = load_table(spark, [], files=_row_files(spark, d, ranges=True), now=NOW).exported().where(F.size("clustering") > 0)
    return out.select(_text("key").alias("key"), F.col("clustering")[0].cast("string").alias("place"), F.col("bins")["v"].cast("string").cast("double").alias("value"), "ttl")


@query("SELECT src, CAST(key AS VARCHAR) AS key, name, max(ts) AS ts FROM e WHERE key = 7 GROUP BY ALL", cells=True)
def q47_lookup_in_files(spark, d):
    """One key by summary and index; values are skipped."""
    files = _event_files(spark, d, Layout("jb", every=2))
    cells = read_files(spark, files, key="7", values=False).where("kind = 'cell'")
    return cells.select(_source(files).alias("src"), _text("key").alias("key"), "name", "ts")


def _source(files: list[File]) -> F.Column:
    """The source that a file was written from, by its place in the order of first keys."""
    return F.array(*[F.lit(int(f.table.stem.rpartition("-")[2])) for f in files])[F.col("src")]


_USERS = f"o AS (SELECT key, token FROM (SELECT key, {_TOKEN} AS token FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, CAST('0x' || md5(CAST(user_id AS VARCHAR)) AS uhugeint) AS x FROM events)))"


@query(f"WITH {_USERS} SELECT key, token FROM o WHERE (token, key) >= (SELECT (token, key) FROM o WHERE key = '7')")
def q48_seek_in_files(spark, d):
    """Partitions from a start key on, in the partitioner's order."""
    cells = read_files(spark, _event_files(spark, d, Layout("hc", "RandomPartitioner", every=2)), start_key="7")
    return cells.select(_text("key").alias("key"), F.lower(F.hex("token")).alias("token")).distinct()


@query("SELECT CAST(event_id % 3 AS INTEGER) AS src, CAST(12 * 26 + 2 AS INTEGER) AS version, 'ks' AS keyspace, 'events' AS \"table\", 'Murmur3Partitioner' AS partitioner, 'UTF8Type' AS clustering, 'u LongType,v UTF8Type' AS columns FROM events GROUP BY 1")
def q49_files_described(spark, d):
    """Names, Statistics and header of the files."""
    about = describe_files(spark, _row_files(spark, d))
    columns = F.array_join(F.transform("regular_columns", lambda c: F.concat_ws(" ", c["name"], c["format"])), ",")
    src = F.regexp_extract("path", r"-(\d+)-big-Data", 1).cast("int")
    return about.select(src.alias("src"), "version", "keyspace", "table", "partitioner", F.array_join("clustering", ",").alias("clustering"), columns.alias("columns"))


@query("SELECT CAST(event_id % 3 AS INTEGER) AS src, count(DISTINCT user_id) AS n_partitions, true AS all_there FROM events GROUP BY 1")
def q50_file_sizes(spark, d):
    """Partitions of each file, and whether its stored bytes are what its file system says."""
    files = _event_files(spark, d, Layout("jb"))
    path = F.regexp_replace(F.col("path"), "^file:/+", "/")
    sizes = spark.read.format("binaryFile").load([_folder(f) + "/*-Data.db" for f in files[:1]]).select(path.alias("path"), F.col("length").alias("stored"))
    about = describe_files(spark, files).withColumn("path", path)
    seen = read_files(spark, files, values=False).select(_source(files).alias("src"), "key").groupBy("src").agg(F.count_distinct("key").alias("n_partitions"))
    there = about.join(sizes, "path").groupBy(F.regexp_extract("path", r"-(\d+)-Data", 1).cast("int").alias("src")).agg(F.bool_and(F.col("length") == F.col("stored")).alias("all_there"))
    return seen.join(there, "src").select("src", "n_partitions", "all_there")


def _folder(f: File) -> str:
    return f.table.stem.rpartition("/")[0]


@query("SELECT key, name, ts FROM w WHERE NOT deleted AND pos % 5 <> 0", cells=True)
def q51_unnamed_cells(spark, d):
    """A name that is empty marks a row and is never a column: here every fifth winner's."""
    w = rc.latest(event_cells(spark, d), kept=("ts", "deleted", "value", "pos"))
    marked = w.withColumn("name", F.when(F.col("pos") % 5 == 0, F.lit("")).otherwise(F.col("name")))
    return rc.live_cells(marked).select("key", "name", "ts")


@query(f"WITH {_ORDERS}, s AS (SELECT (token, key) AS start_at FROM o WHERE key = '7') SELECT key, token, (token, key) >= (SELECT start_at FROM s) AS resumed FROM o")
def q52_resumed_runs(spark, d):
    """A run that stopped before a key and one that starts there, one after the other: all keys, each once."""
    keys = _order_keys(spark, d)
    stopped = keys.where(~scan_range.at_or_after(F.col("token"), F.col("key"), *_start("7")))
    resumed = scan_range.seek(keys, *_start("7"))
    return stopped.withColumn("resumed", F.lit(False)).unionByName(resumed.withColumn("resumed", F.lit(True)))


@query(f"WITH {_USERS}, f AS (SELECT CAST(event_id % 3 AS INTEGER) AS source, min((token, key)) AS first FROM events JOIN o ON o.key = CAST(user_id AS VARCHAR) GROUP BY 1) SELECT source, CAST(row_number() OVER (ORDER BY first, source) - 1 AS INTEGER) AS src FROM f")
def q53_order_of_files(spark, d):
    """Files by their first (token, key), as the reader numbers them."""
    files = _event_files(spark, d, Layout("hc", "RandomPartitioner"))
    return spark.createDataFrame([(int(f.table.stem.rpartition("-")[2]), i) for i, f in enumerate(files)], "source int, src int")


_TIMES = lambda a, b: f"CAST(CAST({a} AS UHUGEINT) * CAST({b} AS UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT)"
_PLUS = lambda a, b: f"CAST((CAST({a} AS UHUGEINT) + CAST({b} AS UHUGEINT)) % 18446744073709551616::UHUGEINT AS UBIGINT)"
_SHIFTED = lambda x: f"xor({x}, {x} >> 33)"
_MIXED = lambda x: f"SELECT key, {', '.join(x(h) + ' AS ' + h for h in ('h1', 'h2'))} FROM"
#: The murmur token of keys of ASCII, in 64-bit arithmetic. Constants are fixed values of murmur3. Exact for keys of up to six bytes only:
#: DuckDB's list_sum gives a double, which rounds the 56 bits of seven bytes to 53, and nine bytes don't fit. The queries have no such bound.
_MURMUR = f"""WITH k AS (SELECT key, CAST(list_sum([CAST(ascii(key[i]) AS UHUGEINT) * (256::UHUGEINT ** (i - 1))::UHUGEINT for i in range(1, length(key) + 1)]) AS UBIGINT) AS k1 FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders)),
a AS (SELECT key, {_TIMES("k1", "9782798678568883157")} AS k1 FROM k),
b AS (SELECT key, {_PLUS(_TIMES("k1", "2147483648"), "k1 >> 33")} AS k1 FROM a),
c AS (SELECT key, xor({_TIMES("k1", "5545529020109919103")}, CAST(length(key) AS UBIGINT)) AS h1, CAST(length(key) AS UBIGINT) AS h2 FROM b),
d AS (SELECT key, {_PLUS("h1", "h2")} AS h1, h2 FROM c), f AS (SELECT key, h1, {_PLUS("h1", "h2")} AS h2 FROM d),
m1 AS ({_MIXED(_SHIFTED)} f), m2 AS ({_MIXED(lambda h: _TIMES(h, "18397679294719823053"))} m1), m3 AS ({_MIXED(_SHIFTED)} m2),
m4 AS ({_MIXED(lambda h: _TIMES(h, "14181476777654086739"))} m3), m5 AS ({_MIXED(_SHIFTED)} m4),
t AS (SELECT key, {_PLUS("h1", "h2")} AS h FROM m5),
o AS (SELECT key, CASE WHEN h < 9223372036854775808 THEN CAST(h AS BIGINT) WHEN h = 9223372036854775808 THEN 9223372036854775807
  ELSE CAST(CAST(h AS HUGEINT) - 18446744073709551616 AS BIGINT) END AS token FROM t)"""
#: The token of q32 in SQL, by 128-bit products.
SQL["q32_murmur_token"] = f"{_MURMUR} SELECT key, token FROM o"


@query(f"{_MURMUR} SELECT key, token, row_number() OVER (ORDER BY token, key) AS ordinal FROM o")
def q54_murmur_order(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    return scan_range.ordinals(keys.withColumn("token", tokens.murmur_token("key")), ["token", "key"])
