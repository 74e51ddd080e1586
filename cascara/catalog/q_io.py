"""Source/sink and streaming queries. Files are written below the session's checkpoint folder (a fresh folder per
run), from tables Spark derives from the driver's ``customer`` and ``events`` tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascara.catalog import sql_churn as S
from cascara.catalog.q_clean import cleaned, raw
from cascara.catalog.registry import query, table
from cascara.functions.columns import rounded, time_literal
from cascara.plans import churn as P
from cascara.session import scratch_path
from cascara.sources import files as IO
from cascara.sources import quarantine as Q
from cascara.sources.churn import CHURN_SCHEMA
from cascara.sources.churn_values import RENAMES
from cascara.streaming import hourly as H
from cascara.streaming.ingest import ingest_landing, read_sink

#: Fields that say which row of a landed file is which, for dealing rows out to files.
_DEAL = ["customerID", "tenure", "MonthlyCharges", "gender"]


def land(spark, sf, name="landing"):
    """Write the raw churn rows as CSV files, as many as the session shuffles into; the rows of one key lie in several
    files."""
    path = scratch_path(spark, name)
    IO.write_csv(raw(spark, sf).repartition(*_DEAL), path)
    return path


@query("csv_scan", S.with_chain("SELECT * FROM raw"))
def q_csv_scan(spark, sf):
    """Declared schema, header skipped, columns bound by position."""
    return IO.read_csv(spark, land(spark, sf), CHURN_SCHEMA)


@query("csv_scan_inferred", S.with_chain("SELECT * FROM raw"))
def q_csv_scan_inferred(spark, sf):
    """Schema inferred from the text (charges come back as double and are narrowed to the declared float)."""
    df = IO.read_csv_inferred(spark, land(spark, sf))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CHURN_SCHEMA.fields])


@query("parquet_roundtrip", S.with_chain("SELECT * FROM clean"))
def q_parquet_roundtrip(spark, sf):
    """Cleaned table written as a parquet dataset (overwrite) and read back whole."""
    path = scratch_path(spark, "clean")
    IO.write_parquet(cleaned(spark, sf), path)
    IO.write_parquet(cleaned(spark, sf), path)  # overwrite replaces, never appends
    return IO.read_parquet(spark, path)


@query("parquet_scan", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
                       "WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount > 0.05")
def q_parquet_scan(spark, sf):
    """Projection and filter reach the parquet scan (ReadSchema of 5 columns, PushedFilters on both predicates)."""
    li = IO.read_parquet(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return li.where((F.col("l_shipdate") >= time_literal(li, "l_shipdate", "1998-01-01")) & (F.col("l_discount") > 0.05)) \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")


#: Customers as lines, dealt into a known number of files: names and sizes follow from the data.
_PARTS = 4
_PARTS_SQL = f"""SELECT CAST(c_custkey % {_PARTS} AS INTEGER) AS part, CAST(sum(strlen(c_custkey || '|' || c_name) + 1) AS BIGINT) AS bytes
FROM customer GROUP BY ALL"""


def _landed_parts(spark, sf, listing):
    path = scratch_path(spark, "landing")
    lines = table(spark, sf, "customer").select((F.col("c_custkey") % _PARTS).cast("int").alias("part"), F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    lines.repartition("part").write.partitionBy("part").text(path)
    return listing(spark, path, 1).select(F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part"), F.col("length").alias("bytes"))


@query("list_landing_files", _PARTS_SQL)
def q_list_landing_files(spark, sf):
    """Landed files with more than one byte (the ``_SUCCESS`` marker is empty and is skipped)."""
    return _landed_parts(spark, sf, IO.list_files)


@query("landing_first_file", f"SELECT * FROM ({_PARTS_SQL}) ORDER BY part LIMIT 1")
def q_landing_first_file(spark, sf):
    """The first qualifying landed file, in path order."""
    return _landed_parts(spark, sf, IO.first_file)


_BROKEN = "substr(md5(coalesce(customerID, '')), 1, 1) IN ('0', '1')"
_ROW_RULES = [P.RULE_CHILD_PHONE, P.RULE_CHILD_INTERNET, P.RULE_DOMAIN_SENIOR, P.RULE_MISSING_PHONE, P.RULE_MISSING_INTERNET, P.RULE_NUMERIC]
_ROW_SQL = [S.P_CHILD_PHONE, S.P_CHILD_INTERNET, S.P_DOMAIN, S.P_MISSING_PHONE, S.P_MISSING_INTERNET, S.P_NUMERIC]
_VERDICT_SQL = "CASE WHEN substr(md5(coalesce(CustomerID, '')), 1, 1) IN ('0', '1') THEN 'malformed' " + " ".join(
    f"WHEN coalesce({p}, false) THEN '{r.name}'" for r, p in zip(_ROW_RULES, _ROW_SQL)) + " ELSE 'ok' END"


@query("csv_quarantine", S.with_chain(f"SELECT verdict, CustomerID, count(*) AS n FROM (SELECT *, {_VERDICT_SQL} AS verdict FROM renamed) GROUP BY ALL"))
def q_csv_quarantine(spark, sf):
    """A landing in which an eighth of the lines break off after eight fields: every line lands once, with its verdict."""
    landing = scratch_path(spark, "broken-landing")
    rows = raw(spark, sf)
    line = F.to_csv(F.struct(*rows.columns))
    rows.select(F.when(F.expr(_BROKEN), F.substring_index(line, ",", 8)).otherwise(line).alias("value")).write.text(landing)
    target = Q.split_landing(spark, landing, CHURN_SCHEMA, _ROW_RULES, scratch_path(spark, "verdicts"), renames=RENAMES, header=False)
    bad = Q.quarantined(spark, target)
    # the key of a rejected line: its field in the row's values, or the first field of the line as it was
    first = F.split("line", ",")[0]
    key = F.when(F.col("rule") == Q.MALFORMED, F.when(~first.isin('""', ""), first)).otherwise(F.get_json_object("line", "$.CustomerID"))
    both = bad.select(F.col("rule").alias("verdict"), key.alias("CustomerID")).unionByName(Q.accepted(spark, target).select(F.lit(Q.OK).alias("verdict"), "CustomerID"))
    return both.groupBy("verdict", "CustomerID").agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_publish", S.with_chain("SELECT * FROM clean"))
def q_snapshot_publish(spark, sf):
    """Publish twice to the same snapshot path; the second replaces the first."""
    target = scratch_path(spark, "snapshot")
    c = cleaned(spark, sf)
    IO.publish_snapshot(c.where(F.col("Tenure") < 36), target)
    IO.publish_snapshot(c, target)
    return IO.read_snapshot(spark, target)


@query("stream_ingest", S.with_chain("SELECT * FROM clean"))
def q_stream_ingest(spark, sf):
    """Landing folder → streaming CSV source → raw table → cleaned snapshot; a second run adds nothing."""
    landing = land(spark, sf)
    sink, ckpt, archive = (scratch_path(spark, n) for n in ("sink", "stream-ckpt", "archive"))
    for _ in range(2):
        ingest_landing(spark, landing, CHURN_SCHEMA, sink, ckpt, P.clean, max_files_per_trigger=3,
                       clean_source="archive", archive_dir=archive)
    return read_sink(spark, sink)


BASELINE_END = "2024-01-02"
_HOURLY_SQL = f"""WITH b AS (SELECT event_type AS value, count(*) AS n FROM events
  WHERE ts < TIMESTAMP '{BASELINE_END}' AND event_type IS NOT NULL GROUP BY 1),
bs AS (SELECT value, n / sum(n) OVER () AS e FROM b),
h AS (SELECT date_trunc('hour', ts) AS window_start, event_type AS value, count(*) AS n FROM events
  WHERE event_type IS NOT NULL GROUP BY 1, 2),
ht AS (SELECT window_start, sum(n) AS tot FROM h GROUP BY 1),
cats AS (SELECT window_start, value FROM h UNION SELECT ht.window_start, bs.value FROM ht JOIN bs ON true),
al AS (SELECT c.window_start, ht.tot, coalesce(h.n, 0) / ht.tot AS a, coalesce(bs.e, 0) AS e FROM cats c
  JOIN ht ON c.window_start = ht.window_start
  LEFT JOIN h ON c.window_start = h.window_start AND c.value = h.value LEFT JOIN bs ON c.value = bs.value),
cl AS (SELECT window_start, tot, CASE WHEN a = 0 THEN 1e-10 ELSE a END AS a,
  CASE WHEN e = 0 THEN 1e-10 ELSE e END AS e FROM al)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(tot AS BIGINT) AS n,
  round(sum((a - e) * ln(a / e)), 6) AS psi FROM cl
GROUP BY cl.window_start, tot"""


@query("psi_hourly", _HOURLY_SQL)
def q_psi_hourly(spark, sf):
    """PSI of ``event_type`` for every hour of ``events`` against the first day."""
    ev = table(spark, sf, "events")
    base = ev.where(F.col("ts") < time_literal(ev, "ts", BASELINE_END))
    return H.hourly_psi(ev, base, "ts", "event_type").select(
        _hour_text(F.col("window_start")), F.col("n").cast("long").alias("n"), rounded(F.col("psi")).alias("psi"))


def _hour_text(c):
    """Window start as ISO text (timestamp units differ between engines' pandas conversions)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("window_start")


def _streamed(spark, sf, slices, merge_after=()):
    """Run the hourly job after each slice of ``events`` that lands, and score all hours at the end."""
    ev = table(spark, sf, "events")
    shares = H.baseline_shares(ev.where(F.col("ts") < time_literal(ev, "ts", BASELINE_END)), "event_type")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("events-src", "hourly-sink", "hourly-ckpt"))
    for i, cond in enumerate(slices(ev)):
        ev.where(cond).write.mode("append").parquet(src)
        H.hourly_psi_stream(spark.readStream.schema(ev.schema).parquet(src), "ts", "event_type", sink, ckpt)
        if i in merge_after:
            H.merge_counts(spark, sink)
    return H.streamed_psi(spark, sink, shares).select(
        _hour_text(F.col("window_start")), F.col("n").cast("long").alias("n"), rounded(F.col("psi")).alias("psi"))


@query("psi_hourly_stream", _HOURLY_SQL)
def q_psi_hourly_stream(spark, sf):
    """The same through Structured Streaming: four time slices land one after another, and the job runs after each."""
    def slices(ev):
        lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
        step = (hi - lo) / 4
        cuts = [F.lit(lo + step * i) for i in range(1, 4)]
        part = F.size(F.filter(F.array(*cuts), lambda c: c <= F.col("ts")))
        return [F.coalesce(part, F.lit(0)) == i for i in range(4)]

    return _streamed(spark, sf, slices)


@query("psi_hourly_late", _HOURLY_SQL)
def q_psi_hourly_late(spark, sf):
    """Every hour's rows are spread over all five slices, so all but the first bring late rows for closed hours; counts
    are merged in between."""
    return _streamed(spark, sf, lambda ev: [F.pmod(F.xxhash64(*ev.columns), F.lit(5)) == i for i in (3, 0, 4, 2, 1)], merge_after=(1, 3))
