"""Registered restartable-work queries (W1-W6) over ``pages``.  The per-row
function is the deterministic status rule of the fixtures (an idempotent
stand-in for a download), so rounds are reproducible and have SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import workqueue as WQ
from ..session import scratch_path
from ..sources import fs
from . import fixtures as FX
from .registry import register, table

MAX_ROUNDS = 4

_DUCK_TARGET = r"""
urlp as (
  select page_id, url,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(url, '^[^?#]*\?([^#]*)', 1) as query
  from pages),
segs as (select *, string_split(path, '/') as s from urlp),
parts as (
  select page_id, url, query,
         case when len(s) > 2 then s[2:len(s) - 1] else []::VARCHAR[] end as dirs,
         case when len(s) >= 2 then s[len(s)] else '' end as name0
  from segs),
named as (
  select *, case when name0 = '' then 'index.html' else name0 end
            || case when query <> '' then '?' || query else '' end as fname
  from parts)"""


def _duck_target(cut: int) -> str:
    return f"array_to_string(list_concat(dirs[{cut + 1}:], [fname]), '/')"


@register("target_paths", sql=f"""
with {_DUCK_TARGET}
select page_id, 0 as cut_dirs, {_duck_target(0)} as target from named
union all
select page_id, 1 as cut_dirs, {_duck_target(1)} as target from named
""")
def target_paths(spark, sf):
    """Local targets of every address with 0 and 1 leading folders cut."""
    u = FX.urls(spark, sf)
    return (u.select("page_id", F.lit(0).alias("cut_dirs"), WQ.target_path("url", 0).alias("target"))
            .unionByName(u.select("page_id", F.lit(1).alias("cut_dirs"), WQ.target_path("url", 1).alias("target"))))


@register("target_clashes", sql=f"""
with {_DUCK_TARGET}
select {_duck_target(0)} as target, count(*) as n_urls from named group by 1 having count(*) > 1
""")
def target_clashes(spark, sf):
    """W1 report: targets several addresses would write (host dropped)."""
    return WQ.target_clashes(FX.urls(spark, sf), "url", 0)


def _status(page_id, attempt):
    return FX.attempt_status(page_id, attempt)


def _rounds(spark, sf):
    state_path = scratch_path(spark, "work-state")
    state, _left = WQ.run_until_done(FX.urls(spark, sf), _status, state_path, ["page_id"], MAX_ROUNDS)
    return state_path, state


_DUCK_FIRST_OK = f"""
first_ok as (
  select page_id, min(attempt) filter (where status = 0) as ok_at,
         max(status) filter (where attempt = {MAX_ROUNDS}) as last_status
  from fx_attempts where attempt <= {MAX_ROUNDS} group by page_id)"""


@register("work_rounds_final_state", sql=FX.duck_with("fx_attempts") + "," + _DUCK_FIRST_OK + """
select p.page_id, p.url, case when f.ok_at is not null then 0 else f.last_status end as status,
       cast(coalesce(f.ok_at, 4) as integer) as attempts
from pages p join first_ok f using (page_id)
""")
def work_rounds_final_state(spark, sf):
    """State written in generations, pending rows retried each round,
    stopped after four rounds (rows that always fail are left pending)."""
    _, state = _rounds(spark, sf)
    return state.select("page_id", "url", "status", "attempts")


@register("work_pending_by_round", sql=FX.duck_with("fx_attempts") + "," + _DUCK_FIRST_OK + f"""
select r as round, count(*) filter (where ok_at is null or ok_at > r) as pending
from first_ok, (select unnest(range(0, {MAX_ROUNDS + 1})) as r) rs group by r
""")
def work_pending_by_round(spark, sf):
    """Pending rows in every written generation (250, 87, 5, 5, 5 at
    sf0.01), read back from storage."""
    state_path, _ = _rounds(spark, sf)
    gens = spark.read.parquet(state_path)  # partition column ``gen`` from the folder names
    return gens.groupBy(F.col("gen").cast("bigint").alias("round")).agg(
        F.sum(F.when(F.col("status").isNull() | (F.col("status") != 0), 1).otherwise(0)).cast("bigint")
        .alias("pending"))


@register("skip_fetched_targets", sql=f"""
with {_DUCK_TARGET},
done as (select {_duck_target(0)} as target from named
         where not (page_id % 50 = 7) and not ((page_id + 1) % 3 = 0))
select n.page_id, {_duck_target(0)} as target from named n
where {_duck_target(0)} not in (select target from done)
""")
def skip_fetched_targets(spark, sf):
    """Addresses whose target already exists after the first round are
    skipped (left anti join against the finished targets)."""
    state_path = scratch_path(spark, "work-state")
    WQ.run_until_done(FX.urls(spark, sf), _status, state_path, ["page_id"], max_rounds=1)
    st = WQ.read_state(spark, state_path)
    listing = st.filter(F.col("status") == 0).select(WQ.target_path("url", 0).alias("target"))
    todo = FX.urls(spark, sf).select("page_id", WQ.target_path("url", 0).alias("target"))
    out = WQ.skip_existing(todo, listing, "target")
    if not fs.exists(spark, state_path):
        raise RuntimeError("state folder missing")
    return out.select("page_id", "target")


@register("work_row_function", sql="""
select page_id, case when length(url) % 4 = 0 then -1 else 0 end as status, 1 as attempts,
       case when length(url) % 4 = 0 then 'ValueError: refused ' || url end as error
from pages
""")
def work_row_function(spark, sf):
    """W3 with a real per-row Python function over the addresses: a row whose
    function raises is recorded (status -1 and the message), the round goes on."""
    def visit(url, attempt):
        if len(url) % 4 == 0:
            raise ValueError(f"refused {url}")
        return 0

    state_path = scratch_path(spark, "work-state")
    state, _ = WQ.run_until_done(FX.urls(spark, sf), WQ.row_function(visit), state_path, ["url"], max_rounds=1)
    return state.select("page_id", "status", "attempts", "error")


@register("work_resumes_after_cap", sql=FX.duck_with("fx_attempts") + "," + _DUCK_FIRST_OK + """
select p.page_id, case when f.ok_at is not null then 0 else f.last_status end as status,
       cast(coalesce(f.ok_at, 4) as integer) as attempts
from pages p join first_ok f using (page_id)
""")
def work_resumes_after_cap(spark, sf):
    """Two calls of at most two rounds each; the second goes on where the
    first stopped."""
    state_path = scratch_path(spark, "work-state")
    for _ in range(2):
        state, _left = WQ.run_until_done(FX.urls(spark, sf), _status, state_path, ["page_id"], max_rounds=2)
    return state.select("page_id", "status", "attempts")


@register("work_cleanup", sql="""
select 'complete' as state, true as removed, false as still_there, cast(0 as bigint) as pending
union all
select 'pending', false, true, count(*) filter (where page_id % 50 = 7) from pages
""")
def work_cleanup(spark, sf):
    """State goes once all rows are done, and stays while rows are pending."""
    u = FX.urls(spark, sf)
    out = []
    for name, rows in (("complete", u.filter(F.col("page_id") % 50 != 7)), ("pending", u)):
        path = scratch_path(spark, f"work-{name}")
        _, left = WQ.run_until_done(rows, _status, path, ["page_id"], MAX_ROUNDS)
        n = left.count()
        removed = WQ.cleanup(spark, path, created=True)
        out.append((name, removed, fs.exists(spark, path), n))
    return spark.createDataFrame(out, "state string, removed boolean, still_there boolean, pending bigint")


CLOCK = 10_000
HOST_LIMIT = 5


@register("work_due_schedule", sql=f"""
with st as (
  select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host,
         case page_id % 6 when 0 then null when 1 then 0 when 2 then 503 when 3 then 404 when 4 then 429 else -1 end as status,
         page_id % 5 as attempts, {CLOCK} - (page_id * 37) % 4000 as last_try from pages),
w as (select *, case status when -1 then 60 when 429 then 300 when 503 then 60 end as base from st),
n as (select *, case when status is null then 0
                     when base is not null then last_try + least(base * power(2, greatest(attempts - 1, 0)), 86400)::bigint
                end as next_try from w),
r as (select *, row_number() over (partition by host order by next_try, page_id) as k from n
      where next_try <= {CLOCK})
select page_id, host, status, cast(next_try as bigint) as next_try from r where k <= {HOST_LIMIT}
""")
def work_due_schedule(spark, sf):
    """The addresses due at a fixed clock, by status class and attempts, five a host at most."""
    p = F.col("page_id")
    status = (F.when(p % 6 == 1, 0).when(p % 6 == 2, 503).when(p % 6 == 3, 404).when(p % 6 == 4, 429).when(p % 6 == 5, -1))
    st = FX.urls(spark, sf).select("page_id", WQ.host_of("url").alias("host"), status.alias("status"),
                                   (p % 5).cast("int").alias("attempts"), (F.lit(CLOCK) - (p * 37) % 4000).alias("last_try"))
    return WQ.due_rows(st, CLOCK, "page_id", HOST_LIMIT).select("page_id", "host", "status", "next_try")


@register("work_due_rounds", sql="""
select page_id, case when page_id % 4 = 1 then 404 else 0 end as status,
       case when page_id % 8 = 0 then 3 when page_id % 4 = 0 then 2 else 1 end as attempts,
       cast(case when page_id % 8 = 0 then 180 when page_id % 4 = 0 then 60 else 0 end as bigint) as last_try
from pages
""")
def work_due_rounds(spark, sf):
    """W3 with W6: rounds at 0, 30, 60, 120 and 180 seconds.  404 is final; 503 waits 60 seconds, then 120."""
    def visit(page_id, attempt):
        return (F.when((page_id % 4 == 0) & (attempt == 1), 503).when((page_id % 8 == 0) & (attempt == 2), 503)
                .when(page_id % 4 == 1, 404).otherwise(0))

    state_path = scratch_path(spark, "work-state")
    rows = FX.urls(spark, sf).select("page_id", F.lit(None).cast("bigint").alias("last_try"))
    WQ.init_state(rows, state_path)
    for now in (0, 30, 60, 120, 180):
        WQ.run_due_round(spark, state_path, visit, ["page_id"], now, "page_id")
    return WQ.read_state(spark, state_path).select("page_id", "status", "attempts", "last_try")


@register("skip_fresh_targets", sql="""
select page_id, octet_length(encode(coalesce(html, ''))) as bytes from pages
where not (page_id % 3 = 0 or page_id % 5 = 0)
""")
def skip_fresh_targets(spark, sf):
    """W6 with freshness: pages whose copy is missing, of another size or older stay."""
    pages = table(spark, sf, "pages").select("page_id", F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint").alias("bytes"),
                                             F.lit(1000).alias("modified"))
    p = F.col("page_id")
    copies = pages.filter((p % 3 == 0) | (p % 5 == 0) | (p % 7 == 0)).select(
        "page_id", F.when((p % 3 == 0) | (p % 5 == 0), F.col("bytes")).otherwise(F.col("bytes") + 1).alias("bytes"),
        F.lit(1000).alias("modified"))
    older = pages.filter(p % 11 == 0).select("page_id", "bytes", F.lit(999).alias("modified"))
    return WQ.skip_fresh(pages, copies.unionByName(older), "page_id").select("page_id", "bytes")
