"""Restartable per-row work (W1-W6), re-aimed from the parallel downloader.

State is a table of rows with ``status`` (null = never tried, 0 = done,
else an error code) and ``attempts``.  Plain Spark has no in-place update, so
state is append-only: generation 0 (``gen=000000``) holds every row, and round
*n* writes generation *n* with the rows it tried and nothing else, and only then
moves the ``_CURRENT`` pointer.  A round tries every pending row, so a row's last
word is where it finished, or the newest generation: reading the state is a
union of scans without a join, and finished rows are never written again.  A
stopped job restarts from the pointer and redoes no finished row.  The written
generation also cuts the lineage, so a lost executor recomputes one round at most.

After many rounds the finished rows lie in many small generations; ``compact_state``
merges neighbours of similar size into one part (``done=...``), so each row is
copied a logarithmic number of times, and moves the pointer in the same way:
a compaction that is killed loses nothing, and folders that the pointer no
longer names are removed by the next one.

The per-row function must be idempotent: a task retry runs it again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import fs
from .rows import pending

StatusFn = Callable[..., Column]

# status of a row whose function raised
FAILED = -1

# seconds before a row of this status is tried again (doubled with every attempt); any other failure is final
RETRY_SECONDS = {FAILED: 60, 408: 30, 429: 300, 500: 60, 502: 30, 503: 60, 504: 60}

_URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
_URL_QUERY = r"^[^?#]*\?([^#]*)"


def target_path(url: str | Column, cut_dirs: int = 0) -> Column:
    """Local path a mirroring download gives a URL: the host is dropped,
    directories are kept after cutting the first ``cut_dirs``, a query string
    stays in the file name, a path ending in ``/`` (or empty) becomes
    ``index.html``; the file name itself is never cut."""
    u = F.col(url) if isinstance(url, str) else url
    path = F.regexp_extract(u, _URL_PATH, 1)
    query = F.regexp_extract(u, _URL_QUERY, 1)
    segs = F.split(path, "/")
    n = F.size(segs)
    # segs[0] is the empty string before the leading '/'; the last one is the file
    dirs = F.when(n > 2, F.slice(segs, 2, F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    kept = F.slice(dirs, cut_dirs + 1, F.greatest(F.size(dirs) - cut_dirs, F.lit(0)))
    name = F.when(n >= 2, F.element_at(segs, -1)).otherwise(F.lit(""))
    name = F.when(name == "", F.lit("index.html")).otherwise(name)
    name = F.when(query != "", F.concat(name, F.lit("?"), query)).otherwise(name)
    return F.array_join(F.concat(kept, F.array(name)), "/")


def target_clashes(df: DataFrame, url_col: str = "url", cut_dirs: int = 0) -> DataFrame:
    """W1 report: targets that more than one URL would write."""
    t = df.select(F.col(url_col), target_path(url_col, cut_dirs).alias("target"))
    return (t.groupBy("target").agg(F.count(F.lit(1)).alias("n_urls"))
            .filter(F.col("n_urls") > 1))


def _gen_dir(state_path: str, gen: int) -> str:
    return f"{state_path.rstrip('/')}/gen={gen:06d}"


def _pointer(spark: SparkSession, state_path: str) -> tuple[int, list[dict]] | None:
    """(newest generation, parts with finished rows): the pointer, or else the
    highest generation folder with a ``_SUCCESS`` marker and all before it."""
    text = fs.read_text(spark, f"{state_path.rstrip('/')}/_CURRENT")
    if text and text.strip():
        found = json.loads(text)
        return found["gen"], found["parts"]
    gens = sorted(int(n.split("=")[1]) for n in fs.list_names(spark, state_path) if n.startswith("gen="))
    for g in reversed(gens):
        if fs.exists(spark, f"{_gen_dir(state_path, g)}/_SUCCESS"):
            return g, [{"path": f"gen={k:06d}", "rows": None} for k in gens if k <= g]
    return None


def current_generation(spark: SparkSession, state_path: str) -> int | None:
    """The newest complete generation."""
    found = _pointer(spark, state_path)
    return None if found is None else found[0]


def _commit(spark: SparkSession, state_path: str, gen: int, parts: list[dict]) -> None:
    fs.write_text(spark, f"{state_path.rstrip('/')}/_CURRENT", json.dumps({"gen": gen, "parts": parts}))


def _read(spark: SparkSession, state_path: str, names: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{state_path.rstrip('/')}/{n}" for n in names])


def read_state(spark: SparkSession, state_path: str, gen: int | None = None) -> DataFrame:
    """Every row once, as it is now: finished rows from where they finished, pending ones from the newest generation.
    With ``gen``, as it was after that generation (as long as none up to it has been compacted)."""
    found = _pointer(spark, state_path)
    if found is None:
        raise FileNotFoundError(f"no state under {state_path}")
    g, names = found[0], [p["path"] for p in found[1]]
    if gen is not None:
        g, names = gen, [f"gen={k:06d}" for k in range(1, gen + 1)]
    left = pending(_read(spark, state_path, [f"gen={g:06d}"]))
    return left.unionByName(_read(spark, state_path, names).filter(F.col("status") == 0)) if names else left


def init_state(df: DataFrame, state_path: str) -> tuple[int, bool]:
    """Reuse existing state, or write every row with a null status as
    generation 0.  Returns ``(generation, created)``."""
    spark = df.sparkSession
    g = current_generation(spark, state_path)
    if g is not None:
        return g, False
    (df.withColumn("status", F.lit(None).cast("int"))
     .withColumn("attempts", F.lit(0))
     .withColumn("error", F.lit(None).cast("string"))
     .write.mode("overwrite").parquet(_gen_dir(state_path, 0)))
    _commit(spark, state_path, 0, [])
    return 0, True


def run_round(spark: SparkSession, state_path: str, fn: StatusFn, input_cols: Sequence[str],
              parallelism: int | None = None) -> int:
    """Apply ``fn(*input_cols, attempt)`` to the pending rows and write them
    as the next generation; finished rows are neither read nor written.  Returns its number."""
    g, parts = _pointer(spark, state_path)
    attempt = g + 1
    todo = pending(_read(spark, state_path, [f"gen={g:06d}"]))
    if parallelism:
        todo = todo.repartition(parallelism)
    tried = todo.withColumn("_r", fn(*[F.col(c) for c in input_cols], F.lit(attempt)))
    told = isinstance(tried.schema["_r"].dataType, T.StructType)  # a status alone, or with a message
    tried = (tried.withColumn("status", (F.col("_r.status") if told else F.col("_r")).cast("int"))
             .withColumn("error", F.col("_r.error") if told else F.lit(None).cast("string"))
             .withColumn("attempts", F.col("attempts") + 1).drop("_r"))
    tried.write.mode("overwrite").parquet(_gen_dir(state_path, attempt))
    done = _read(spark, state_path, [f"gen={attempt:06d}"]).filter(F.col("status") == 0).count()
    _commit(spark, state_path, attempt, [*parts, {"path": f"gen={attempt:06d}", "rows": done}])
    return attempt


def compact_state(spark: SparkSession, state_path: str, most_parts: int = 8, ratio: int = 2) -> bool:
    """Merge the newest parts of finished rows once there are more than ``most_parts``: backwards, as long as a
    part has at most ``ratio`` times the rows behind it, two parts at least.  True if anything was merged."""
    g, parts = _pointer(spark, state_path)
    base = state_path.rstrip("/")
    if len(parts) > most_parts:
        rows = [p["rows"] if p["rows"] is not None else
                _read(spark, state_path, [p["path"]]).filter(F.col("status") == 0).count() for p in parts]
        first, behind = len(parts) - 2, rows[-1] + rows[-2]
        while first > 0 and rows[first - 1] <= ratio * behind:
            first -= 1
            behind += rows[first]
        merged = _read(spark, state_path, [p["path"] for p in parts[first:]]).filter(F.col("status") == 0)
        name = f"done={first:06d}-{g:06d}"
        merged.coalesce(max(1, merged.rdd.getNumPartitions() // 4)).write.mode("overwrite").parquet(f"{base}/{name}")
        parts = [*parts[:first], {"path": name, "rows": behind}]
        _commit(spark, state_path, g, parts)
    else:
        return False
    named = {p["path"] for p in parts} | {f"gen={g:06d}"}
    for n in fs.list_names(spark, state_path):
        if n not in named and n.split("=")[0] in ("gen", "done"):
            fs.delete(spark, f"{base}/{n}")
    return True


def run_until_done(df: DataFrame, fn: StatusFn, state_path: str, input_cols: Sequence[str] = ("url",),
                   max_rounds: int = 10, parallelism_floor: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rounds until nothing is pending or this call has run ``max_rounds``
    of them (the reference loops forever on a row that always fails); a later
    call goes on where this one stopped.  Returns ``(state, leftover)``; only
    a scalar count reaches the driver."""
    spark = df.sparkSession
    init_state(df, state_path)
    par = None
    if parallelism_floor:
        par = parallelism_floor * spark.sparkContext.defaultParallelism
    first = current_generation(spark, state_path)
    while True:
        g = current_generation(spark, state_path)
        left = pending(_read(spark, state_path, [f"gen={g:06d}"]))
        if g - first >= max_rounds or left.limit(1).count() == 0:
            return read_state(spark, state_path), left
        run_round(spark, state_path, fn, input_cols, par)
        compact_state(spark, state_path)


def cleanup(spark: SparkSession, state_path: str, created: bool, force: bool = False) -> bool:
    """Remove the state once complete; only state this job created, and
    never while rows remain pending (unless forced)."""
    if not created:
        return False
    if not force:
        if current_generation(spark, state_path) is not None and pending(read_state(spark, state_path)).limit(1).count() > 0:
            return False
    return fs.delete(spark, state_path)


def skip_existing(df: DataFrame, listing: DataFrame, on: str = "target", listing_col: str | None = None) -> DataFrame:
    """Drop rows whose target already exists (left anti join)."""
    right = listing.select(F.col(listing_col or on).alias(on)).distinct()
    return df.join(right, on, "left_anti")


def host_of(url: str | Column) -> Column:
    """Lower-case host (with its port) of an address; empty if it has none."""
    u = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def with_next_try(df: DataFrame, retry: dict[int, int] | None = None, longest: int = 86_400) -> DataFrame:
    """Add ``final`` and ``next_try`` (unix seconds) from ``status``, ``attempts`` and ``last_try`` (unix seconds).

    A row never tried (null status) is due at once (0); a done row (0) and a failure outside ``retry`` are final and
    have no next try; the others wait the seconds of their status, doubled with every attempt, ``longest`` at most."""
    retry = RETRY_SECONDS if retry is None else retry
    wait = F.lit(None).cast("bigint")
    for status, seconds in retry.items():
        wait = F.when(F.col("status") == status, F.lit(int(seconds)).cast("bigint")).otherwise(wait)
    doubled = F.least(wait * F.pow(F.lit(2.0), F.least(F.greatest(F.col("attempts") - 1, F.lit(0)), F.lit(30))),
                      F.lit(float(longest))).cast("bigint")
    return (df.withColumn("final", F.col("status").isNotNull() & wait.isNull())
            .withColumn("next_try", F.when(F.col("status").isNull(), F.lit(0).cast("bigint"))
                        .when(wait.isNotNull(), F.coalesce("last_try", F.lit(0).cast("bigint")) + doubled)))


def due_rows(df: DataFrame, now: int, key: str, per_host: int | None = None, host: str = "host",
             retry: dict[int, int] | None = None, longest: int = 86_400) -> DataFrame:
    """The rows to try at ``now`` (unix seconds), longest due first and at most ``per_host`` of each host (a null
    host is a host), ties by ``key``.  The bound is a row number below a constant, which is cut inside each task before
    the shuffle, so a host with a third of all rows sends ``per_host`` rows a task."""
    out = with_next_try(df, retry, longest).filter(~F.col("final") & (F.col("next_try") <= F.lit(int(now))))
    if per_host is not None:
        w = Window.partitionBy(host).orderBy("next_try", key)
        out = out.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= int(per_host)).drop("_n")
    return out


def run_due_round(spark: SparkSession, state_path: str, fn: StatusFn, input_cols: Sequence[str], now: int, key: str,
                  per_host: int | None = None, host: str = "host", retry: dict[int, int] | None = None,
                  longest: int = 86_400) -> tuple[int, int]:
    """W3 with W6: a round at ``now`` that tries the due rows only; returns (generation, rows tried).

    The state's rows need a ``last_try`` column (null at first) and a ``key`` that identifies them.  Rows that wait,
    and final failures, go to the new generation as they are; done rows are neither read nor written.  The function's
    ``attempt`` is the row's own.  With nothing due no generation is written."""
    g, parts = _pointer(spark, state_path)
    todo = pending(_read(spark, state_path, [f"gen={g:06d}"]))
    chosen = due_rows(todo, now, key, per_host, host, retry, longest).drop("final", "next_try")
    attempt = F.col("attempts") + 1
    tried = chosen.withColumn("_r", fn(*[F.col(c) for c in input_cols], attempt))
    told = isinstance(tried.schema["_r"].dataType, T.StructType)
    tried = (tried.withColumn("status", (F.col("_r.status") if told else F.col("_r")).cast("int"))
             .withColumn("error", F.col("_r.error") if told else F.lit(None).cast("string"))
             .withColumn("attempts", attempt).withColumn("last_try", F.lit(int(now)).cast("bigint")).drop("_r"))
    name = f"gen={g + 1:06d}"
    folder = _gen_dir(state_path, g + 1)
    tried.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(tried.schema).parquet(folder)  # what was tried is what was written
    counts = written.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("status") == 0, 1)).alias("done")).first()
    if not counts["n"]:
        return g, 0
    waiting = todo.join(written.select(key).checkpoint(), key, "left_anti").select(*todo.columns)
    waiting.write.mode("append").parquet(folder)
    _commit(spark, state_path, g + 1, [*parts, {"path": name, "rows": counts["done"]}])
    return g + 1, counts["n"]


def skip_fresh(df: DataFrame, listing: DataFrame, on: str = "target", size: str = "bytes", time: str = "modified") -> DataFrame:
    """W6 with freshness: drop rows whose copy in ``listing`` (``on``, ``size``, ``time``) has their size and is not
    older than they are; a row or copy without size or time is not fresh.  Of several copies one fresh one is enough."""
    copies = listing.filter(F.col(size).isNotNull()).groupBy(F.col(on).alias("_on"), F.col(size).alias("_size")).agg(
        F.max(time).alias("_time"))
    fresh = (df[on] == copies["_on"]) & (df[size] == copies["_size"]) & (copies["_time"] >= df[time])
    return df.join(copies, fresh, "left_anti")


def row_function(pyfunc: Callable[[str, int], int]) -> StatusFn:
    """Wrap a per-row Python function ``f(value, attempt) -> int`` (a
    download, a copy) as an Arrow-batched, non-deterministic column
    function for ``run_round``.  A row whose function raises gets the status
    ``FAILED`` and the exception's text; the round goes on."""
    def one(value, attempt) -> tuple[int, str | None]:
        try:
            return int(pyfunc(value, int(attempt))), None
        except Exception as e:  # recorded in the row's state
            return FAILED, f"{type(e).__name__}: {e}"

    @F.pandas_udf("status int, error string")
    def _apply(values: pd.Series, attempt: pd.Series) -> pd.DataFrame:
        out = [one(v, a) for v, a in zip(values, attempt)]
        return pd.DataFrame({"status": pd.Series([s for s, _ in out], dtype="int32"),
                             "error": pd.Series([e for _, e in out], dtype=object)})

    udf = _apply.asNondeterministic()
    return lambda value, attempt: udf(value, attempt)
