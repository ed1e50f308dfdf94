"""Decisions of a run, as expressions over rows: what to do with a deployment, when to refresh, what to repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RETRIES = 2
RETRYABLE = ("failure", "cancelled", "timed_out", "startup_failure")


def deploy_decision(retryable: tuple[str, ...] = RETRYABLE, most: int = MOST_RETRIES) -> Column:
    """retry, verify, ok, skip or fail: columns run_sha, main_sha, conclusion (null: running; 'none': no run), attempt, live_stamp, committed_stamp, last_check.

    Only the newest commit's deployment is touched; a failed one is tried again most times; a
    successful one counts when the site serves the commit's own stamp.
    """
    valid = F.coalesce(F.rlike("run_sha", F.lit("^[0-9a-f]{40}$")) & (F.col("run_sha") == F.col("main_sha")), F.lit(False))
    kind = F.col("conclusion")
    return (
        F.when(~valid, "skip").when(kind.isNull(), "skip")
        .when(kind.isin(*retryable), F.when(F.coalesce(F.col("attempt"), F.lit(0)).between(1, most), "retry").otherwise("fail"))
        .when(~kind.isin("success", "none"), "fail").when(F.col("committed_stamp").isNull(), "fail")
        .when(F.coalesce(F.col("live_stamp") == F.col("committed_stamp"), F.lit(False)), "ok").when(~F.col("last_check"), "verify").otherwise("fail")
    )


def moment_of(day: Column, minutes: int, zone: str) -> Column:
    """Seconds since the epoch of a wall-clock time on a local day; in the hour that comes twice the first, in the one that is left out an hour on."""
    wall = F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(f" {minutes // 60:02}:{minutes % 60:02}:00")))
    return F.unix_timestamp(F.to_utc_timestamp(wall.cast("string").cast("timestamp"), zone))


def refresh_decision(now: Column, last: Column, event: Column, zone: str = "Europe/Sofia", target: int = 185, done_from: int = 180, most_wait: int = 350 * 60, evening: int = 1275) -> tuple[Column, Column]:
    """(run, wait or skip; seconds to wait): now and last in seconds since the epoch; times of the day in local minutes.

    Waits and ages are differences of moments, so days of 23 and 25 hours come out right.
    """
    local = F.from_utc_timestamp(F.timestamp_seconds(now), zone)
    today = F.to_date(local)
    at, late, done = (moment_of(today, m, zone) for m in (target, evening, done_from))
    tomorrow = moment_of(F.date_add(today, 1), target, zone) - now
    what = (
        F.when(event != "schedule", "run").when(now < at, "wait")
        .when(now < late, F.when(F.coalesce(last, F.lit(0)) >= done, "skip").otherwise("run")).when(tomorrow > most_wait, "skip").otherwise("wait")
    )
    wait = F.when(event != "schedule", 0).when(now < at, at - now).when((now >= late) & (tomorrow <= most_wait), tomorrow).otherwise(0)
    return what, wait.cast("long")


def other_waiter(runs: DataFrame, me: DataFrame, least: int = 180, most: int = 12 * 3600) -> DataFrame:
    """id, covered: whether another run in progress began at least least seconds before this one and within most of now.

    runs: id, started.  me: id, started, now.
    """
    bounds = me.select("id", F.coalesce("started", "now").alias("mine"), "now")
    # a window of starts against few own runs: met by hour, then compared
    hours = bounds.withColumn("hour", F.explode(F.sequence(F.floor((F.col("now") - most) / 3600).cast("long"), F.floor(F.col("mine") / 3600).cast("long"))))
    r = runs.filter("started is not null").select(F.col("id").alias("other"), F.col("started").alias("s"), F.floor(F.col("started") / 3600).cast("long").alias("hour"))
    hit = hours.join(r, "hour").filter((F.col("other") != F.col("id")) & (F.col("s") > F.col("now") - most) & (F.col("s") <= F.col("mine") - least)).select("id").distinct().withColumn("hit", F.lit(True))
    return me.select("id").join(hit, "id", "left").select("id", F.coalesce("hit", F.lit(False)).alias("covered"))


def below_trigger(coverage: DataFrame, trigger: float = 95.0) -> DataFrame:
    """kind: those whose exact share is under the trigger; coverage: kind, n, covered."""
    return coverage.filter((F.col("n") > 0) & (100.0 * F.col("covered") < trigger * F.col("n"))).select("kind")


def fix_needed(coverage: DataFrame, trigger: float = 95.0) -> DataFrame:
    """One row: whether any kind is under the trigger."""
    return below_trigger(coverage, trigger).agg((F.count(F.lit(1)) > 0).alias("needed"))


def health_record(before: DataFrame, after: DataFrame, target: float = 95.0) -> DataFrame:
    """kind, n, covered, pct, pct_before, below_target; tables: kind, n, covered."""
    def pct(d: DataFrame) -> Column:
        return F.when(F.col("n") == 0, 100.0).otherwise(F.round(100.0 * F.col("covered") / F.col("n"), 1))

    b = before.select("kind", pct(before).alias("pct_before"))
    return after.join(b, "kind", "left").select("kind", "n", "covered", pct(after).alias("pct"), "pct_before", (100.0 * F.col("covered") < target * F.col("n")).alias("below_target"))


def diagnosis() -> Column:
    """The first cause why a title has no picture of its own.

    Columns: changed, aggregator, pending_days, links, readable, outcome (best of its pages), notes (array), held_days.
    """
    out, n = F.col("outcome"), F.col("notes")

    def note(part: str) -> Column:
        return F.exists(n, lambda x: F.contains(x, F.lit(part)))

    failed = out.isNotNull() & (out != "ok")
    return (
        F.when(F.col("changed"), "file changed").when(F.col("aggregator"), "aggregator's image").when(F.col("pending_days") < F.col("held_days"), "pending")
        .when(F.col("links") == 0, "no link").when(F.col("readable") == 0, "ticket pages only")
        .when(failed & F.startswith(out, F.lit("robots: unreachable")), "robots.txt unreachable").when(failed & (F.startswith(out, F.lit("robots")) | F.startswith(out, F.lit("blocked"))), "blocked").when(failed, "fetch failed")
        .when(F.size(n) == 0, F.when(out.isNull(), "not read").otherwise("no image")).when(note("no link"), "not read").when(note("page not read:"), "fetch failed").when(note("do not name the title"), "not the title's page")
        .when(note("rejected"), "rejected").when(note(": not fetched"), "fetch failed").otherwise("no image")
    )


def todo(titles: DataFrame, today: str, cap: int, hold: int = 3) -> DataFrame:
    """kind, id, place: the titles worth a request, those that failed tonight first, then other missing ones, then those whose hold is over; the first cap.

    titles: kind, id, missing, readable, failed, last, rejected, pending (date).
    """
    t = F.lit(today).cast("date")
    seen = F.coalesce(F.col("last") == t, F.lit(False)) & ~F.col("failed") & (F.col("rejected") < 5)
    group = F.when(F.col("missing") & (F.col("readable") > 0) & ~seen, F.when(F.col("failed"), 0).otherwise(1)).when(F.datediff(t, "pending") >= hold, 2)
    d = titles.withColumn("grp", group).filter("grp is not null").orderBy("grp", F.desc("kind"), "id").limit(cap)
    return d.select("kind", "id", F.col("grp").alias("place"))


def shards(items: DataFrame, target: int) -> DataFrame:
    """item, bin: longest first into the least loaded of as few bins as keep to target, where no single item exceeds it; items: group, position, item, seconds."""
    import heapq

    import pandas as pd

    def one(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values(["seconds", "position"], ascending=[False, True], ignore_index=True)
        n = max(1, -(-int(d["seconds"].sum()) // target))
        while True:
            # the least loaded bin, the first of equal ones, on top
            load, held, bins, most = [(0, b) for b in range(n)], [0] * n, [], n >= len(d)
            for s in d["seconds"].tolist():
                x, b = load[0]
                if x + s > target and held[b] and not most:
                    break
                heapq.heapreplace(load, (x + s, b))
                held[b] += 1
                bins.append(b)
            else:
                return d[["group", "item"]].assign(bin=bins)
            n += 1

    kinds = dict(items.dtypes)
    return items.groupBy("group").applyInPandas(one, f"group {kinds['group']}, item {kinds['item']}, bin long")


def fetch_verdicts(attempts: DataFrame, fails: int = 2, url_budget: float = 75.0, host_budget: float = 420.0) -> DataFrame:
    """What each attempt of a run counts for: ok, blocked, failed, over budget or host closed.

    attempts: host, url, position, status, seconds, challenge.  A host closes once fails of its urls failed, and
    once its time is spent; a url's own time is bounded too.
    """
    from pyspark.sql import Window as W

    before = W.partitionBy("host").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    own = W.partitionBy("host", "url").orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    bad = ((F.col("status") >= 400) | F.col("status").isNull()).cast("int")
    d = attempts.withColumn("bad", bad).withColumn("failed", F.coalesce(F.sum("bad").over(before), F.lit(0))).withColumn("spent", F.coalesce(F.sum("seconds").over(before), F.lit(0.0))).withColumn("mine", F.coalesce(F.sum("seconds").over(own), F.lit(0.0)))
    verdict = (
        F.when(F.col("spent") >= host_budget, "over budget").when(F.col("failed") >= fails, "host closed").when(F.col("mine") >= url_budget, "over budget")
        .when(F.coalesce("challenge", F.lit(False)), "blocked").when(F.col("bad") == 1, "failed").otherwise("ok")
    )
    return d.select("host", "url", "position", verdict.alias("verdict"))


def host_summary(attempts: DataFrame) -> DataFrame:
    """Requests, failures and seconds by host."""
    return attempts.groupBy("host").agg(F.count(F.lit(1)).alias("requests"), F.count_if((F.col("status") >= 400) | F.col("status").isNull()).alias("failures"), F.round(F.sum("seconds"), 2).alias("seconds"))


def run_flags(secondary: DataFrame, notes: DataFrame, odd_times: DataFrame, conflicts: DataFrame) -> DataFrame:
    """level, venue, message beyond each venue's status; tables: venue and n, note, or date and time."""
    def flag(d: DataFrame, message: Column) -> DataFrame:
        return d.select(F.lit("warning").alias("level"), "venue", message.alias("message"))

    short = notes.filter(F.contains("note", F.lit("known day"))).groupBy("venue").agg(F.min("note").alias("note"))
    odd = odd_times.groupBy("venue").agg(F.array_join(F.slice(F.array_sort(F.collect_set(F.concat_ws(" ", F.col("date").cast("string"), "time"))), 1, 8), "; ").alias("list"))
    clash = conflicts.groupBy("venue").agg(F.count(F.lit(1)).alias("n"))
    out = flag(secondary, F.concat(F.lit("own programme not read, a reseller's "), F.col("n").cast("string"), F.lit(" rows stand in")))
    out = out.unionByName(flag(short, F.concat(F.lit("next month not judged: "), "note")))
    out = out.unionByName(flag(odd, F.concat(F.lit("times off the grid: "), "list")))
    return out.unionByName(flag(clash, F.concat(F.col("n").cast("string"), F.lit(" times differ from the kept rows"))))


def upcoming_counts(cells: DataFrame, performances: DataFrame, shows: DataFrame, floor: str) -> DataFrame:
    """venue, n: screenings (times of a cell) and performances from floor on; shows: show, venue."""
    lo = F.lit(floor).cast("date")
    a = cells.filter(F.col("date") >= lo).select("venue", F.size("times").alias("n"))
    b = performances.filter(F.col("date") >= lo).join(shows.select("show", "venue"), "show").select("venue", F.lit(1).alias("n"))
    return a.unionByName(b).groupBy("venue").agg(F.sum("n").alias("n"))


# fixed values: what the first part of a page that refuses a reader says, in lower case
CHALLENGES = (
    ("<title>just a moment...</title>", "Cloudflare challenge"), ("cf_chl_opt", "Cloudflare challenge"), ("attention required! | cloudflare", "Cloudflare block page"),
    ("sucuri website firewall", "Sucuri firewall"), ("imunify360 bot-protection", "Imunify360 bot protection"), ("<title>ddos-guard</title>", "DDoS-Guard"),
)


def challenge(html: Column, head: int = 8192) -> Column:
    """The protection whose challenge or block page this is, else null."""
    start, out = F.lower(F.substring(html, 1, head)), F.lit(None).cast("string")
    for sign, name in reversed(CHALLENGES):
        out = F.when(F.contains(start, F.lit(sign)), name).otherwise(out)
    return out


def robots_verdict(status: Column, blocked: Column) -> Column:
    """What a host's robots.txt answer means: rules, none (allowed) or unreachable (not read this run)."""
    return F.when(blocked.isNotNull(), "unreachable").when(status.between(200, 299), "rules").when(status.between(400, 499) & (status != 429), "none").otherwise("unreachable")
