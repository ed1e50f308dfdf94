"""Which link a show, a screening or a cell gets, and which picture a title shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import urls

_DATE = r"(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)"
_MOMENT = r"(\d{4}-\d{2}-\d{2})(?:\||%7C)(\d{2}:\d{2})"


def link_fits(date: Column, time: Column, url: Column) -> Column:
    """Whether a web link spells no other date, nor with it another time, than its row's."""
    moment = F.regexp_extract(url, _MOMENT, 1)
    same = (moment == "") | ((moment == date.cast("string")) & (F.regexp_extract(url, _MOMENT, 2) == time))
    dates = F.regexp_extract_all(url, F.lit(_DATE), F.lit(1))
    return F.rlike(url, F.lit(r"^https?://[^\s\"<>]+$")) & same & F.forall(dates, lambda d: d == date.cast("string"))


def performance_links(performances: DataFrame, own: DataFrame, other: DataFrame, previous: DataFrame, boxonly: DataFrame, read: DataFrame) -> DataFrame:
    """KEY and url: one link a performance and one performance a link.

    own before other; a row with two links, a link of two rows, and a link that spells
    another moment give none.  Last run's link stays for a row that no source listed this run.
    All tables: show, date, time, and url where they give links.
    """
    k = ["show", "date", "time"]
    live = performances.select(*k).distinct().join(boxonly.select(*k), k, "left_anti")
    given = own.select(*k, "url", F.lit(0).alias("rank")).unionByName(other.select(*k, "url", F.lit(1).alias("rank"))).filter("url is not null").distinct()
    users = given.select(*k, "url").distinct().groupBy("url").agg(F.count(F.lit(1)).alias("users"))
    best = given.join(given.groupBy(*k).agg(F.min("rank").alias("rank")), [*k, "rank"])
    one = best.groupBy(*k).agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url")).filter("n = 1").drop("n")
    fresh = live.join(one, k).join(users.filter("users = 1").select("url"), "url").filter(link_fits(F.col("date"), F.col("time"), F.col("url"))).select(*k, "url")
    old = previous.select(*k, "url").join(live, k).join(fresh.select(*k), k, "left_anti").join(read.select(*k), k, "left_anti").join(users.select("url"), "url", "left_anti")
    old = old.filter(link_fits(F.col("date"), F.col("time"), F.col("url")))
    # of last run's rows with one link the first keeps it
    old = old.withColumn("i", F.row_number().over(W.partitionBy("url").orderBy(*k))).filter("i = 1").select(*k, "url")
    return fresh.unionByName(old)


def link_choice(official: DataFrame, secondary: DataFrame, existing: DataFrame, on_stage: DataFrame, status: DataFrame, first: str, last: str) -> DataFrame:
    """show, url, source: the page of its earliest official performance, else for shows without official rows the secondary source's.

    official: venue, show, date, time, page (null where only a purchase page is printed).  secondary: the same.  existing: show, url.  status: venue, status.
    """
    live = on_stage.select("show").distinct()
    # a show whose rows give only purchase pages is chosen to have none of its own
    rows = official.join(status.filter("status = 'official'").select("venue"), "venue", "left_semi").join(live, "show")
    window = rows.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    own = window.groupBy("show").agg(F.min_by("page", F.when(F.col("page").isNotNull(), F.struct("date", "time", "page"))).alias("url"))
    shows = rows.select("show").distinct()
    agg = secondary.join(status.filter("status <> 'unreachable'").select("venue"), "venue", "left_semi").join(live, "show").filter("page is not null").join(shows, "show", "left_anti").join(existing.select("show"), "show", "left_anti")
    agg = agg.groupBy("show").agg(F.min_by("page", F.struct("date", "time", "page")).alias("url")).withColumn("source", F.lit("secondary"))
    e = existing.select("show", F.col("url").alias("old"))
    mine = own.join(e, "show", "left").select("show", F.coalesce("url", "old").alias("url"), F.when(F.col("url").isNotNull(), "official").when(F.col("old").isNotNull(), "existing").otherwise("none").alias("source"))
    rest = e.join(own.select("show"), "show", "left_anti").select("show", F.col("old").alias("url"), F.lit("existing").alias("source"))
    return mine.unionByName(agg).unionByName(rest)


def neutral_links(shows: DataFrame, programme: DataFrame, one_time: str, page: tuple[str, str]) -> DataFrame:
    """Shows (show, venue, url) whose link is missing or one performance's: the page it derives from, else the venue's programme (venue, home), else none."""
    bad = F.col("url").isNull() | F.rlike("url", F.lit(one_time))
    derived = F.when(F.rlike("url", F.lit(page[0])), F.regexp_replace("url", page[0], page[1]))
    return shows.filter(bad).join(programme, "venue", "left").select("show", F.coalesce(derived, "home").alias("url"))


def ticket_links(screens: DataFrame, fresh: DataFrame, cells: DataFrame, hosts: list[str]) -> DataFrame:
    """film, venue, url: a screening's ticket page if the film runs there once, else the film's page, which lists every date.

    screens: film, venue, date, ticket, page.  fresh: film, venue the venue linked itself.  cells: film, venue, date, time.
    """
    def allowed(c: str) -> Column:
        return F.when(F.startswith(F.col(c), F.lit("https://")) & urls.host_in(F.col(c), hosts), F.col(c))

    slots = cells.select("film", "venue", "date", "time").distinct().groupBy("film", "venue").agg(F.count(F.lit(1)).alias("slots"))
    by = screens.groupBy("film", "venue").agg(F.count_distinct(allowed("ticket")).alias("tickets"), F.min(allowed("ticket")).alias("ticket"), F.min(allowed("page")).alias("page"))
    d = by.join(fresh.select("film", "venue").distinct(), ["film", "venue"], "left_anti").join(slots, ["film", "venue"], "left")
    return d.select("film", "venue", F.when((F.col("slots") == 1) & (F.col("tickets") == 1), F.col("ticket")).otherwise(F.col("page")).alias("url")).filter("url is not null")


def sale_states(rows: DataFrame, states: DataFrame, previous: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with the seller's state of their page: this run's, else the last one of the same page if it is still one that may be kept."""
    d = rows.join(states.select("url", F.col("state").alias("now")), "url", "left").join(previous.select("film", "venue", "date", "time", F.col("url").alias("was"), F.col("state").alias("old")), ["film", "venue", "date", "time"], "left")
    old = F.when((F.col("was") == F.col("url")) & F.col("old").isin(*keep), F.col("old"))
    return d.select(*rows.columns, F.coalesce("now", old).alias("state"))


def overlay_attributes(old: DataFrame, fresh: DataFrame, live: DataFrame) -> DataFrame:
    """film, venue, moment, value: a pair of film and venue read this run replaces last run's, and only live moments stay."""
    pair = ["film", "venue"]
    rest = old.join(fresh.select(*pair).distinct(), pair, "left_anti")
    return fresh.unionByName(rest).join(live.select(*pair, "moment").distinct(), [*pair, "moment"], "left_semi")


def prune(maps: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Entries of keyed maps whose key the catalogue still has."""
    return maps.join(known.select(key).distinct(), key, "left_semi")


def allowed_links(rows: DataFrame, allow: DataFrame, never: list[str]) -> DataFrame:
    """Rows whose link's host is on the venue's list (venue, host), or under such a host, and on no banned host."""
    d = rows.withColumn("__host", urls.host(F.col("url"))).filter(~urls.host_in(F.col("url"), never))
    labels = F.split("__host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    up = d.withColumn("host", F.explode(parents))
    return up.join(allow, ["venue", "host"], "left_semi").select(*rows.columns).distinct()


def aliases(events: DataFrame, films: DataFrame, suffixes: list[str]) -> DataFrame:
    """event, film: a cinema event that screens a catalogued film, by its titles, else by its id without a suffix.

    events: id, scope, keys (array).  films: id, keys (array).
    """
    e = events.filter("scope = 'cinema'")
    f = films.select(F.col("id").alias("film"), F.explode("keys").alias("key")).groupBy("key").agg(F.min("film").alias("film"))
    by_title = e.select(F.col("id").alias("event"), F.posexplode("keys").alias("at", "key")).join(f, "key").groupBy("event").agg(F.min_by("film", "at").alias("film"))
    base = F.explode(F.filter(F.array(*[F.when(F.endswith("id", F.lit(s)), F.struct(F.lit(i).alias("at"), F.expr(f"substring(id, 1, length(id) - {len(s)})").alias("film"))) for i, s in enumerate(suffixes)]), lambda x: x.isNotNull()))
    by_id = e.select(F.col("id").alias("event"), base.alias("x")).select("event", "x.at", "x.film").join(films.select(F.col("id").alias("film")), "film", "left_semi").groupBy("event").agg(F.min_by("film", "at").alias("film"))
    return by_title.unionByName(by_id.join(by_title.select("event"), "event", "left_anti"))


def shown_picture(ids: DataFrame, moved: DataFrame, maps: list[tuple[str, DataFrame]]) -> DataFrame:
    """id, picture, source: of the id it stands for the first map's entry; maps: (name, id, url) in order of trust."""
    d = ids.select("id").join(moved.select(F.col("old").alias("id"), "final"), "id", "left").withColumn("base", F.coalesce("final", "id"))
    for i, (_, m) in enumerate(maps):
        d = d.join(m.select(F.col("id").alias("base"), urls.safe_image(F.col("url")).alias(f"u{i}")), "base", "left")
    url = F.coalesce(*[F.col(f"u{i}") for i in range(len(maps))])
    name = F.coalesce(*[F.when(F.col(f"u{i}").isNotNull(), n) for i, (n, _) in enumerate(maps)])
    return d.select("id", url.alias("picture"), name.alias("source"))


def key_art(pictures: DataFrame, wide: float = 1.2) -> DataFrame:
    """event, url: the first wide picture in source order, else the first portrait one; pictures: event, rank, url, w, h, problem."""
    d = pictures.filter("problem is null and h > 0")
    portrait = (F.col("w") / F.col("h") < wide).cast("int")
    return d.groupBy("event").agg(F.min_by("url", F.struct(portrait.alias("p"), "rank", "url")).alias("url"))


def shared_logos(files: DataFrame, least: int = 2) -> DataFrame:
    """Digests that stand as the picture of several titles."""
    return files.groupBy("digest").agg(F.count_distinct("id").alias("n"), F.array_sort(F.collect_set("id")).alias("ids")).filter(F.col("n") >= least).select("digest", "n", F.array_join(F.slice("ids", 1, 5), ",").alias("ids"))
