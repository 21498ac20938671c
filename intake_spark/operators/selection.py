"""Candidate selection: cleaning, validation, first-seen dedupe, history, exclusions, reason codes and the running cap."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.tables import staged

#: Rows of one batch that one task walks through; order keys are numbers, so a batch of any size is many such runs.
RUN = 65_536
HEX24 = "^[a-f0-9]{24}$"


@dataclass(frozen=True)
class Scope:
    """What to exclude (by pattern) and what to warn about."""

    name_pattern: str = ""
    industry_pattern: str = ""
    subsidiaries: bool = False
    countries: tuple[str, ...] = ()
    headcount_min: int | None = None
    headcount_max: int | None = None


def clean_rows(df: DataFrame) -> DataFrame:
    """Raw rows in one shape; columns that the source lacks count as null. batch and order_key are carried."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    arrays = lambda *cs: F.coalesce(*[C.to_list(c) for c in cs if c in df.columns], F.lit(None).cast("array<string>"))
    total, date, stage = C.to_int(has("funding_total")), C.blank_to_null(has("latest_funding_date")), C.blank_to_null(has("latest_funding_stage"))
    return df.select(
        "batch", "order_key",
        C.normalize_domain(C.first_filled(has("domain"), has("primary_domain"), has("website_url"))).alias("domain"),
        C.blank_to_null(C.strip(has("name"))).alias("name"),
        C.first_filled(has("org_id"), has("organization_id")).alias("org_id"),
        has("account_id").alias("account_id"),
        C.blank_to_null(has("industry")).alias("industry"),
        C.to_int(has("headcount")).alias("headcount"),
        arrays("technologies", "tech").alias("tech"),
        F.when(F.coalesce(total.cast("string"), date, stage).isNotNull(), F.struct(total.alias("total"), date.alias("latest_date"), stage.alias("latest_stage"))).alias("funding"),
        arrays("job_titles").alias("job_titles"),
        C.blank_to_null(has("country")).alias("country"),
        C.strip(has("parent_company")).alias("parent_company"),
        row_problem(df).alias("problem"),
    )


def row_problem(df: DataFrame) -> Column:
    """The first thing wrong with a raw row, or null."""
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    given = C.first_filled(has("domain"), has("primary_domain"))
    found = F.lit(None).cast("string")
    checks = [((has(c) != "") & ~has(c).rlike(HEX24), f"bad {c}") for c in ("org_id", "organization_id", "account_id")]
    checks += [(given.isNotNull() & C.normalize_domain(given).isNull(), "bad domain"), (C.first_filled(has("name"), given).isNull(), "no name or domain")]
    for test, reason in reversed(checks):
        found = F.when(F.coalesce(test, F.lit(False)), reason).otherwise(found)
    return found


def keyword_excluded(df: DataFrame, tags: list[str]) -> Column:
    """Whether keywords or industry contain a tag, in any case."""
    text = F.lower(F.concat_ws(", ", "keywords", "industry"))
    return F.coalesce(F.exists(F.array(*[F.lit(t.lower()) for t in tags]), lambda t: F.contains(text, t)), F.lit(False)) if tags else F.lit(False)


def seen_domains(queue: DataFrame, but: str | None = None) -> DataFrame:
    """Distinct domains of all batches but one."""
    rows = queue if but is None else queue.filter(F.col("batch") != but)
    return rows.select(C.normalize_domain("domain").alias("domain")).filter("domain IS NOT NULL").distinct()


def row_key() -> Column:
    return F.coalesce(F.col("domain"), F.concat(F.lit("name:"), F.coalesce(F.lower("name"), F.lit(""))))


def first_seen(df: DataFrame) -> DataFrame:
    """The first row of each key in a batch; rows with neither domain nor name are dropped."""
    place = Window.partitionBy("batch", "_key").orderBy("order_key")
    return df.withColumn("_key", row_key()).filter("_key <> 'name:'").withColumn("_n", F.row_number().over(place)).filter("_n = 1").drop("_key", "_n")


def net_new(df: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of domains not seen before, rows that resurfaced)."""
    return df.join(seen, "domain", "left_anti"), df.join(seen, "domain", "left_semi")


def flag_excluded(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """df with `excluded`: whether the list holds its org id or its domain; two equi-joins, one per key."""
    key = lambda c, flag: excluded.filter(F.col(c).isNotNull()).select(c).distinct().withColumn(flag, F.lit(True))
    return df.join(key("org_id", "_by_id"), "org_id", "left").join(key("domain", "_by_domain"), "domain", "left").withColumn(
        "excluded", F.coalesce("_by_id", F.lit(False)) | F.coalesce("_by_domain", F.lit(False))
    ).drop("_by_id", "_by_domain")


def prefilter(scope: Scope) -> Column:
    """The first reason to leave a row out by what is known of it, or null."""
    reason = F.lit(None).cast("string")
    checks = []
    if scope.name_pattern:
        checks.append((F.col("name").rlike(f"(?iU){scope.name_pattern}"), "name_match"))
    if scope.industry_pattern:
        checks.append((F.col("industry").rlike(f"(?iU){scope.industry_pattern}"), "industry_match"))
    if scope.subsidiaries:
        checks.append((F.col("parent_company") != "", "subsidiary"))
    for test, why in reversed(checks):
        reason = F.when(F.coalesce(test, F.lit(False)), why).otherwise(reason)
    return reason


def scope_warnings(scope: Scope) -> Column:
    """Array of what is outside the scope; never a reason to leave a row out."""
    out = []
    if scope.countries:
        allowed = F.array(*[C.country(F.lit(c)) for c in scope.countries])
        found = C.country("country")
        out.append(F.when((found != "") & ~F.array_contains(allowed, found), F.concat(F.lit("country="), "country")))
    low, high = (F.lit(x).cast("bigint") for x in (scope.headcount_min, scope.headcount_max))
    outside = F.coalesce(F.col("headcount") < low, F.lit(False)) | F.coalesce(F.col("headcount") > high, F.lit(False))
    out.append(F.when(outside, F.concat(F.lit("headcount="), F.col("headcount").cast("string"))))
    return F.array_compact(F.array(*out))


def count_before(df: DataFrame, flags: dict[str, str], totals: dict[str, str] | None = None, below: tuple[str, Column] | None = None) -> DataFrame:
    """df with, for each new column of flags, how many rows of its batch come earlier and have the flag: sums by run of order keys first,
    then inside each run. totals: new columns with the flag's count in the whole batch, by names of columns of flags.

    below: a new column and its bound; only rows with less are kept, and runs that begin at the bound or beyond are dropped by the sums alone, before
    any row is sorted.
    """
    df = df.withColumn("_run", F.floor(F.col("order_key") / RUN).cast("long"))
    earlier = Window.partitionBy("batch").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("batch", "_run").orderBy("order_key").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("batch", "_run").agg(*[F.count_if(flag).alias(f"_sum_{into}") for into, flag in flags.items()])
    bases = [F.coalesce(F.sum(f"_sum_{into}").over(earlier), F.lit(0)).alias(f"_base_{into}") for into in flags]
    whole = [F.sum(f"_sum_{of}").over(Window.partitionBy("batch")).alias(into) for into, of in (totals or {}).items()]
    sums = sums.select("batch", "_run", *bases, *whole)
    near = df.join(sums, ["batch", "_run"])
    if below is not None:
        near = near.filter(F.col(f"_base_{below[0]}") < below[1])
    counted = near.withColumns({into: F.col(f"_base_{into}") + F.coalesce(F.sum(F.col(flag).cast("long")).over(inside), F.lit(0)) for into, flag in flags.items()})
    kept = counted if below is None else counted.filter(F.col(below[0]) < below[1])
    return kept.drop("_run", *[f"_base_{into}" for into in flags])


def cap_pending(df: DataFrame, cap: int) -> DataFrame:
    """Rows up to the one with which `cap` rows of the batch are pending; what comes later is untouched."""
    flagged = df.withColumn("_pending", F.coalesce(F.col("status") == "pending", F.lit(False)))
    return count_before(flagged, {"_before": "_pending"}, below=("_before", F.lit(cap))).drop("_pending", "_before")


def search_signals(filters: dict | None) -> Column:
    """What every row of a search has matched on, from its filters, as a map; filters that are not set are left out."""
    given = filters or {}
    low = lambda name: (given.get(name) or {}).get("min")
    # Names of what a row has matched on, and the filters that say so.
    return C.search_signals(
        technologies_any=given.get("currently_using_any_of_technology_uids"),
        job_titles_any=given.get("q_organization_job_titles"),
        job_posted_since=low("organization_job_posted_at_range"),
        total_funding_min=low("total_funding_range"),
        latest_funding_since=low("latest_funding_date_range"),
        naics=given.get("organization_naics_codes"),
        keyword_tags=given.get("q_organization_keyword_tags"),
    )


@dataclass(frozen=True)
class Earlier:
    """What was selected of batches of which more rows come now: counts (batch, pending, ranked), and keys (batch, key) of their candidates, as row_key gives them."""

    counts: DataFrame
    keys: DataFrame


def walk(rows: DataFrame, seen: DataFrame, excluded: DataFrame, scope: Scope, cap: int, filters: dict | None = None, earlier: Earlier | None = None) -> DataFrame:
    """Every row that the selection gets to, cleaned, with status (invalid, resurfaced, pending or skipped_prefilter), skip_reason, source_rank
    and search_signals (what the filters of the search say of each row). With `earlier`, the walk goes on where that of earlier rows has ended."""
    # A bad row is a key of its own, so that the filter is on the rank alone and Spark drops later rows of a frequent key before the shuffle.
    df = clean_rows(rows).withColumn("_bad", F.col("problem").isNotNull())
    df = df.withColumn("_key", F.when(F.col("_bad"), F.concat(F.lit("bad:"), F.col("order_key").cast("string"))).otherwise(row_key())).filter("_key <> 'name:'")
    place = Window.partitionBy("batch", "_bad", "_key").orderBy("order_key")
    df = df.withColumn("_n", F.row_number().over(place)).filter("_n = 1")
    if earlier is not None:
        df = df.join(earlier.keys.select("batch", F.col("key").alias("_key")), ["batch", "_key"], "left_anti")
    df = flag_excluded(df, excluded).join(seen.withColumn("_seen", F.lit(True)), "domain", "left")
    reason = F.when(F.col("domain").isNull(), "no_domain").when(F.col("excluded"), "excluded_keyword_tag").otherwise(prefilter(scope))
    status = F.when(F.col("_bad"), "invalid").when(F.col("_seen"), "resurfaced").when(reason.isNull(), "pending").otherwise("skipped_prefilter")
    df = df.withColumn("status", status).withColumn("skip_reason", F.when(F.col("status") == "skipped_prefilter", reason)).withColumn("scope_warnings", scope_warnings(scope))
    df = df.drop("_key", "_bad", "_n", "_seen", "excluded").withColumns({"_pending": F.col("status") == "pending", "_candidate": F.col("status").isin("pending", "skipped_prefilter")})
    df = staged(df.withColumn("search_signals", search_signals(filters)), "walk")  # counted and joined below, but computed once
    had, ranked, left = F.lit(0), F.lit(0), F.lit(cap)
    if earlier is not None:
        df = df.join(earlier.counts.select("batch", F.col("pending").alias("_had"), F.col("ranked").alias("_ranked")), "batch", "left")
        had, ranked = F.coalesce("_had", F.lit(0)), F.coalesce("_ranked", F.lit(0))
        left = F.lit(cap) - had
    # All candidates before a kept one are kept, so the rank among candidates comes from the same pass as the cap.
    counted = count_before(df, {"_before": "_pending", "_rank": "_candidate"}, below=("_before", left))
    return counted.withColumn("source_rank", F.when(F.col("_candidate"), ranked + F.col("_rank") + 1)).drop("_pending", "_candidate", "_before", "_rank", "_had", "_ranked")


def select_candidates(
    rows: DataFrame, seen: DataFrame, excluded: DataFrame, scope: Scope, cap: int, filters: dict | None = None, earlier: Earlier | None = None
) -> DataFrame:
    """The candidates of each batch, pending and skipped, ranked in source order."""
    return walk(rows, seen, excluded, scope, cap, filters, earlier).filter(F.col("status").isin("pending", "skipped_prefilter")).drop("problem")


def selection_summary(walked: DataFrame, rows: DataFrame, cap: int) -> DataFrame:
    """Counts per batch of rows given and of what became of those walked through."""
    of = lambda s: F.count_if(F.col("status") == s)
    counts = walked.groupBy("batch").agg(
        of("pending").alias("pending"), of("skipped_prefilter").alias("prefiltered"), of("resurfaced").alias("resurfaced"), of("invalid").alias("invalid"),
        F.count_if(F.coalesce(F.col("skip_reason") == "excluded_keyword_tag", F.lit(False))).alias("excluded"),
    )
    return rows.groupBy("batch").agg(F.count("*").alias("rows")).join(counts, "batch", "left").na.fill(0).withColumn("need_more", F.col("pending") < cap)


def skip_counts(candidates: DataFrame) -> DataFrame:
    return candidates.filter("skip_reason IS NOT NULL").groupBy("skip_reason").agg(F.count("*").alias("n"))


def walk_accounts(accounts: DataFrame, seen: DataFrame, scope: Scope, tags: list[str], filters: dict | None = None) -> DataFrame:
    """The rows of an accounts export (as read with a batch id), all walked; rows with an excluded tag count as excluded."""
    tagged = accounts.filter(keyword_excluded(accounts, tags)).select(F.lit(None).cast("string").alias("org_id"), C.normalize_domain("domain").alias("domain")).distinct()
    return walk(accounts, seen, tagged, scope, 1 << 62, filters)


def import_accounts(accounts: DataFrame, seen: DataFrame, scope: Scope, tags: list[str], filters: dict | None = None) -> DataFrame:
    """An accounts export as candidates."""
    return walk_accounts(accounts, seen, scope, tags, filters).filter(F.col("status").isin("pending", "skipped_prefilter")).drop("problem")


def import_counts(walked: DataFrame, accounts: DataFrame) -> DataFrame:
    """What an import would do, without doing it: (batch, what, n) with rows, to_qualify, already_queued, invalid, and skipped by reason."""
    kinds = F.create_map(*[F.lit(x) for pair in (("pending", "to_qualify"), ("resurfaced", "already_queued"), ("invalid", "invalid")) for x in pair])
    what = F.coalesce(kinds[F.col("status")], F.concat(F.lit("skipped: "), "skip_reason"))
    given = accounts.groupBy("batch").agg(F.count("*").alias("n")).select("batch", F.lit("rows").alias("what"), "n")
    return given.unionByName(walked.groupBy("batch", what.alias("what")).agg(F.count("*").alias("n")))
