"""Tables of search addresses: their parameters, what does not translate, dates, readiness, and filtering companies by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

#: Parameter in an address, the filter it becomes, and its kind.
PARAMETERS = {
    "organizationNumEmployeesRanges": ("organization_num_employees_ranges", "list"), "organizationLocations": ("organization_locations", "list"), "organizationNotLocations": ("organization_not_locations", "list"),
    "currentlyUsingAnyOfTechnologyUids": ("currently_using_any_of_technology_uids", "list"), "qOrganizationJobTitles": ("q_organization_job_titles", "list"), "organizationJobLocations": ("organization_job_locations", "list"),
    "qOrganizationKeywordTags": ("q_organization_keyword_tags", "list"), "organizationNaicsCodes": ("organization_naics_codes", "list"), "notOrganizationNaicsCodes": ("not_organization_naics_codes", "list"),
    "organizationSicCodes": ("organization_sic_codes", "list"), "notOrganizationSicCodes": ("not_organization_sic_codes", "list"), "marketSegments": ("market_segments", "list"),
    "qOrganizationDomainsList": ("q_organization_domains_list", "list"), "organizationIds": ("organization_ids", "list"), "accountLabelIds": ("account_label_ids", "list"),
    "totalFundingRange": ("total_funding_range", "range_int"), "latestFundingAmountRange": ("latest_funding_amount_range", "range_int"), "revenueRange": ("revenue_range", "range_int"),
    "organizationFoundedYearRange": ("organization_founded_year_range", "range_int"), "organizationNumJobsRange": ("organization_num_jobs_range", "range_int"), "organizationHeadcountGrowthRange": ("organization_headcount_growth_range", "range_int"),
    "latestFundingDateRange": ("latest_funding_date_range", "range_date"), "organizationJobPostedAtRange": ("organization_job_posted_at_range", "range_date"), "latestFundingDetectedAtRange": ("latest_funding_detected_at_range", "range_str"),
    "qOrganizationName": ("q_organization_name", "str"), "organizationHeadcountGrowthPastNMonths": ("organization_headcount_growth_past_n_months", "int"),
}
#: Flat parameters that fill one side of a range.
FLAT = {
    "totalFundingMin": ("total_funding_range", "min"), "totalFundingMax": ("total_funding_range", "max"),
    "latestFundingAmountMin": ("latest_funding_amount_range", "min"), "latestFundingAmountMax": ("latest_funding_amount_range", "max"),
}
#: Parameters that only describe the screen.
SCREEN_ONLY = [
    "page", "sortByField", "sortAscending", "finderViewId", "uniqueUrlId", "includedOrganizationKeywordFields", "includedAnyOfOrganizationKeywordFields", "excludedOrganizationKeywordFields",
    "displayMode", "tour", "recommendationConfigId", "finderTableLayoutId", "viewMode", "contactLabelIds", "per_page", "perPage",
]
#: Fixed values (the keys): known parameters that no filter stands for; why, and what to do instead, in our own words.
UNTRANSLATED = {
    "organizationIndustryTagIds": ("industry tags are not a filter", "filter by industry codes"), "organizationNotIndustryTagIds": ("excluding industry tags is not a filter", "exclude industry codes, or exclude by industry pattern"),
    "qNotOrganizationKeywordTags": ("excluding keywords is not a filter", "exclude by name or industry pattern, or by tag lookup"), "qKeywords": ("free text is not a filter", "use keyword tags, or drop it"),
    "personTitles": ("titles of people are not a filter", "save the companies to a list and use list mode"), "qPersonTitles": ("titles of people are not a filter", "save the companies to a list and use list mode"),
    "personSeniorities": ("seniorities of people are not a filter", "save the companies to a list and use list mode"), "organizationTradingStatus": ("trading status is not a filter", "none"),
    "intentStrengths": ("intent is not a filter", "none"), "qOrganizationSearchListId": ("a saved search is not a filter", "use list mode with its label"),
}
#: Filters that the exclusion lookup takes.
LOOKUP = [
    "currently_using_any_of_technology_uids", "latest_funding_amount_range", "latest_funding_date_range", "market_segments", "not_organization_naics_codes", "not_organization_sic_codes",
    "organization_department_or_subdepartment_counts", "organization_founded_year_range", "organization_headcount_growth_past_n_months", "organization_headcount_growth_range", "organization_include_unknown_founded_year",
    "organization_job_locations", "organization_job_posted_at_range", "organization_locations", "organization_naics_codes", "organization_not_locations", "organization_num_employees_ranges", "organization_num_jobs_range",
    "organization_sic_codes", "q_organization_job_titles", "revenue_range", "total_funding_range",
]
#: Filters that a search needs, alternatives parted by a bar.
REQUIRED = ("organization_naics_codes|organization_sic_codes", "organization_num_employees_ranges", "organization_locations")


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for k, v in pairs.items() for x in (k, v)])


def _decoded(c: Column) -> Column:
    """Decoded three times at most; what can't be decoded stays, and most texts, without a percent sign, are not tried."""
    coded = lambda x: F.contains(x, F.lit("%"))
    once = lambda x: F.when(coded(x), F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)).otherwise(x)
    return F.when(coded(c), C.let(C.let(once(c), once), once)).otherwise(c)


def _addresses(urls: DataFrame) -> DataFrame:
    """urls (search_id, url) to search_id, route, and the pairs of the query, with spaces for plus signs.

    Each is a row of an array that is exploded: no filter or column that comes after goes below it and takes the address apart again.
    """
    bare = F.coalesce(F.regexp_replace(C.strip("url"), "^[\"']+|[\"']+$", ""), F.lit(""))
    after = lambda text, mark: F.when(F.contains(text, F.lit(mark)), F.substr(text, F.instr(text, F.lit(mark)) + 1))
    parts = lambda u, fragment: F.struct(F.substring_index(fragment, "?", 1).alias("route"), F.split(F.replace(F.coalesce(after(fragment, "?"), after(F.substring_index(u, "#", 1), "?"), F.lit("")), F.lit("+"), F.lit(" ")), "&").alias("pairs"))
    fragment = lambda u: F.coalesce(F.substring_index(after(u, "#"), "\x00", 1), F.lit(""))
    address = F.transform(F.array(bare), lambda u: C.let(fragment(u), lambda f: parts(u, f)))
    return urls.select("search_id", F.explode(address).alias("a")).select("search_id", "a.route", "a.pairs")


def _param(pair: Column) -> Column:
    return C.let(F.substring_index(pair, "=", 1), _decoded)


def _base(param: Column) -> Column:
    return F.when(F.contains(param, F.lit("[")) & _shaped(param), F.substring_index(param, "[", 1)).otherwise(param)


def _shaped(param: Column) -> Column:
    return param.rlike(r"^[^\[]+(\[[^\]]*\])?$")


def address_params(urls: DataFrame) -> DataFrame:
    """urls (search_id, url) to one row per parameter: search_id, n, param, base, side, value, and whether the tab is right.

    Pairs are taken apart before they become rows: what comes after reads columns, and no filter or join repeats the decoding.
    """
    def taken(pair: Column) -> Column:
        value = C.let(F.when(F.contains(pair, F.lit("=")), F.substr(pair, F.instr(pair, F.lit("=")) + 1)).otherwise(""), _decoded)
        side = lambda p: F.when(F.contains(p, F.lit("[")) & _shaped(p), F.regexp_extract(p, r"\[([^\]]*)\]$", 1))
        return F.when(pair != "", C.let(_param(pair), lambda p: F.struct(p.alias("param"), _base(p).alias("base"), side(p).alias("side"), value.alias("value"))))

    out = _addresses(urls).select("search_id", "route", F.posexplode(F.transform("pairs", taken)).alias("n", "taken")).filter("taken IS NOT NULL")
    return out.select("search_id", "n", "route", "taken.param", "taken.value", "taken.base", "taken.side")


def _params(df: DataFrame) -> DataFrame:
    """The parameters of urls (search_id, url); a table of address_params, as one that was stored, is taken as it is."""
    return df if "base" in df.columns else address_params(df)


def _kinds(params: DataFrame) -> DataFrame:
    """params with the filter, its kind, and for known ones that do not translate why and what to do; by a table of names that is a few rows."""
    rows = [(k, f, kind, None, None, None) for k, (f, kind) in PARAMETERS.items()]
    rows += [(k, f, "range_int", side, None, None) for k, (f, side) in FLAT.items()]
    rows += [(k, None, None, None, why, instead) for k, (why, instead) in UNTRANSLATED.items()]
    schema = "base string, filter string, kind string, _flat string, known_reason string, known_fallback string"
    names = params.sparkSession.createDataFrame(rows, schema)
    return params.join(F.broadcast(names), "base", "left").withColumn("side", F.coalesce("_flat", "side"))


def search_params(urls: DataFrame) -> DataFrame:
    """Filters of each search: search_id, filter, kind, items (lists, in first-seen order), low and high (ranges), scalar. urls: see _params."""
    p = _kinds(_params(urls)).filter(F.col("filter").isNotNull())
    whole = C.to_int(F.regexp_replace("value", "[$]", "")).cast("string")  # text that is no number, or one beyond 64 bits, stays as it is
    p = p.withColumn("value", F.when(F.col("kind").isin("range_int", "int"), F.coalesce(whole, F.col("value"))).otherwise(F.col("value")))
    kind = F.substring_index("kind", "_", 1)
    p = p.filter(~((kind == "range") & ((F.col("value") == "") | ~F.coalesce(F.col("side").isin("min", "max"), F.lit(False)))))
    last = lambda test: F.max_by(F.when(test, F.col("value")), F.when(test, F.col("n")))
    return p.groupBy("search_id", "filter").agg(
        F.first("kind").alias("kind"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when((kind == "list") & (F.col("value") != ""), F.struct("n", "value")))), lambda x: x["value"])).alias("items"),
        last((kind == "range") & (F.col("side") == "min")).alias("low"), last((kind == "range") & (F.col("side") == "max")).alias("high"),
        last(F.col("kind").isin("str", "int")).alias("scalar"),
    )


def search_mode(urls: DataFrame, params: DataFrame | None = None) -> DataFrame:
    """search_id and mode; params: the urls' parameters, if they are at hand."""
    labelled = lambda base: base == "accountLabelIds"
    if params is None:
        found = _addresses(urls).select("search_id", (F.exists("pairs", lambda p: labelled(C.let(_param(p), _base))) & F.col("search_id").isNotNull()).alias("found"))
        every = found.groupBy("search_id").agg(F.bool_or("found").alias("listed"))
    else:
        listed = params.groupBy("search_id").agg(F.bool_or(labelled(F.col("base"))).alias("listed"))
        every = urls.select("search_id").distinct().join(listed, "search_id", "left")
    return every.select("search_id", F.when(F.col("listed"), "list").otherwise("net_new_search").alias("mode"))


def unmapped_params(urls: DataFrame) -> DataFrame:
    """search_id, param, value, reason, fallback of what does not translate. urls: see _params."""
    p = _kinds(_params(urls))
    team = F.col("base") == "prospectedByCurrentTeam"
    no_side = F.startswith("kind", F.lit("range")) & F.col("_flat").isNull() & ~F.coalesce(F.col("side").isin("min", "max"), F.lit(False))
    reason = (
        F.when(F.col("base").isin(SCREEN_ONLY), F.lit(None)).when(team, F.when(F.lower("value") != "no", "saved accounts only is not net new"))
        .when(no_side, "range without [min] or [max]").when(F.col("filter").isNotNull(), F.lit(None)).otherwise(F.coalesce("known_reason", F.lit("unknown parameter")))
    )
    fallback = F.when(team, "list mode").when(no_side, "set it by hand").otherwise(F.coalesce("known_fallback", F.lit("check what it does; add it to the parameters if a filter stands for it")))
    rows = p.select("search_id", "param", "value", reason.alias("reason"), fallback.alias("fallback")).filter("reason IS NOT NULL")
    routes = urls if "base" in urls.columns else _addresses(urls).filter(F.exists("pairs", lambda p: p != ""))
    wrong = routes.filter((F.col("route") != "") & ~F.col("route").isin("/companies", "/accounts", "/organizations")).select("search_id", "route").distinct()
    return rows.unionByName(wrong.select("search_id", F.concat(F.lit("#"), "route").alias("param"), F.lit("").alias("value"), F.lit("not an address of the companies tab").alias("reason"), F.lit("copy the address from the companies tab").alias("fallback")))


def resolve_date(c: Column | str, batch: Column | str) -> Column:
    """today and <n>_days/weeks/months/years_ago as dates before the batch's; any other text stays."""
    text, day = C.as_col(c), F.to_date(F.left(C.as_col(batch), F.lit(10)))
    token = F.lower(C.strip(text))
    unit = F.rtrim(F.regexp_extract(token, r"^(\d+)_(day|week|month|year)s?_ago$", 2))
    n = F.regexp_extract(token, r"^(\d+)_(day|week|month|year)s?_ago$", 1).try_cast("int")
    days = n.cast("bigint") * _map({"day": 1, "week": 7, "month": 30, "year": 365})[unit]
    known = F.datediff(day, F.lit("0001-01-01").cast("date"))  # what lies before the first year stays as it is
    return F.when(token == "today", day.cast("string")).when(days <= known, F.date_sub(day, F.least(days, known.cast("bigint")).cast("int")).cast("string")).otherwise(text)


def resolve_dates(params: DataFrame, batch: Column | str) -> DataFrame:
    dated = F.col("filter").isin("latest_funding_date_range", "organization_job_posted_at_range")
    return params.withColumns({c: F.when(dated, resolve_date(c, batch)).otherwise(F.col(c)) for c in ("low", "high")})


def search_errors(searches: DataFrame, params: DataFrame, unmapped: DataFrame, acks: DataFrame, required=REQUIRED) -> DataFrame:
    """Reasons that a search (search_id, source_url, mode) must not run yet."""
    error = lambda df, text: df.select("search_id", text.alias("error"))
    example = error(searches.filter(F.upper(F.trim("source_url")).startswith("EXAMPLE")), F.lit("the source is an example"))
    open_ = error(unmapped.join(acks.select("search_id", "param").distinct(), ["search_id", "param"], "left_anti"), F.concat(F.lit("unacknowledged unmapped filter "), "param", F.lit(": "), "reason"))
    filled = params.filter((F.size("items") > 0) | F.coalesce("low", "high", C.blank_to_null("scalar")).isNotNull()).groupBy("search_id").agg(F.collect_set("filter").alias("has"))
    known = searches.join(filled, "search_id", "left").withColumn("has", F.coalesce("has", F.array().cast("array<string>")))
    need = F.array(*[F.struct(F.lit(r).alias("name"), F.array(*[F.lit(x) for x in r.split("|")]).alias("any")) for r in required])
    missing = known.filter("mode = 'net_new_search'").select("search_id", "has", F.explode(need).alias("r")).filter(~F.arrays_overlap("has", "r.any"))
    return (
        example.unionByName(open_).unionByName(error(missing, F.concat(F.lit("required filter missing: "), "r.name")))
        .unionByName(error(known.filter((F.col("mode") == "list") & ~F.array_contains("has", "account_label_ids")), F.lit("list mode without a label")))
        .unionByName(error(known.filter(~F.col("mode").isin("list", "net_new_search")), F.concat(F.lit("unknown mode "), "mode")))
    )


def merge_search(old: DataFrame, new: DataFrame) -> DataFrame:
    """Searches (search_id, filters, acknowledged, pre_filter): new filters replace old ones and clear acknowledgements; the pre-filter stays."""
    n = new.select("search_id", F.col("filters").alias("_filters"), F.lit(True).alias("_new"))
    return old.join(n, "search_id", "full_outer").select(
        "search_id", F.when(F.col("_new"), F.col("_filters")).otherwise(F.col("filters")).alias("filters"),
        F.when(F.col("_new"), F.array().cast("array<string>")).otherwise(F.col("acknowledged")).alias("acknowledged"), "pre_filter",
    )


def acknowledge(searches: DataFrame, acks: DataFrame) -> DataFrame:
    more = acks.groupBy("search_id").agg(F.array_sort(F.collect_set("param")).alias("_more"))
    return searches.join(more, "search_id", "left").withColumn("acknowledged", F.array_union("acknowledged", F.coalesce("_more", F.array().cast("array<string>")))).drop("_more")


def exclusion_params(params: DataFrame, tags: list[str]) -> DataFrame:
    """The filters that the exclusion lookup takes, with the tags as keyword filter; nothing without tags."""
    if not tags:
        return params.limit(0)
    columns = ["filter", "kind", "items", "low", "high", "scalar"]
    tag = F.struct(F.lit("q_organization_keyword_tags").alias("filter"), F.lit("list").alias("kind"), F.array(*[F.lit(t) for t in tags]).alias("items"), *[F.lit(None).cast("string").alias(c) for c in ("low", "high", "scalar")])
    # A search's filters are a few; with them together the parameters are gone through once, for the tags as well.
    kept = params.groupBy("search_id").agg(F.collect_list(F.when(F.col("filter").isin(LOOKUP), F.struct(*columns))).alias("kept"))
    return kept.select("search_id", F.explode(F.concat("kept", F.array(tag))).alias("x")).select("search_id", "x.*")


def company_filter(df: DataFrame, spec: dict) -> DataFrame:
    """Rows that meet every entry of spec: column to a list (in, or overlap for arrays), {"not": list}, {"min", "max"}, or {"ranges": [(low, high)]}.

    Null fails a positive entry and passes a negative one.
    """
    arrays = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    for c, want in spec.items():
        column = F.col(c)
        among = lambda xs: F.arrays_overlap(column, F.array(*[F.lit(x) for x in xs])) if c in arrays else column.isin(list(xs))  # noqa: B023, E731
        if isinstance(want, dict) and "not" in want:
            test = ~F.coalesce(among(want["not"]), F.lit(False))
        elif isinstance(want, dict) and "ranges" in want:
            test = F.exists(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in want["ranges"]]), lambda r: column.between(r["a"], r["b"]))  # noqa: B023
        elif isinstance(want, dict):
            test = F.lit(True)
            test = test & (column >= want["min"]) if want.get("min") is not None else test
            test = test & (column <= want["max"]) if want.get("max") is not None else test
        else:
            test = among(want)
        df = df.filter(F.coalesce(test, F.lit(False)))
    return df


