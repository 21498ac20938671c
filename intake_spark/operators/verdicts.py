"""Verdict texts: finding the JSON object, checking it against the contract, and rules that hold whatever the judge answered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.tables import staged

#: Tokens of each field and their labels.
QUALIFICATION = {"QUALIFIED": "Qualified", "MAYBE": "Needs Review", "NOT_QUALIFIED": "Not Qualified"}
PARTIES = ("BUYER", "VENDOR", "UNCLEAR")
TOKENS = {
    "account_tier": {"TIER_A": "Tier A", "TIER_B": "Tier B", "TIER_C": "Tier C"},
    "need_strength": {"STRONG": "Strong", "MODERATE": "Moderate", "WEAK": "Weak", "NOT_FOUND": "Not Found"},
    "current_approach": {"MANUAL": "Manual", "BASIC_TOOLS": "Basic Tools", "ADVANCED_SYSTEM": "Advanced System", "UNKNOWN": "Unknown"},
    "timing": {"ACTIVE_TRIGGER": "Active Trigger", "NO_TRIGGER": "No Trigger", "UNKNOWN": "Unknown"},
    "evidence_confidence": {"HIGH": "High", "MEDIUM": "Medium", "LOW": "Low"},
}
TEXTS = ("qualification_reason", "strongest_signal", "main_uncertainty", "roles_to_contact")
STRINGS = ("domain", "name", "qualification", "buyer_or_vendor", "buyer_vendor_reason", *TOKENS, *TEXTS)
REQUIRED = ("domain", "name", "status", "qualification", "buyer_or_vendor", "buyer_vendor_reason", "evidence_links", *TOKENS, *TEXTS)
LOWEST = "TIER_C"


def last_json(c: Column | str) -> Column:
    """The text if it is a JSON object, else its last line that is one once spaces and backticks are taken off; null if there is none."""
    apart = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
    # Few lines begin like an object; only those are trimmed and parsed.
    begins = lambda x: x.rlike(r"(?U)^[\s`]*\{")
    trimmed = lambda x: F.regexp_replace(x, r"(?U)^[\s`]+|[\s`]+$", "")
    last = lambda text: F.try_element_at(F.filter(F.transform(F.filter(F.split(text, apart), begins), trimmed), C.is_json_object), F.lit(-1))
    return C.let(C.strip(c), lambda text: F.when(C.is_json_object(text), text).otherwise(last(text)))


def field(v: Column | str, key: str) -> Column:
    return F.try_variant_get(F.try_parse_json(C.as_col(v)), f"$.{key}", "string")


def _problem(v: Column, parsed: Column, keys: Column) -> Column:
    of = lambda key: F.try_variant_get(parsed, f"$.{key}", "string")
    kind = lambda key: F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant"))
    status = of("status")
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys)
    wrong = F.array_compact(F.array(*[F.when(~F.coalesce(kind(k) == "STRING", F.lit(False)), k) for k in STRINGS]))
    found = F.when(~F.coalesce(F.startswith(kind("evidence_links"), F.lit("ARRAY")), F.lit(False)), "evidence_links must be a list")
    for key, allowed in [*reversed([(k, list(t)) for k, t in TOKENS.items()]), ("buyer_or_vendor", list(PARTIES)), ("qualification", list(QUALIFICATION))]:
        found = F.when(~of(key).isin(allowed), F.concat(F.lit(f"bad {key} "), of(key))).otherwise(found)
    found = F.when(C.strip(of("domain")) == "", "empty domain").otherwise(found)
    found = F.when(F.size(wrong) > 0, F.concat(F.lit("non-string values for: "), F.array_join(wrong, ", "))).otherwise(found)
    found = F.when(F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ", "))).otherwise(found)
    found = F.when(status == "error", F.lit(None)).when(~F.coalesce(status == "ok", F.lit(False)), F.concat(F.lit("verdict status "), F.coalesce(status, F.lit("None")))).otherwise(found)
    return F.when(v.isNull(), "no JSON object line in result").otherwise(found)


def verdict_problem(v: Column | str) -> Column:
    """The first breach of the contract in a JSON object text, or null. Error-shaped verdicts pass."""
    parts = lambda x: F.struct(x.alias("v"), F.try_parse_json(x).alias("parsed"), F.json_object_keys(x).alias("keys"))
    return C.let(C.let(C.as_col(v), parts), lambda r: _problem(r["v"], r["parsed"], r["keys"]))


def fields(df: DataFrame, text: str = "verdict_json") -> DataFrame:
    """df with the members of the verdict as columns, parsed once."""
    schema = ", ".join(f"{k} string" for k in ("status", "error", *STRINGS)) + ", evidence_links array<string>"
    return df.withColumn("_v", F.from_json(text, schema)).select(*df.columns, "_v.*")


def validate_verdicts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with verdict_json and problem."""
    out = df.withColumn("verdict_json", last_json(text))
    return out.withColumn("problem", verdict_problem("verdict_json"))


def accepted(df: DataFrame, text: str = "text") -> DataFrame:
    """df's other columns with the members of verdicts that keep the contract. Texts are searched and checked once, and what that gives is stored without them."""
    found = staged(validate_verdicts(df, text).select(*[c for c in df.columns if c != text], "verdict_json", "problem"), "verdicts")
    return fields(found.filter("problem IS NULL").drop("problem"))


def choose_verdict(df: DataFrame) -> DataFrame:
    """df (structured, result, saved, saved_at, started_at) with verdict_json and its origin: structured output, else the result's text,
    else a saved verdict written no earlier than a second before the start. A result that is found but breaks the contract gives way to the saved one."""
    structured = F.when(C.is_json_object("structured"), C.strip("structured"))
    result = C.let(last_json("result"), lambda x: F.when(verdict_problem(x).isNull(), x))
    saved = F.when(F.coalesce(F.unix_micros("saved_at") >= F.unix_micros("started_at") - 1_000_000, F.lit(False)), last_json("saved"))
    origin = F.when(structured.isNotNull(), "structured").when(result.isNotNull(), "result").when(saved.isNotNull(), "saved")
    return df.withColumn("verdict_json", F.coalesce(structured, result, saved)).withColumn("origin", origin)


def verdict_error(kind: Column | str, message: Column | str, result: Column | str, structured: Column | str, turns: Column | str, v: Column | str, domain: Column | str) -> Column:
    """Why an outcome gives no verdict, or null."""
    kind, message, result, structured, turns, v, domain = (C.as_col(x) for x in (kind, message, result, structured, turns, v, domain))
    empty = (C.strip(F.coalesce(result, F.lit(""))) == "") & structured.isNull() & (F.coalesce(turns, F.lit(0)) == 0)
    problem = verdict_problem(v)
    return (
        F.when(kind.isin("timeout", "transient", "error"), F.concat(kind, F.lit(": "), C.strip(F.right(F.coalesce(message, F.lit("")), F.lit(200)))))
        .when(empty, "empty result with 0 turns")
        .when(problem.isNotNull(), F.concat(F.lit("unparseable verdict: "), problem))
        .when(field(v, "status") == "error", F.concat(F.lit("skill error: "), F.coalesce(field(v, "error"), F.lit(""))))
        .when(C.normalize_domain(field(v, "domain"), "crm") != domain, F.concat(F.lit("verdict domain mismatch: "), F.coalesce(field(v, "domain"), F.lit(""))))
    )


def apply_backstop(df: DataFrame) -> DataFrame:
    """df (status, qualification, buyer_or_vendor, account_tier) after the rules, with backstop: what was changed.

    A verdict is yes or no; yes needs a buyer; no is the lowest tier; yes with the lowest tier is kept and noted.
    """
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    q, party, tier = F.col("qualification"), F.col("buyer_or_vendor"), F.col("account_tier")
    maybe, no_buyer = ok & (q == "MAYBE"), ok & (q == "QUALIFIED") & ~F.coalesce(party == "BUYER", F.lit(False))
    final = F.when(maybe | no_buyer, "NOT_QUALIFIED").otherwise(q)
    lower, odd = ok & (final == "NOT_QUALIFIED") & ~F.coalesce(tier == LOWEST, F.lit(False)), ok & (final == "QUALIFIED") & (tier == LOWEST)
    first = F.when(maybe, "MAYBE->NOT_QUALIFIED (verdicts are binary)").when(no_buyer, F.concat(F.lit("downgraded QUALIFIED->NOT_QUALIFIED (buyer_or_vendor="), F.coalesce(party, F.lit("None")), F.lit(")")))
    second = F.when(lower, F.concat(F.lit("tier "), F.coalesce(tier, F.lit("None")), F.lit(f"->{LOWEST} (not qualified)"))).when(odd, f"QUALIFIED with {LOWEST}: the verdict contradicts its tier, kept as returned")
    return df.withColumns({"qualification": final, "account_tier": F.when(lower, LOWEST).otherwise(tier), "backstop": C.blank_to_null(F.concat_ws("; ", first, second))})


def hold_tiers(df: DataFrame, tiers: list[str] | None) -> DataFrame:
    """df with held: qualified, but of a tier that is not to be written."""
    held = (F.col("qualification") == "QUALIFIED") & ~F.coalesce(F.col("account_tier").isin(tiers), F.lit(False)) if tiers else F.lit(False)
    return df.withColumn("held", F.coalesce(held, F.lit(False)))
