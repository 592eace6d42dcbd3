"""Hits to full-text locations: an ordered list of rules, two of them fed by snapshot tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill import schemas
from quillmill.operators.joins import hot_keys, salted_lookup

# DOI prefixes and URL forms
ARXIV_DOI = "10.48550/arxiv."
ACM_DOI = "10.1145/"
PREPRINTS_DOI = "10.20944/preprints"
OSF_DOI = "10.31219/osf.io/"
AUTHOREA_DOI = "10.22541/au."
ARXIV_PDF = "https://arxiv.org/pdf/%s.pdf"
PMC_PDF = "https://www.ncbi.nlm.nih.gov/pmc/articles/%s/pdf"
ACM_PDF = "https://dl.acm.org/doi/pdf/%s"
OSF_PDF = "https://osf.io/%s/download"
AUTHOREA_PDF = "https://www.authorea.com/doi/pdf/%s"
PMC_HOST = "ncbi.nlm.nih.gov"
FETCH_HEADERS = {
    "User-Agent": "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36",
    "Accept": "application/pdf,application/x-pdf,application/octet-stream,*/*",
    "Accept-Language": "en-US,en;q=0.5",
    "Accept-Encoding": "gzip, deflate, br",
    "Connection": "keep-alive",
    "Upgrade-Insecure-Requests": "1",
    "Sec-Fetch-Dest": "document",
    "Sec-Fetch-Mode": "navigate",
    "Sec-Fetch-Site": "none",
    "Sec-Fetch-User": "?1",
    "Cache-Control": "max-age=0",
}
PMC_FETCH_HEADERS = {
    "Referer": "https://www.ncbi.nlm.nih.gov/",
    "Accept": "application/pdf,application/x-pdf,application/octet-stream,*/*",
    "DNT": "1",
}


@dataclass(frozen=True)
class Rule:
    """A resolver: the URL it gives (NULL when it does not apply) and the tag of its results.

    ``local`` rules need only the hit's own columns; the others also read the columns
    ``oa_pdf_url`` and ``pmcid`` of the snapshots.
    """

    name: str
    url: Callable[[], Column]
    tag: Callable[[], Column]
    local: bool = True


def _doi() -> Column:
    return F.lower(F.col("doi"))


def _after(prefix: str) -> Column:
    """The rest of the lower-cased DOI; NULL when it does not start with ``prefix``."""
    return F.when(_doi().startswith(prefix), F.substring(_doi(), len(prefix) + 1, 2**31 - 1))


def _filled(form: str, value: Column) -> Column:
    """The URL form with ``value`` in its place; NULL for a NULL value, unlike ``format_string``."""
    before, after = form.split("%s")
    return F.concat(F.lit(before), value, F.lit(after))


def _tag(name: str) -> Callable[[], Column]:
    return lambda: F.lit(name)


def _non_empty(value: Column) -> Column:
    return F.when(value != "", value)


DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("direct_pdf", lambda: F.when(F.col("url").endswith(".pdf"), F.col("url")), lambda: F.col("source")),
    Rule("arxiv", lambda: _filled(ARXIV_PDF, _after(ARXIV_DOI)), _tag("arxiv")),
    Rule("unpaywall", lambda: _non_empty(F.col("oa_pdf_url")), _tag("unpaywall"), local=False),
    Rule("pmc", lambda: _filled(PMC_PDF, _non_empty(F.col("pmcid"))), _tag("pmc"), local=False),
    Rule("acm", lambda: F.when(_doi().startswith(ACM_DOI), _filled(ACM_PDF, _doi())), _tag("acm")),
    Rule(
        "preprints",
        lambda: F.when(
            _doi().startswith(PREPRINTS_DOI) & F.col("url").contains("/manuscript/"),
            F.concat(F.rtrim(F.col("url"), F.lit("/")), F.lit("/download/pdf")),
        ),
        _tag("preprints"),
    ),
    Rule("osf", lambda: _filled(OSF_PDF, F.replace(_after(OSF_DOI), F.lit("_v1"), F.lit(""))), _tag("osf")),
    Rule(
        "authorea",
        lambda: F.when(_doi().startswith(AUTHOREA_DOI), _filled(AUTHOREA_PDF, _doi())),
        _tag("authorea"),
    ),
)


def _matched(rule: Rule, url: Column) -> Column:
    return F.when(url.isNotNull(), F.struct(url.alias("pdf_url"), rule.tag().alias("resolver_source")))


def first_match(rules: Sequence[Rule]) -> Column:
    """``struct(pdf_url, resolver_source)`` of the first rule that applies, else NULL."""
    nothing = F.lit(None).cast("struct<pdf_url:string,resolver_source:string>")
    return F.coalesce(*[_matched(rule, rule.url()) for rule in rules], nothing)


def open_access_lookup(snapshot: DataFrame) -> DataFrame:
    """One row per lower-cased DOI with its non-empty PDF URL (the least one of several)."""
    found = snapshot.select(F.lower("doi").alias("_ldoi"), F.col("best_oa_location.url_for_pdf").alias("oa_pdf_url"))
    return found.filter(F.col("oa_pdf_url") != "").groupBy("_ldoi").agg(F.min("oa_pdf_url").alias("oa_pdf_url"))


def pmc_lookup(snapshot: DataFrame) -> DataFrame:
    """One row per lower-cased DOI: the ``pmcid`` of its first-ranked record, also when that is NULL."""
    ranked = snapshot.select(F.lower("doi").alias("_ldoi"), "rank", "pmcid")
    return ranked.groupBy("_ldoi").agg(F.min_by("pmcid", "rank").alias("pmcid"))


def resolve(
    hits: DataFrame,
    oa_snapshot: DataFrame,
    pmc_snapshot: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    order: str = "ord",
    salts: int = 16,
) -> DataFrame:
    """All hits with ``pdf_url`` and ``resolver_source``, both NULL when no rule applies.

    Rules that stand before the first snapshot rule are tried alone; only hits that
    they leave open and that have a DOI are shuffled to the snapshots. Hits without a DOI go on to the later rules
    where they are, with nothing found in the snapshots. DOIs of very many hits are found
    by a sketch and spread; ``salts=1`` drops that, for hits that are already one per DOI.
    """
    first_lookup = next((i for i, rule in enumerate(rules) if not rule.local), len(rules))
    has_doi = F.col("doi").isNotNull() & (F.col("doi") != "")
    tried = hits.withColumn("_found", first_match(rules[:first_lookup]))
    rest = list(rules[first_lookup:])
    needs_lookup = F.col("_found").isNull() & has_doi if rest else F.lit(False)
    nothing = {c: F.lit(None).cast("string") for c in ("oa_pdf_url", "pmcid")}
    settled = tried.filter(~F.coalesce(needs_lookup, F.lit(False))).withColumns(nothing | {"_ldoi": _doi()})
    settled = settled.withColumn("_found", F.coalesce("_found", first_match(rest))).drop("_ldoi", *nothing)
    waiting = tried.filter(needs_lookup).drop("_found").withColumn("_ldoi", _doi())
    hot = hot_keys(waiting, "_ldoi") if rest and salts > 1 else []
    enriched = salted_lookup(waiting, open_access_lookup(oa_snapshot), "_ldoi", order, salts, hot)
    enriched = salted_lookup(enriched, pmc_lookup(pmc_snapshot), "_ldoi", order, salts, hot)
    looked_up = enriched.withColumn("_found", first_match(rest))
    everything = settled.unionByName(looked_up.drop("_ldoi", "oa_pdf_url", "pmcid"))
    return everything.select(
        *hits.columns,
        F.col("_found.pdf_url").alias("pdf_url"),
        F.col("_found.resolver_source").alias("resolver_source"),
    )


def keep_resolved(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("pdf_url").isNotNull())


def keep_unresolved(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("pdf_url").isNull()).select(*schemas.HIT_COLUMNS)


def candidate_urls(pdf_url: Column) -> Column:
    """URLs to try, in order: for the PMC host first the form with a slash after ``/pdf``."""
    alternate = F.when(
        pdf_url.contains(PMC_HOST) & pdf_url.contains("/pdf"), F.replace(pdf_url, F.lit("/pdf"), F.lit("/pdf/"))
    )
    return F.array_compact(F.array(alternate, pdf_url))


def _string_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for item in values.items() for part in item])


def fetch_headers(pdf_url: Column) -> Column:
    """Request headers as a map; the PMC host gets its own on top."""
    base_only = {k: v for k, v in FETCH_HEADERS.items() if k not in PMC_FETCH_HEADERS}
    return F.when(
        pdf_url.contains(PMC_HOST), F.map_concat(_string_map(base_only), _string_map(PMC_FETCH_HEADERS))
    ).otherwise(_string_map(FETCH_HEADERS))


def fetch_plan(resolved: DataFrame) -> DataFrame:
    """One row per URL to try: ``(pdf_url, try_no, request_url, headers)``."""
    kept = keep_resolved(resolved)
    tries = kept.select("pdf_url", F.posexplode(candidate_urls(F.col("pdf_url"))), fetch_headers(F.col("pdf_url")).alias("headers"))
    return tries.select("pdf_url", F.col("pos").alias("try_no"), F.col("col").alias("request_url"), "headers")
