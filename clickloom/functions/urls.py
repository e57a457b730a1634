"""URL decoding, page signatures and traffic-source attribution, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: first match in this order wins ----------------------------
SOURCE_RULES_HEAD = (
    ("facebook", "fb"),
    ("fb", "fb"),
    ("DPA", "fb"),
    ("g(?:oogle)?ad", "gad"),
    ("google", "google search"),
)
SOURCE_RULES_MIDDLE = (
    ("line", "line"),
    ("youtube", "youtube"),
    (r"yt[\W]", "youtube"),
    ("yahoo", "yahoo"),
    (r"bing[\W]", "microsoft"),
    ("instagram(?:Shopping)?", "instagram"),
    ("^ig(?:Shopping)?", "instagram"),
)
SOURCE_RULES_TAIL = (
    ("shopback", "shopback"),
    ("(ins(ider)?)(?!tagram)", "insider"),
    ("Aideal", "appier"),
    ("app-carousel", "app-carousel"),
    ("sms", "sms"),
    ("EDM", "EDM"),
    ("weixin", "weixin"),
)
KNOWN_SOURCES = (
    "all", "fb", "google search", "line", "youtube", "yahoo", "instagram", "other", "microsoft",
    "sms", "criteo", "shopback", "appier", "ichannels", "gad", "bridgewell", "insider",
)
BROWSER_APPS = {10: "line", 11: "weixin", 12: "fb", 13: "instagram"}
MISSING_URLS = ("None", "", "_", "-1")
SIGNATURE_BYTES = 60
# ----------------------------------------------------------------------------


def source_rules(
    own: Iterable[tuple[str, str]] = (), own_late: Iterable[tuple[str, str]] = ()
) -> list[tuple[str, str]]:
    """Ordered (pattern, source) rules; a publisher's own ad networks slot in where named.

    ``own`` is tried right after the search engines, ``own_late`` after the social apps.
    """
    return [*SOURCE_RULES_HEAD, *own, *SOURCE_RULES_MIDDLE, *own_late, *SOURCE_RULES_TAIL]


def url_key(c: Column) -> Column:
    """Lower-cased URL without its query string."""
    return F.lower(F.split(c, r"\?")[0])


def percent_decode(c: Column) -> Column:
    """Percent-decode; ``+`` stays a plus and text with broken escapes is returned unchanged."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def last_param(url: Column, name: str) -> Column:
    """Value of the last ``name=`` query parameter, or null."""
    return F.try_element_at(F.regexp_extract_all(url, F.lit(f"{name}=([^&]+)"), 1), F.lit(-1))


def url_host(url: Column) -> Column:
    return F.try_element_at(F.split(url, "/"), F.lit(3))


def _first_rule(value: Column, rules: Sequence[tuple[str, str]], border: bool) -> Column:
    chain = None
    for pattern, label in rules:
        regex = rf"(?i)(?:\W|^)(?:{pattern})" if border else rf"(?i){pattern}"
        hit = value.rlike(regex)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain


def utm_source(url: Column, rules: Sequence[tuple[str, str]] | None = None) -> Column:
    """Mapped last ``utm_source``, else mapped last ``utm_medium``, else null."""
    rules = rules or source_rules()
    tag = F.coalesce(last_param(url, "utm_source"), last_param(url, "utm_medium"))
    return F.coalesce(_first_rule(tag, rules, border=False), tag)


def browser_app(code: Column) -> Column:
    pairs = [x for k, v in BROWSER_APPS.items() for x in (F.lit(str(k)), F.lit(v))]
    return F.element_at(F.create_map(*pairs), code.cast("string"))


def traffic_source(
    referrer: Column,
    current: Column,
    browser: Column | None = None,
    rules: Sequence[tuple[str, str]] | None = None,
) -> Column:
    """Raw traffic source of one page view.

    Order: UTM tags of the current URL, in-app browser, ``other`` for unusable URLs, the
    referrer's domain when it differs from ours, UTM tags of the referrer, the referrer's domain.
    """
    rules = rules or source_rules()
    last = F.coalesce(referrer, F.lit("None"))
    now = F.coalesce(current, F.lit("None"))

    def slashes(url: Column) -> Column:
        return F.char_length(url) - F.char_length(F.replace(url, F.lit("/"), F.lit("")))

    unusable = (
        last.isin(*MISSING_URLS) | now.isin(*MISSING_URLS) | (slashes(last) < 2) | (slashes(now) < 2)
    )
    foreign = F.when(url_host(now) != url_host(last), _first_rule(url_host(last), rules, border=True))
    app = F.when(browser != "", browser) if browser is not None else F.lit(None).cast("string")
    return F.coalesce(
        utm_source(now, rules),
        app,
        F.when(unusable, F.lit("other")),
        foreign,
        utm_source(last, rules),
        url_host(last),
    )


BORDER = "\x01"


def _marked(text: Column) -> Column:
    return F.regexp_replace(text, r"(\W)", "$1" + BORDER)


def canonical_source(
    source: Column,
    web_id: Column,
    domain: Column,
    subdomain: Column | None = None,
    own_aliases: dict[str, str] | None = None,
    app_hosts: Iterable[str] = (),
    blog_networks: Iterable[str] = (),
    known: Iterable[str] = KNOWN_SOURCES,
) -> Column:
    """Fold a raw source to the tenant itself (internal), a known source, or ``other``.

    ``app_hosts`` are hosts of shop applications that count as internal, ``blog_networks`` parts of host names
    that do. The source text is searched literally behind a character that is no word character: both sides get a
    mark behind each such character, by one constant pattern, and a plain search follows.
    """
    low = F.lower(source)
    wanted = F.concat(F.lit(BORDER), _marked(low))
    internal = _marked(F.lower(domain)).contains(wanted)
    if subdomain is not None:
        internal = internal | F.coalesce(_marked(F.lower(subdomain)).contains(wanted), F.lit(False))
    for host in app_hosts:
        internal = internal | F.lit(host).contains(low)
    blog = F.lit(False)
    for name in blog_networks:
        blog = blog | low.contains(name)
    result = F.when(domain.isNull(), F.lit("other")).when(internal, web_id)
    result = result.when(low.isin(*known, *(own_aliases or {}).values()), low)
    for alias, label in (own_aliases or {}).items():
        result = result.when(low == alias, F.lit(label))
    return result.when(blog, web_id).otherwise(F.lit("other"))


def url_signature(
    df: DataFrame,
    rules: DataFrame,
    url: str = "url",
    tenant: str = "web_id",
    out: str = "article_id",
    max_bytes: int = SIGNATURE_BYTES,
    always_hash: Iterable[str] = (),
    decode: Column | None = None,
    ignore_case: bool = False,
    prefix: bool = True,
) -> DataFrame:
    """Page signature by tenant rule: ``rules`` has (tenant, pattern, group), one row per tenant.

    No match falls back to the tenant id when the URL names it, else ``_``. A tenant without a
    rule gets ``_``. Signatures over ``max_bytes`` UTF-8 bytes are replaced by their SHA-256.
    A group the pattern does not have counts as a failed rule.
    """
    spec = rules.select(
        F.col(tenant),
        (F.lower("pattern") if ignore_case else F.col("pattern")).alias("_pattern"),
        F.col("group").alias("_group"),
        F.size(F.regexp_extract_all("pattern", F.lit(r"(?<!\\)\((?!\?)"), 0)).alias("_groups"),
    )
    text = F.lower(F.col(url)) if ignore_case else F.col(url)
    if decode is not None:
        text = F.when(decode, percent_decode(text)).otherwise(text)
    joined = df.withColumn("_text", text).join(spec, tenant, "left")
    usable = F.col("_pattern").isNotNull() & (F.col("_group") <= F.col("_groups"))
    # the group index is clamped so that an unusable rule never raises inside the extraction
    raw = F.expr("regexp_extract(_text, _pattern, least(_group, _groups))")
    matched = usable & F.rlike(F.col("_text"), F.col("_pattern"))
    hashed = (F.octet_length(raw) > max_bytes) | F.col(tenant).isin(*always_hash)
    body = F.when(hashed, F.sha2(raw, 256)).otherwise(raw)
    signature = F.concat_ws("_", F.col(tenant), body) if prefix else body
    fallback = F.when(
        F.col("_pattern").isNotNull() & F.col("_text").contains(F.col(tenant)), F.col(tenant)
    ).otherwise(F.lit("_"))
    return joined.withColumn(out, F.when(matched, signature).otherwise(fallback)).drop(
        "_text", "_pattern", "_group", "_groups"
    )
