"""F*, T*, M*, R*: scalar functions over whole tables."""

from __future__ import annotations

import datetime as dt


from pyspark.sql import functions as F

from clickloom.catalog.registry import query, with_
from clickloom.catalog.tables import KEY_SQL, TAGS, event_key, table, tags, texts
from clickloom.functions import arrays, dates, maths, text as tx, urls
from clickloom.operators import keywords, stats
from clickloom.sources.logs import spread_by


def documents(spark, sf):
    return texts(spark, sf)


def hashed(c):
    return F.md5(c)


# --- text: whole texts in, MD5 of the whole result out --------------------------------------------
TEXT_FUNCTIONS = {
    "F1_strip_urls": (lambda c: tx.strip_urls(c), "regexp_replace(text, 'https://([0-9a-zA-Z./]*)', '\\1', 'g')"),
    "F1_drop_urls": (lambda c: tx.strip_urls(c, True), "regexp_replace(text, '[https]{4,5}://[0-9a-zA-Z./]*', '', 'g')"),
    "F2_strip_symbols": (tx.strip_symbols, "regexp_replace(text, '[-!.~&+_～:，/]', '', 'g')"),
    "F3_keep_runs": (
        lambda c: tx.keep_runs(c, "[一-鿿a-zA-Z]+"),
        "array_to_string(regexp_extract_all(text, '[一-鿿a-zA-Z]+'), ' ')",
    ),
    "F4_drop_latin_digits": (tx.drop_latin_digits, "regexp_replace(text, '[A-Za-z0-9]+', '', 'g')"),
    "F11_map_chars": (
        lambda c: tx.map_chars(c, {"é": "e", "è": "e", "ç": "c", "ü": "u", "ñ": "n"}),
        "translate(text, 'éèçüñ', 'eecun')",
    ),
}


def _text_query(name, fn, sql):
    @query(name, f"SELECT doc_id, md5({sql}) AS digest FROM documents")
    def run(spark, sf):
        return documents(spark, sf).select("doc_id", hashed(fn(F.col("text"))).alias("digest"))


for _name, (_fn, _sql) in TEXT_FUNCTIONS.items():
    _text_query(_name, _fn, _sql)


@query(
    "F5_short_pieces",
    """SELECT doc_id, len(w) AS pieces, md5(array_to_string(w, '|')) AS digest FROM (SELECT doc_id,
  list_filter(string_split(replace(regexp_replace(text, '[\\[\\]"]', '', 'g'), '，', ','), ','), lambda x: x <> '') AS w FROM documents)""",
)
def short_pieces(spark, sf):
    pieces = tx.short_pieces(tx.drop_brackets(F.col("text")))
    return documents(spark, sf).select(
        "doc_id", F.size(pieces).cast("long").alias("pieces"), hashed(F.array_join(pieces, "|")).alias("digest")
    )


SPLIT = r"string_split_regex(text, '[\s,.]+')"


def words(spark, sf):
    # shared out by id: words are counted per document where the text is
    rows = spread_by(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", F.explode(F.split("text", r"[\s,.]+")).alias("word"))


STOP_SQL = r"SELECT DISTINCT lower(w) FROM (SELECT unnest(string_split_regex(text, '[\s,.]+')) AS w FROM benchmark)"


def stop_words(spark, sf):
    return table(spark, sf, "benchmark").select(F.explode(F.split("text", r"[\s,.]+")).alias("word"))


@query(
    "F6_stopwords",
    f"""SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({SPLIT}) AS word FROM documents)
  WHERE word <> ' ' AND lower(word) NOT IN ({STOP_SQL}) GROUP BY 1, 2""",
)
def stopwords(spark, sf):
    stop = stop_words(spark, sf).select(F.lower("word").alias("_low")).distinct()
    counts = words(spark, sf).where(F.col("word") != " ").groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return counts.withColumn("_low", F.lower("word")).join(stop, "_low", "left_anti").drop("_low")


@query(
    "F7_shaped_tokens",
    f"""SELECT word, CAST(regexp_full_match(word, '[0-9]{{2}}') AS INTEGER) AS two, CAST(regexp_full_match(word, '[0-9.]*') AS INTEGER) AS num,
  CAST(regexp_full_match(word, '[a-z]{{1,4}}|[A-Z]{{2}}') AS INTEGER) AS short, CAST(regexp_full_match(word, '[0-9]*[.][0-9]+') AS INTEGER) AS dec
FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents)""",
)
def shaped_tokens(spark, sf):
    w = F.col("word")
    rows = documents(spark, sf).select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return rows.select(
        "word",
        tx.is_shaped(w, tx.TWO_DIGITS).cast("int").alias("two"),
        tx.is_shaped(w, tx.NUMBER_OR_EMPTY).cast("int").alias("num"),
        tx.is_shaped(w, tx.SHORT_LATIN).cast("int").alias("short"),
        tx.is_shaped(w, tx.DECIMAL).cast("int").alias("dec"),
    )


QUANTITY_SQL = "[0-9.]*(" + "|".join(q for q in tx.QUANTIFIERS) + ")"


@query(
    "F8_quantities",
    f"""SELECT p_partkey, CAST(regexp_full_match(w, '{QUANTITY_SQL}') AS INTEGER) AS quantity
FROM (SELECT p_partkey, p_retailprice || (CASE WHEN p_size % 3 = 0 THEN '萬' WHEN p_size % 3 = 1 THEN 'kg' ELSE 'x' END) AS w FROM part)""",
)
def quantities(spark, sf):
    unit = F.when(F.col("p_size") % 3 == 0, "萬").when(F.col("p_size") % 3 == 1, "kg").otherwise("x")
    word = F.concat(F.col("p_retailprice").cast("string"), unit)
    return table(spark, sf, "part").select("p_partkey", tx.is_quantity(word).cast("int").alias("quantity"))


@query(
    "F9_clean_tokens",
    f"""WITH t AS (SELECT source AS web_id, word, count(*) AS n FROM (SELECT source, unnest({SPLIT}) AS word FROM documents) GROUP BY 1, 2)
SELECT web_id, word, n FROM t WHERE word NOT IN ('', ' ') AND lower(word) NOT IN ({STOP_SQL})
  AND NOT regexp_full_match(word, '{QUANTITY_SQL}') AND NOT regexp_full_match(word, '[0-9]{{2}}|[0-9.]*|[a-z]{{1,4}}|[A-Z]{{2}}')
  AND NOT (web_id IN (SELECT 'src' || s_nationkey FROM supplier) AND lower(word) IN ('dans', 'nicht', 'mente'))""",
)
def clean_tokens(spark, sf):
    rows = documents(spark, sf).select(F.col("source").alias("web_id"), F.explode(F.split("text", r"[\s,.]+")).alias("word"))
    counted = rows.groupBy("web_id", "word").agg(F.count("*").alias("n"))
    black = table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("web_id"),
        F.explode(F.array(F.lit("Dans"), F.lit("nicht"), F.lit("mente"))).alias("keyword"),
    )
    return keywords.clean_tokens(counted, "word", [stop_words(spark, sf)], black).select("web_id", "word", "n")


@query(
    "F10_split_list",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name || ' , ' || p_brand || ',' || p_type, ','), lambda x: trim(x)), '|') AS parts FROM part""",
)
def split_list(spark, sf):
    joined = F.concat(F.col("p_name"), F.lit(" , "), F.col("p_brand"), F.lit(","), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.split_list(joined), "|").alias("parts"))


@query("F12_has_han", "SELECT doc_id, CAST(regexp_matches(text, '[一-龥]') AS INTEGER) AS han FROM documents")
def has_han(spark, sf):
    return documents(spark, sf).select("doc_id", tx.has_han(F.col("text")).cast("int").alias("han"))


@query(
    "F13_traffic_number",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) * 10000 ELSE CAST(p_size AS BIGINT) * 1000 + 1 END AS traffic FROM part""",
)
def traffic_number(spark, sf):
    size = F.col("p_size").cast("string")
    shown = F.when(F.col("p_size") % 2 == 0, F.concat(size, F.lit("萬+"))).otherwise(F.concat(size, F.lit(",001+")))
    return table(spark, sf, "part").select("p_partkey", tx.traffic_number(shown).alias("traffic"))


@query("F14_blank_free", "SELECT p_partkey, replace(p_name, ' ', '') AS compose FROM part")
def blank_free(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.blank_free(F.col("p_name")).alias("compose"))


@query("F15_url_key", "SELECT page_id, lower(split_part(url, '?', 1)) AS key FROM pages")
def url_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.url_key(F.col("url")).alias("key"))


@query(
    "F16_percent_decode",
    "SELECT page_id, url_decode(replace(url || '/%E4%B8%AD+%2F' || page_id, '+', '%2B')) AS decoded FROM pages",
)
def percent_decode(spark, sf):
    encoded = F.concat(F.col("url"), F.lit("/%E4%B8%AD+%2F"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select("page_id", urls.percent_decode(encoded).alias("decoded"))


# tenant: first word of the host's last-but-two label; rules: region-like table built from the pages
PAGES_SQL = """p AS (SELECT page_id, url, regexp_extract(url, '([a-z0-9-]+)\\.example\\.', 1) AS web_id,
  html FROM pages),
rules AS (SELECT DISTINCT web_id, CASE WHEN length(web_id) % 3 = 0 THEN '/([a-z]{2})/([0-9]+)' WHEN length(web_id) % 3 = 1 THEN '/(nomatch)/' ELSE '(https?://.*)' END AS pattern,
  CASE WHEN length(web_id) % 3 = 0 THEN 2 ELSE 1 END AS grp FROM p WHERE length(web_id) <> 5)"""


def tenant_pages(spark, sf):
    tenant = F.regexp_extract("url", r"([a-z0-9-]+)\.example\.", 1)
    return table(spark, sf, "pages").select("page_id", "url", tenant.alias("web_id"))


def url_rules(spark, sf):
    kind = F.char_length("web_id") % 3
    names = tenant_pages(spark, sf).select("web_id").distinct().where(F.char_length("web_id") != 5)
    return names.select(
        "web_id",
        F.when(kind == 0, "/([a-z]{2})/([0-9]+)").when(kind == 1, "/(nomatch)/").otherwise("(https?://.*)").alias("pattern"),
        F.when(kind == 0, 2).otherwise(1).alias("group"),
    )


SIGNATURE_SQL = """SELECT page_id, p.web_id, CASE WHEN r.web_id IS NULL THEN '_'
  WHEN regexp_matches(url, pattern) THEN p.web_id || '_' || (CASE WHEN octet_length(encode(sig)) > 60 THEN sha256(sig) ELSE sig END)
  ELSE p.web_id END AS article_id FROM (SELECT p.*, r.pattern,
    CASE grp WHEN 2 THEN regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) ELSE regexp_extract(url, '(https?://.*)', 1) END AS sig, r.web_id AS rid
    FROM p LEFT JOIN rules r USING (web_id)) p LEFT JOIN (SELECT DISTINCT web_id FROM rules) r ON r.web_id = p.rid"""


@query("F17_url_signature", f"WITH {PAGES_SQL} {SIGNATURE_SQL}")
def url_signature(spark, sf):
    rows = urls.url_signature(tenant_pages(spark, sf), url_rules(spark, sf))
    return rows.select("page_id", "web_id", "article_id")


@query(
    "F18_product_signature",
    f"""WITH {PAGES_SQL} SELECT page_id, CASE WHEN r.web_id IS NULL THEN '_'
  WHEN length(p.web_id) % 3 = 0 AND regexp_matches(url, '/([a-z]{{2}})/([0-9]+)') THEN regexp_extract(url, '/([a-z]{{2}})/([0-9]+)', 2)
  WHEN length(p.web_id) % 3 = 2 THEN CASE WHEN octet_length(encode(lower(url))) > 60 THEN sha256(lower(url)) ELSE lower(url) END
  ELSE p.web_id END AS product_id FROM p LEFT JOIN rules r USING (web_id)""",
)
def product_signature(spark, sf):
    rows = urls.url_signature(
        tenant_pages(spark, sf), url_rules(spark, sf), out="product_id", ignore_case=True, prefix=False
    )
    return rows.select("page_id", "product_id")


# --- traffic sources -------------------------------------------------------------------------------
HOSTS = (
    "https://www.facebook.com/l", "https://www.google.com/search?q=x", "https://tw.yahoo.com/news", "https://line.me/R",
    "https://m.youtube.com/watch", "https://www.instagram.com/p", "https://insider.com/a", "https://ig.me/x", "_", "",
    "https://example.org/x?utm_medium=EDM", "https://bing.com/s", "https://t.co/abc",
)
TAGS_UTM = (
    "", "?utm_source=feed", "?utm_source=fb&utm_medium=cpc", "?utm_medium=googleAd&x=1", "?utm_source=a&utm_source=yt-x",
    "?utm_source=Insider", "?utm_source=instagramShopping", "?utm_medium=newsletter",
)


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def _pick_sql(values, index):
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], CAST({index} AS INTEGER) + 1)"


VISITS_SQL = f"""visits AS (SELECT event_id, user_id, {_pick_sql(HOSTS, f"{KEY_SQL} % {len(HOSTS)}")} AS ref,
  'https://shop' || (user_id % 9) || '.example.com/p/' || event_id || {_pick_sql(TAGS_UTM, f"event_id % {len(TAGS_UTM)}")} AS cur,
  CASE WHEN user_id % 13 = 0 THEN 'line' ELSE '' END AS app FROM events)"""


def visits(spark, sf):
    host = _pick(HOSTS, event_key() % len(HOSTS))
    page = F.concat(
        F.lit("https://shop"), (F.col("user_id") % 9).cast("string"), F.lit(".example.com/p/"),
        F.col("event_id").cast("string"), _pick(TAGS_UTM, F.col("event_id") % len(TAGS_UTM)),
    )
    code = F.when(F.col("user_id") % 13 == 0, F.lit(10))
    return table(spark, sf, "events").select(
        "event_id", "user_id", host.alias("ref"), page.alias("cur"),
        F.coalesce(urls.browser_app(code), F.lit("")).alias("app"),
    )


def _rule_sql(value, border):
    parts = []
    for pattern, label in urls.source_rules():
        if pattern.startswith("(ins"):
            # the oracle's regex dialect has no look-ahead: instagram is matched by an earlier rule
            pattern = "ins(?:$|[^t]|t[^a]|ta[^g])"
        pattern = f"(?:\\W|^)(?:{pattern})" if border else pattern
        parts.append(f"WHEN regexp_matches({value}, '(?i){pattern}') THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def _last_sql(url, name):
    return f"list_extract(regexp_extract_all({url}, '{name}=([^&]+)', 1), -1)"


def _utm_sql(url):
    tag = f"COALESCE({_last_sql(url, 'utm_source')}, {_last_sql(url, 'utm_medium')})"
    return f"COALESCE({_rule_sql(tag, False)}, {tag})"


SOURCE_SQL = f"""sourced AS (SELECT event_id, user_id, ref, cur, COALESCE({_utm_sql('cur')}, NULLIF(app, ''),
  CASE WHEN ref IN ('None', '', '_', '-1') THEN 'other' END,
  CASE WHEN split_part(cur, '/', 3) <> split_part(ref, '/', 3) THEN {_rule_sql("split_part(ref, '/', 3)", True)} END,
  {_utm_sql('ref')}, split_part(ref, '/', 3)) AS source FROM visits)"""


@query("F19_traffic_source", with_(VISITS_SQL, SOURCE_SQL, select="SELECT event_id, source FROM sourced"))
def traffic_source(spark, sf):
    source = urls.traffic_source(F.col("ref"), F.col("cur"), F.col("app"))
    return visits(spark, sf).select("event_id", source.alias("source"))


# example hosts that a publisher counts as its own
OWN_HOSTS = {"app_hosts": ("app.shops.example",), "blog_networks": ("blogs",)}
KNOWN_SQL = ", ".join(f"'{k}'" for k in urls.KNOWN_SOURCES)


@query(
    "F20_canonical_source",
    with_(
        VISITS_SQL, SOURCE_SQL,
        """joined AS (SELECT s.*, 'shop' || (user_id % 9) AS web_id, CASE WHEN user_id % 9 < 7 THEN 'https://www.t.' || (user_id % 9) || '.co/x' END AS domain
  FROM sourced s)""",
        select=f"""SELECT event_id, CASE WHEN domain IS NULL THEN 'other'
  WHEN regexp_matches(lower(domain), '\\W' || replace(lower(source), '.', '\\.')) OR contains('app.shops.example', lower(source)) THEN web_id
  WHEN lower(source) IN ({KNOWN_SQL}) THEN lower(source) WHEN contains(lower(source), 'blogs') THEN web_id ELSE 'other' END AS source FROM joined""",
    ),
)
def canonical_source(spark, sf):
    raw = urls.traffic_source(F.col("ref"), F.col("cur"), F.col("app"))
    shop = (F.col("user_id") % 9).cast("string")
    domain = F.when(F.col("user_id") % 9 < 7, F.concat(F.lit("https://www.t."), shop, F.lit(".co/x")))
    rows = visits(spark, sf).select("event_id", raw.alias("raw"), F.concat(F.lit("shop"), shop).alias("web_id"), domain.alias("domain"))
    return rows.select("event_id", urls.canonical_source(F.col("raw"), F.col("web_id"), F.col("domain"), **OWN_HOSTS).alias("source"))


@query("F21_utm_source", with_(VISITS_SQL, select=f"SELECT event_id, COALESCE({_utm_sql('cur')}, '_') AS utm FROM visits"))
def utm_source(spark, sf):
    return visits(spark, sf).select("event_id", F.coalesce(urls.utm_source(F.col("cur")), F.lit("_")).alias("utm"))


# --- dates -----------------------------------------------------------------------------------------
def order_dates(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))


DATE_FUNCTIONS = {
    "T3_yesterday": (lambda d: F.date_format(dates.days_before(d), "yyyy-MM-dd"), "strftime(d - 1, '%Y-%m-%d')"),
    "T5_shift": (lambda d: F.date_format(dates.days_before(d, -10), "yyyy-MM-dd"), "strftime(d + 10, '%Y-%m-%d')"),
    "T6_days_in_month": (lambda d: dates.days_in_month(d), "CAST(day(last_day(d)) AS INTEGER)"),
    "T7_format": (lambda d: dates.format_date(d, "dd/MM/yyyy"), "strftime(d, '%d/%m/%Y')"),
    "T8_date_int": (lambda d: dates.date_int(d), "CAST(strftime(d, '%Y%m%d') AS INTEGER)"),
    "T12_iso_weekday": (lambda d: dates.iso_weekday(d), "CAST(isodow(d) AS INTEGER)"),
    "T13_day_of_year": (lambda d: F.dayofyear(d) * 1000 + dates.days_in_year(d), "CAST(dayofyear(d) * 1000 + dayofyear(make_date(year(d), 12, 31)) AS INTEGER)"),
    "T14_months_before": (lambda d: F.date_format(dates.months_before(d), "yyyy-MM-dd"), "strftime(date_trunc('month', d - INTERVAL 2 MONTH), '%Y-%m-%d')"),
    "T15_expiry": (lambda d: F.date_format(dates.expiry_date(d, 4), "yyyy-MM-dd"), "strftime(d + 4, '%Y-%m-%d')"),
    "W12_day_index": (lambda d: dates.day_index(d, F.lit(dt.date(1996, 3, 1))), "CAST(date_diff('day', DATE '1996-03-01', d) + 1 AS INTEGER)"),
}


def _date_query(name, fn, sql):
    @query(name, f"SELECT o_orderkey, {sql} AS result FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
    def run(spark, sf):
        return order_dates(spark, sf).select("o_orderkey", fn(F.col("d")).alias("result"))


for _name, (_fn, _sql) in DATE_FUNCTIONS.items():
    _date_query(_name, _fn, _sql)


@query("T1_local_date", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day FROM events")
def local_date(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format(dates.local_date(F.col("ts")), "yyyy-MM-dd").alias("day"))


@query("T2_parse_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '_' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def parse_date(spark, sf):
    shown = F.when(F.col("o_orderkey") % 4 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    parsed = F.date_format(dates.parse_date(shown, "yyyy/MM/dd"), "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(parsed, F.lit("_")).alias("day"))


@query("T4_local_hour", "SELECT event_id, CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour FROM events")
def local_hour(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.local_hour(F.col("ts")).alias("hour"))


@query(
    "T9_date_range",
    "SELECT c_custkey, strftime(DATE '2024-01-01' + CAST(i AS INTEGER), '%Y-%m-%d') AS day FROM customer, (SELECT unnest(range(5)) AS i)",
)
def date_range(spark, sf):
    days = F.explode(dates.date_range(F.lit(dt.date(2024, 1, 1)), 5)).alias("d")
    return table(spark, sf, "customer").select("c_custkey", days).select("c_custkey", F.date_format("d", "yyyy-MM-dd").alias("day"))


@query(
    "T10_hour_edges",
    """SELECT l_returnflag, strftime(TIMESTAMP '2024-01-01' + INTERVAL (i * 2) HOUR, '%Y-%m-%d %H:%M') AS edge
FROM (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT unnest(range(13)) AS i)""",
)
def hour_edges(spark, sf):
    edges = F.explode(dates.hour_edges(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), 1, 2)).alias("e")
    flags = table(spark, sf, "lineitem").select("l_returnflag").distinct()
    return flags.select("l_returnflag", edges).select("l_returnflag", F.date_format("e", "yyyy-MM-dd HH:mm").alias("edge"))


@query(
    "T11_epochs",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events""",
)
def epochs(spark, sf):
    sec = dates.epoch_seconds(F.col("ts"))
    back = F.date_format(dates.from_epoch_millis(sec * 1000 + 999), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select("event_id", sec.alias("sec"), back.alias("shown"))


# --- maths -----------------------------------------------------------------------------------------
PI = "3.141592653589793"


@query(
    "M1_gauss",
    f"""SELECT event_id, round(exp(-pow(value - 50.0, 2) / (2 * pow(20.0, 2))) / (20.0 * sqrt(2 * {PI})), 10) AS density,
  round(-ln(20.0) - 0.5 * ln(2 * {PI}) - pow(value - 50.0, 2) / (2 * pow(20.0, 2)), 6) AS log_density FROM events""",
)
def gauss(spark, sf):
    x, m, s = F.col("value"), F.lit(50.0), F.lit(20.0)
    return table(spark, sf, "events").select(
        "event_id", F.round(maths.gauss(x, m, s), 10).alias("density"), F.round(maths.ln_gauss(x, m, s), 6).alias("log_density")
    )


@query(
    "M2_exponential",
    "SELECT event_id, round(exp(-value / 30.0) / 30.0, 10) AS density, round(-ln(30.0) - value / 30.0, 6) AS log_density FROM events",
)
def exponential(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.round(maths.exp_density(F.col("value"), F.lit(30.0)), 10).alias("density"),
        F.round(maths.ln_exp_density(F.col("value"), F.lit(30.0)), 6).alias("log_density"),
    )


MIX = (stats.Component(0.5, tau=20.0), stats.Component(0.3, mean=60.0, sigma=25.0), stats.Component(0.2, mean=120.0, sigma=40.0, tau=15.0))


@query(
    "M3_score_mixture",
    f"""WITH d AS (SELECT event_id, ln(0.5) - ln(20.0) - value / 20.0 AS a,
  ln(0.3) - ln(25.0) - 0.5 * ln(2 * {PI}) - pow(value - 60.0, 2) / (2 * pow(25.0, 2)) AS b,
  ln(0.2) - ln(40.0) - 0.5 * ln(2 * {PI}) - pow(value - 120.0, 2) / (2 * pow(40.0, 2)) - ln(15.0) - value / 15.0 AS c FROM events)
SELECT event_id, CAST(CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS BIGINT) AS component,
  round(greatest(a, b, c) + ln(exp(a - greatest(a, b, c)) + exp(b - greatest(a, b, c)) + exp(c - greatest(a, b, c))), 5) AS log_density FROM d""",
)
def score_mixture(spark, sf):
    rows = stats.score_mixture(table(spark, sf, "events"), MIX, F.col("value"), F.col("value"))
    return rows.select("event_id", "component", F.round("log_density", 5).alias("log_density"))


@query(
    "M4_exp_gauss",
    f"SELECT event_id, round(0.4 * exp(-value / 30.0) * 20.0 / sqrt(2 * {PI}) * exp(-pow(value - 50.0, 2) / (2 * pow(20.0, 2))), 8) AS g FROM events",
)
def exp_gauss(spark, sf):
    x = F.col("value")
    g = maths.exp_gauss_2d(x, x, F.lit(0.4), F.lit(50.0), F.lit(20.0), F.lit(30.0))
    return table(spark, sf, "events").select("event_id", F.round(g, 8).alias("g"))


@query(
    "M5_standardise",
    """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) AS p_size FROM part""",
)
def standardise(spark, sf):
    rows = stats.standardise(table(spark, sf, "part"), ["p_size"])
    return rows.select("p_partkey", F.round("p_size", 6).alias("p_size"))


@query(
    "M6_growth_rate",
    """SELECT c_custkey, CASE WHEN last = 0 THEN 0.0 ELSE round((c_acctbal - last) / last * 100, 4) END AS growth
FROM (SELECT c_custkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS last FROM customer)""",
)
def growth_rate(spark, sf):
    rate = maths.growth_rate(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    return table(spark, sf, "customer").select("c_custkey", F.round(rate, 4).alias("growth"))


# --- arrays, maps, JSON ----------------------------------------------------------------------------
@query(
    "R1_flatten",
    "SELECT p_partkey, p_name || ' ' || p_type AS flat FROM part",
)
def flatten(spark, sf):
    nested = F.array(F.split("p_name", " "), F.array("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(arrays.flatten_lists(nested), " ").alias("flat"))


@query(
    "R2_sort_by_freq",
    with_(
        TAGS,
        "f AS (SELECT web_id, uuid, usertag, count(*) AS n FROM tags GROUP BY ALL)",
        select="""SELECT web_id, uuid, string_agg(usertag, ',' ORDER BY n DESC, usertag) AS words, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n DESC, usertag) AS freqs
  FROM f GROUP BY 1, 2""",
    ),
)
def sort_by_freq(spark, sf):
    counts = tags(spark, sf).groupBy("web_id", "uuid", "usertag").agg(F.count("*").alias("n"))
    # one list of distinct tags per user: the shape of a stored tag record
    lists = counts.groupBy("web_id", "uuid").agg(F.collect_list(F.struct("usertag", "n")).alias("_l"))
    words, freqs = arrays.sort_by_freq(F.col("_l.usertag"), F.col("_l.n"))
    return lists.select("web_id", "uuid", arrays.join_list(words).alias("words"), arrays.join_list(freqs.cast("array<string>")).alias("freqs"))


@query("R3_join_list", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '; ') AS joined FROM part")
def join_list(spark, sf):
    return table(spark, sf, "part").select("p_partkey", arrays.join_list(F.split("p_name", " "), "; ").alias("joined"))


@query("R4_json_value", f"SELECT event_id, CAST({KEY_SQL} AS VARCHAR) AS k FROM events")
def json_value(spark, sf):
    return table(spark, sf, "events").select("event_id", arrays.json_value(F.col("props"), "$.k").alias("k"))


@query(
    "R5_cells_to_columns",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS value_a, split_part(p_name, ' ', 2) AS value_b, '_' AS value_c FROM part",
)
def cells_to_columns(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("value"))
    return arrays.cells_to_columns(rows, ["value"], ["a", "b", "c"]).fillna("_")


@query("R6_has_member", "SELECT p_partkey, CAST(list_contains(string_split(p_name, ' '), 'old') AS INTEGER) AS hit FROM part")
def has_member(spark, sf):
    hit = arrays.has_member(F.split("p_name", " "), F.lit("old"))
    return table(spark, sf, "part").select("p_partkey", hit.cast("int").alias("hit"))


@query("R7_topic_columns", """SELECT p_name AS title, p_type AS type, CAST(p_size AS VARCHAR) || '%' AS "formattedValue" FROM part""")
def topic_columns(spark, sf):
    topic = F.struct(F.col("p_name").alias("title"), F.col("p_type").alias("type"), F.col("p_brand").alias("mid"))
    shown = F.concat(F.col("p_size").cast("string"), F.lit("%")).alias("formattedValue")
    return arrays.topic_columns(table(spark, sf, "part").select(topic.alias("topic"), shown))


@query(
    "R8_counters_to_rows",
    """SELECT p_partkey, 'size' AS bucket, CAST(p_size AS BIGINT) AS count FROM part UNION ALL
SELECT p_partkey, 'name', length(p_name) FROM part""",
)
def counters_to_rows(spark, sf):
    counters = F.create_map(F.lit("size"), F.col("p_size").cast("long"), F.lit("name"), F.char_length("p_name").cast("long"))
    rows = table(spark, sf, "part").select("p_partkey", counters.alias("c"))
    return arrays.counters_to_rows(rows, ["p_partkey"], "c")
