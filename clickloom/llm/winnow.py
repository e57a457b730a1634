"""Document fingerprints by winnowing, with column expressions only.

Hashes of all runs of ``CHARS`` characters (code points, white space as one blank each) are made; in every window of
``SPAN`` consecutive runs the smallest hash is kept, the rightmost of equal ones; neighbouring windows mostly keep the
same. Any passage of ``CHARS + SPAN - 1`` characters that two texts share leaves a common hash in both, whether or not
there are words. Window minima are made by doubling (of two runs, of four, ..), so the work per character does not
depend on the length of a text or a window. A fingerprint entry is one long: 31 bits of the hash above the inverted
place of the run, so that the smaller of two entries is the smaller hash or, among equal hashes, the one further right.

``with_fingerprint`` does the same with runs of ``GRAM`` words in windows of ``WINDOW``: coarser, an eighth as many
entries or fewer, and of little use for texts under 20 words.

Edge cases: null counts as empty; a text of white space only has an empty fingerprint; one shorter than a run is
one run, one with fewer runs than a window one window. Equal texts have equal fingerprints. Rows without an
id are left out. Several rows of one id are each compared with the same next document, the next larger id; of that
id's rows the smallest text counts. The document after the last one is the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import keyed, whole_text
from clickloom.session import materialise

GRAM = 4
WINDOW = 16
CHARS = 8
SPAN = 8
BLOCK = 64
SPACE = r"[\x20\x09-\x0D]+"
PLACES = (1 << 32) - 1


def _pairs(values: str, step: int, combine) -> Column:
    """combine(value i, value i + step) for every i; past the end the second is null."""
    return F.zip_with(values, F.slice(values, F.lit(step + 1), F.size(values)), combine)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``, the array of fingerprint entries of the column ``text`` by place."""
    keep = [c for c in df.columns if c != out]
    # one select per step: each array is then made once
    df = df.withColumn("_a", F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.split(text, SPACE)).otherwise(F.array().cast("array<string>")))
    df = df.select(*keep, F.transform("_a", lambda w: F.xxhash64(w)).alias("_a"))
    step = 1
    while step < GRAM:
        df = df.select(*keep, _pairs("_a", step, lambda a, b: F.xxhash64(a, b)).alias("_a"))
        step *= 2
    runs = F.slice("_a", F.lit(1), F.greatest(F.size("_a") - (GRAM - 1), F.lit(1)))
    return _window_minima(df.select(*keep, F.transform(runs, _entry).alias("_a")), keep, WINDOW, out)


def with_char_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``, the array of fingerprint entries of the column ``text`` by place, from runs of characters."""
    plain = F.trim(F.regexp_replace(F.col(text), SPACE, " "))
    return _with_run_minima(df.select(*df.columns, plain.alias("_plain"), F.lit(0).alias("_from")), [c for c in df.columns if c != out], out)


def _with_run_minima(df: DataFrame, keep: list[str], out: str) -> DataFrame:
    """``keep`` and ``out``: entries of ``_plain``, a text with single blanks whose first character has the place ``_from``."""
    # four bytes a character, so that every run is cut out in the same time
    df = df.select(*keep, "_from", F.encode("_plain", "UTF-32").alias("_b"))
    last = F.greatest((F.octet_length("_b") / 4).cast("int") - CHARS, F.lit(0))
    cut = lambda b: F.transform(F.sequence(F.lit(0), last), lambda i: _entry(F.xxhash64(F.substring(b, 4 * i + 1, F.lit(4 * CHARS))), i + F.col("_from")))
    # as a lambda's variable the bytes are held; read from the row they would be copied for every run
    some = F.when(F.octet_length("_b") > 0, F.transform(F.array("_b"), cut)[0]).otherwise(F.array().cast("array<bigint>"))
    return _window_minima(df.select(*keep, some.alias("_a")), keep, SPAN, out)


def with_edited_fingerprint(df: DataFrame, entries: str, kept: str, head: str, out: str) -> DataFrame:
    """``df`` plus ``out``, the entries of the text ``kept`` followed by ``head``; ``entries`` are those of a text that begins with ``kept``.

    Windows inside ``kept`` have the same minima in both texts, and minima move rightwards from window to window. So
    only the runs from the last such window on are hashed; its minimum is where the two lists of entries meet.
    """
    keep = [c for c in df.columns if c != out]
    plain = F.trim(F.regexp_replace(F.col(kept), SPACE, " "))
    df = df.select(*df.columns, plain.alias("_plain"))
    df = df.select(*df.columns, F.greatest(F.length("_plain") - (CHARS + SPAN - 1), F.lit(0)).alias("_from"))
    blank = F.when(F.col(kept).rlike(r"[\x20\x09-\x0D]$"), F.lit(" ")).otherwise(F.lit(""))
    rest = F.concat(F.substring("_plain", F.col("_from") + 1, F.length("_plain")), blank, F.regexp_replace(F.col(head), SPACE, " "))
    rest = F.rtrim(F.regexp_replace(rest, " +", " "))
    # in the middle of a text a blank in front counts
    rest = F.when(F.col("_from") > 0, rest).otherwise(F.ltrim(rest))
    df = df.select(*df.columns[:-2], "_from", rest.alias("_plain"))
    df = _with_run_minima(df, [*keep, "_from"], "_rest")
    before = F.slice(entries, F.lit(1), F.greatest(F.array_position(entries, F.col("_rest")[0]).cast("int") - 1, F.lit(0)))
    joined = F.when(F.col("_from") > 0, F.concat(before, "_rest")).otherwise(F.col("_rest"))
    return df.select(*keep, joined.alias(out))


def _entry(h: Column, i: Column) -> Column:
    return F.shiftleft(h.bitwiseAND(0x7FFFFFFF), 32) + (F.lit(PLACES) - i)


def _window_minima(df: DataFrame, keep: list[str], window: int, out: str) -> DataFrame:
    """``keep`` and ``out``: the distinct minima of all windows of the entries ``_a``; ``window`` is a power of two."""
    step = 1
    while step < window:
        df = df.select(*keep, _pairs("_a", step, lambda a, b: F.least(a, b)).alias("_a"))
        step *= 2
    kept = F.array_distinct(F.slice("_a", F.lit(1), F.greatest(F.size("_a") - (window - 1), F.lit(1))))
    return df.select(*keep, kept.alias(out))


def hashes(entries: Column) -> Column:
    return F.transform(entries, lambda e: F.shiftright(e, 32))


def readable(entries: Column) -> Column:
    """``hash@place`` of every entry, by place; places count runs from 0."""
    return F.concat_ws(" ", F.transform(entries, lambda e: F.concat_ws("@", F.hex(F.shiftright(e, 32)), (F.lit(PLACES) - e.bitwiseAND(PLACES)).cast("string"))))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays of hashes; 1 for two empty ones."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / union)


def successors(keys: DataFrame, key: str) -> DataFrame:
    """(``key``, next_key): every key with the next larger one, the largest with the smallest.

    Keys are ranged over partitions; inside one the next key is at hand, and a partition's last key looks at the
    first key of the next partition that has any.
    """
    ranged = materialise(keys.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "ranged")
    firsts = ranged.groupBy("_part").agg(F.min(key).alias("_first"))
    by_part = Window.orderBy("_part")
    following = firsts.select("_part", F.coalesce(F.lead("_first").over(by_part), F.first("_first").over(by_part)).alias("_after"))
    inside = Window.partitionBy("_part").orderBy(key)
    return ranged.withColumn("_inside", F.lead(key).over(inside)).join(following, "_part").select(
        *keys.columns, F.coalesce("_inside", "_after").alias("next_key")
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, text, entries, edited, edited_entries, next_hashes): each text beside its edited form and the next document's hashes.

    Texts are dealt once, by blocks of ``BLOCK`` neighbouring ids. The first document behind a block comes to it as a
    guest, so every document finds the next one among its block's rows, and its entries are made there once.
    """
    docs = keyed(docs, "doc_id").select("doc_id", whole_text().alias("text"))
    block = lambda key: F.floor(F.col(key) / BLOCK)
    order = successors(docs.select("doc_id").distinct(), "doc_id")
    behind = (block("doc_id") != block("next_key")) | (F.col("next_key") <= F.col("doc_id"))
    # stored, so that Spark knows the size
    guests = materialise(order.where(behind).select(block("doc_id").alias("block"), F.col("next_key").alias("doc_id")), "guests")
    own = docs.select(block("doc_id").alias("block"), F.lit(False).alias("guest"), "doc_id", "text")
    rows = own.unionByName(docs.join(guests, "doc_id").select("block", F.lit(True).alias("guest"), "doc_id", "text"))
    line = ("guest", "doc_id", "text")
    rows = with_char_fingerprint(rows.repartition("block").sortWithinPartitions("block", *line), "text", "entries")
    by_line = Window.partitionBy("block").orderBy(*line)
    # the first row of an id stands for the id
    name = F.struct("guest", "doc_id")
    rows = rows.withColumn("_again", F.coalesce(F.lag(name).over(by_line) == name, F.lit(False)))
    hashed = F.array_distinct(hashes(F.col("entries")).cast("array<int>"))
    rows = rows.withColumn("_shown", F.when(~F.col("_again"), F.struct("text", hashed.alias("hashes"))))
    rows = rows.withColumn("next", F.expr(f"lead(_shown) IGNORE NULLS OVER (PARTITION BY block ORDER BY {', '.join(line)})")).where(~F.col("guest"))
    tail = F.floor(F.length("text") / 4).cast("int")
    parts = rows.select(
        "doc_id", "text", "entries",
        F.substring("text", F.lit(1), F.length("text") - tail).alias("kept"),
        F.substring("next.text", F.lit(1), tail).alias("head"),
        F.col("next.hashes").alias("next_hashes"),
    )
    return with_edited_fingerprint(parts, "entries", "kept", "head", "edited_entries").select(
        "doc_id", "text", "entries", F.concat("kept", "head").alias("edited"), "edited_entries", "next_hashes"
    )
