"""Keyword, catalogue and ad similarity.

Pairs are never rows. Each side is packed into blocks of a bounded number of words, and one [arrow] step multiplies
blocks as matrices and returns only results that pass. Blocks are balls of near vectors (``balls``): with a
threshold, or a floor from the block's own group for the best k, pairs of blocks that can't pass never meet. Products
in single precision only rule pairs out; what is left is worked out in double precision. Ads are
scored over all words of an article, so there every block meets every other one. Thresholds and bounds are exact:
nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from clickloom.functions.edits import Letters, edit_distances
from clickloom.functions.text import strip_symbols, without_term
from clickloom.operators.ad_scores import Words, best_ads
from clickloom.operators.balls import BLOCK, BallIndex, Group
from clickloom.operators.joins import salted_join
from clickloom.operators.ranking import keep_first, top_k
from clickloom.session import materialise

# fixed values: weights and thresholds of the two scores
RELATED_WEIGHT = 2.0
RELATED_SCORE = 0.09
RELATED_K = 10
TREND_SCORE = 0.1
TREND_COSINE = 0.66
AD_BLOCK = 1 << 14  # words; with 64 numbers a word, 8 MB
AD_COPIES = 16
ROUNDING = 1e-8  # cosines are compared after rounding to nine places


def _pack(words: DataFrame, side: str, keys: Sequence[str], group: str | None) -> DataFrame:
    """Collect rows into the key's blocks and name the blocks of the other side each must meet."""
    other = "r" if side == "l" else "l"
    number = F.pmod(F.xxhash64(group or "word"), F.col(f"_{side}_blocks"))
    fields = [c for c in words.columns if c not in keys and not c.endswith("_blocks")]
    packed = words.groupBy(*keys, number.alias(f"{side}_block"), f"_{other}_blocks").agg(
        F.collect_list(F.struct(*fields)).alias("_rows")
    )
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}_blocks") - 1))
    return packed.select(
        *keys,
        f"{side}_block",
        meets.alias(f"{other}_block"),
        *[F.col(f"_rows.{c}").alias(f"{side}_{c}") for c in fields if c != "vector"],
        F.flatten("_rows.vector").alias(f"{side}_vector"),
    )


def block_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = (), block: int = BLOCK, group: str | None = None, copies: int | None = None
) -> DataFrame:
    """Every pair of (left block, right block) inside a key, as array columns ``l_*`` and ``r_*``.

    A block holds about ``block`` rows; how many blocks a key has follows from its own row count. With ``copies``
    blocks grow, up to four times, where a side would have more of them, as every block travels to all of the other side.
    The join key is (key, left block, right block), so one tenant's pairs are spread over the whole
    cluster. Rows that share ``group`` stay in one block.
    """
    keys = list(keys)
    rows = F.count("*")
    number = F.ceil(rows / (F.least(F.greatest(F.lit(block), F.ceil(rows / copies)), F.lit(4 * block)) if copies else block))
    if keys:
        plan = left.groupBy(*keys).agg(number.alias("_l_blocks")).join(
            right.groupBy(*keys).agg(number.alias("_r_blocks")), keys
        )
        # one plan row per key meets all rows of that key: salted, as one key may own most of them
        left, right = (salted_join(side, plan, keys, spread=32) for side in (left, right))
    else:
        counts = {"_l_blocks": left.agg(number).scalar(), "_r_blocks": right.agg(number).scalar()}
        left, right = left.withColumns(counts), right.withColumns(counts)
    return _pack(left, "l", keys, group).join(_pack(right, "r", keys, group), [*keys, "l_block", "r_block"]).drop(
        "l_block", "r_block"
    )


def _units(cell: pa.ListScalar, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and which rows have no length."""
    matrix = np.asarray(cell.values, dtype="float64").reshape(rows, -1)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0), length[:, 0] == 0


def _block_rows(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[list]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield [c[i] for c in columns]


def _known(words: DataFrame) -> DataFrame:
    """Words with a vector (an unknown word never passes a threshold)."""
    return words.where(F.col("vector").isNotNull())


def keyword_similarity(
    words: DataFrame,
    weight: float = RELATED_WEIGHT,
    min_score: float = RELATED_SCORE,
    k: int = RELATED_K,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` best related keywords per tenant keyword, itself included.

    score = weight * cosine - edits / length of the keyword, above ``min_score``. ``words`` is
    (web_id, word, vector). At least the length difference must be edited, so only pairs whose cosine can still
    reach the keyword's floor have their edits counted.
    """
    usable = _known(words.select("web_id", "word", "vector"))
    index = BallIndex.of(usable, usable, ["web_id"], block)
    if index is None:
        return words.sparkSession.createDataFrame([], "web_id string, keyword string, keyword_related string, score double")

    def score(left: Letters, right: Letters, i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        return weight * cosines - edit_distances(left, i, right, j) / left.size[i]

    def least(left: Letters, right: Letters, i: np.ndarray, j: np.ndarray, floors: np.ndarray) -> np.ndarray:
        return (floors + np.abs(right.size[j] - left.size[i]) / left.size[i]) / weight

    # no edit makes a score better than its cosine
    passed = _best(index, score, least, k, min_score, weight, above=True)
    renamed = passed.select("web_id", F.col("word").alias("keyword"), F.col("other").alias("keyword_related"), "score")
    return top_k(renamed, ["web_id", "keyword"], [F.desc(F.round("score", 9)), F.asc("keyword_related")], k)


Score = Callable[[Letters, Letters, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _kth(i: np.ndarray, scores: np.ndarray, rows: int, k: int, lowest: float) -> np.ndarray:
    """The ``k``-th best score of every row, ``lowest`` if it has fewer."""
    order = np.lexsort((-scores, i))
    starts = np.searchsorted(i[order], np.arange(rows + 1))
    full = np.flatnonzero(np.diff(starts) >= k)
    out = np.full(rows, lowest)
    out[full] = scores[order][starts[full] + k - 1]
    return out


def _best(index: BallIndex, score: Score, least: Score, k: int, lowest: float, scale: float = 1.0, above: bool = False) -> DataFrame:
    """(owner.., word, other, score) with at least the ``k`` best of every left word over ``lowest`` (``above``) or from it on.

    ``score`` gives pairs' scores from their words and cosines, NaN for none; ``least`` the least cosine that can reach
    a given score; no score is over ``scale`` times its cosine. Each group meets the one that shares its cells first.
    Its words' k-th best scores are the floors that then decide which other groups it meets and what these return.
    """
    owner, at = index.owner, ["l_cell", "l_part"]
    keys = "".join(f"{c} string, " for c in owner)

    def found(left: Group, right: Group) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per left block: its number, its rows' floors, and row, other row, score of the best pairs."""
        words, others, margin = Letters.of(left.words), Letters.of(right.words), left.margin
        names = np.argsort(np.argsort(np.array(right.words, dtype=object), kind="stable"))
        for block, low, high in left.blocks():
            floors = np.where(np.isnan(left.floors[low:high]), lowest, left.floors[low:high])
            columns = left.near(block, right, floors.min() / scale - ROUNDING)
            if not len(columns):
                yield block, floors, *np.zeros((3, 0), np.int64)
                continue
            product = left.products(low, high, right, columns)
            rows, cols = np.arange(low, high)[:, None], columns[None, :]
            open_rows = np.flatnonzero(floors <= lowest)
            if len(open_rows) and len(columns) > 8 * k:
                # the likeliest pairs give these rows a first floor
                bound = -least(words, others, rows[open_rows], cols, np.zeros((len(open_rows), 1))) + product[open_rows]
                likely = np.argpartition(-bound, 4 * k, axis=1)[:, : 4 * k]
                i, j = np.repeat(open_rows, 4 * k), columns[likely.ravel()]
                scores = score(words, others, i + low, j, left.cosines(i + low, right, j))
                keep = ~np.isnan(scores)
                first = _kth(i[keep], scores[keep], high - low, k, lowest)
                floors = np.maximum(floors, first)
            passing = product >= least(words, others, rows, cols, floors[:, None] - 2 * ROUNDING * scale) - margin
            i, j = np.nonzero(passing)
            j = columns[j]
            scores = score(words, others, i + low, j, left.cosines(i + low, right, j))
            keep = (scores > lowest if above else scores >= lowest) & (scores >= floors[i] - 2 * ROUNDING * scale)
            i, j, scores = i[keep], j[keep], scores[keep]
            order = np.lexsort((names[j], -np.round(scores, 9), i))
            i, j, scores = i[order], j[order], scores[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            i, j, scores = i[place < k], j[place < k], scores[place < k]
            yield block, np.maximum(floors, _kth(i, scores, high - low, k, lowest)), i + low, j, scores

    def home(own: list, left: Group, right: Group) -> Iterator[pa.RecordBatch]:
        for block, floors, i, j, scores in found(left, right):
            rows = [{"word": left.words[x], "other": right.words[y], "score": s} for x, y, s in zip(i, j, scores.tolist())]
            place = {"l_cell": int(left.cell[block]), "l_part": int(left.part[block])}
            yield pa.RecordBatch.from_pylist([dict(zip(owner, own)) | place | {"floors": floors.tolist(), "rows": rows}], _home_schema(owner))

    def away(own: list, left: Group, right: Group) -> Iterator[pa.RecordBatch]:
        for _, _, i, j, scores in found(left, right):
            if len(i):
                columns = {c: [v] * len(i) for c, v in zip(owner, own)}
                yield pa.RecordBatch.from_pydict(
                    columns | {"word": [left.words[x] for x in i], "other": [right.words[y] for y in j], "score": scores}
                )

    pairs = materialise(index.home_groups(), "home-groups")
    first = index.meet_groups(pairs, home, f"{keys}l_cell long, l_part long, floors array<double>, rows array<struct<word: string, other: string, score: double>>")
    first = materialise(first, "home")
    blocks = index.left.select(*owner, *at).join(first.select(*owner, *at, "floors"), [*owner, *at], "left")
    least_block = blocks.select(*owner, *at, (F.coalesce(F.array_min("floors"), F.lit(float(lowest))) / scale - ROUNDING).alias("least"))
    groups = [*index.keys, "l_group", "r_group"]
    others = materialise(index.near_pairs(least_block).select(*groups).distinct().join(pairs, groups, "left_anti"), "away-groups")
    floors = first.select(*owner, F.col("l_cell").alias("cell"), F.col("l_part").alias("part"), "floors")
    met = index.meet_groups(others, away, f"{keys}word string, other string, score double", floors)
    return first.select(*owner, F.inline("rows")).unionByName(met)


def _home_schema(owner: Sequence[str]) -> pa.Schema:
    row = pa.struct([("word", pa.string()), ("other", pa.string()), ("score", pa.float64())])
    at = [("l_cell", pa.int64()), ("l_part", pa.int64())]
    return pa.schema([*((c, pa.string()) for c in owner), *at, ("floors", pa.list_(pa.float64())), ("rows", pa.list_(row))])


def trend_catalogue_match(
    catalogue: DataFrame,
    trends: DataFrame,
    w_sim: float = 1.0,
    w_dis: float = 1.0,
    min_score: float = TREND_SCORE,
    min_cosine: float = TREND_COSINE,
    block: int = BLOCK,
    keys: Sequence[str] = ("web_id",),
) -> DataFrame:
    """Every catalogue keyword that is close to a trend keyword, with its scores.

    Both sides are (keys.., word, vector); ``keys`` may be empty for one common catalogue. score = (w_sim * cosine - w_dis * edits / longer length
    + w_dis / 2) / (w_sim + w_dis / 2); equal words are left out. Cosines come first, edit
    distances only for pairs over ``min_cosine``.
    """
    keys = list(keys)

    def once(words: DataFrame) -> DataFrame:
        return keep_first(_known(words.select(*keys, "word", "vector")), [*keys, "word"], [F.asc("vector")])

    def passing(own: list, left: Group, right: Group) -> Iterator[pa.RecordBatch]:
        words, others = Letters.of(left.words), Letters.of(right.words)
        names = [pa.array(side.words, pa.string()) for side in (right, left)]
        for i, j, near in _over(left, right, min_cosine):
            longer = np.maximum(words.size[i], others.size[j])
            apart = np.abs(words.size[i] - others.size[j])
            keep = _trend_score(near, apart / longer, w_sim, w_dis) > min_score - ROUNDING  # at least these are edits
            i, j, near, longer = i[keep], j[keep], near[keep], longer[keep]
            far = edit_distances(words, i, others, j)
            score = _trend_score(near, far / longer, w_sim, w_dis)
            keep = (score > min_score) & (far > 0)
            if keep.any():
                columns = [pa.array([v] * int(keep.sum()), pa.string()) for v in own]
                columns += [name.take(pa.array(x[keep])) for name, x in zip(names, (j, i))]
                columns += [pa.array(x[keep]) for x in (score, near, far / longer)]
                yield pa.RecordBatch.from_arrays(columns, [*keys, "keyword_trend", "keyword_item", "score", "score_cosine", "score_edit"])

    schema = "".join(f"{k} string, " for k in keys)
    schema += "keyword_trend string, keyword_item string, score double, score_cosine double, score_edit double"
    index = BallIndex.of(once(catalogue), once(trends), keys, block)
    if index is None:
        return catalogue.sparkSession.createDataFrame([], schema)
    return index.meet_groups(_near_groups(index, min_cosine), passing, schema)


def _near_groups(index: BallIndex, least: float) -> DataFrame:
    return materialise(index.near_pairs(least).select(*index.keys, "l_group", "r_group").distinct(), "near-groups")


def _over(left: Group, right: Group, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of both groups, and their cosines, of pairs over ``least``; a left block at a time."""
    for block, low, high in left.blocks():
        columns = left.near(block, right, least)
        i, j = np.nonzero(left.products(low, high, right, columns) > least - left.margin)
        i, j = i + low, columns[j]
        cosines = left.cosines(i, right, j)
        keep = cosines > least
        if keep.any():
            yield i[keep], j[keep], cosines[keep]


def _trend_score(near: np.ndarray, far: np.ndarray, w_sim: float, w_dis: float) -> np.ndarray:
    return (w_sim * near - w_dis * far + w_dis / 2) / (w_sim + w_dis / 2)


def attach_first_product(matches: DataFrame, item_keywords: DataFrame) -> DataFrame:
    """The first product (by id) that carries the matched catalogue keyword."""
    first = keep_first(item_keywords, ["web_id", "keyword"], [F.asc("product_id")])
    return matches.join(first.withColumnRenamed("keyword", "keyword_item"), ["web_id", "keyword_item"])


def _alike(articles: DataFrame) -> DataFrame:
    """(article_id, like): the smallest article with the same words; unknown words are all one.

    A word that comes with several vectors is told apart by their hashes.
    """
    word = F.struct(F.when(F.col("vector").isNotNull(), F.col("word")).alias("word"), F.xxhash64("vector").alias("print"))
    sets = articles.groupBy("article_id").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(word))), 256).alias("_set"))
    sets = materialise(sets, "word-sets")
    first = sets.groupBy("_set").agg(F.min("article_id").alias("like"))
    return salted_join(sets, first, ["_set"]).select("article_id", "like")


def match_ads(articles: DataFrame, ads: DataFrame, block: int = AD_BLOCK) -> DataFrame:
    """Best ad, and best keyword inside it, for every article.

    ``articles`` is (article_id, word, vector), ``ads`` (ad_id, word, vector); unknown words have a
    null vector and similarity -1. An ad keyword scores mean + one standard deviation over the
    article's words, an ad the same over its keywords; ties go to the smaller id and word.

    Articles with the same words are scored once. A block of words travels to every block of the other side, so blocks
    are large, and a task walks a pair of them a few articles at a time (``ad_scores``).
    """

    def ready_rows(rows: DataFrame, key: str) -> DataFrame:
        single = rows.schema["vector"].dataType.elementType == FloatType()  # travels as such, counts as double
        kind = "float" if single else "double"
        ready = rows.select(F.col(key).alias("owner"), "word", F.col("vector").cast(f"array<{kind}>").alias("vector"))
        width = ready.agg(F.max(F.size("vector"))).scalar()
        # an unknown word travels as a vector without length, which scores -1
        return ready.withColumn("vector", F.coalesce("vector", F.array_repeat(F.lit(0.0).cast(kind), width)))

    alike = materialise(_alike(articles), "alike")
    scored = articles.join(alike.where(F.col("article_id") == F.col("like")).select("article_id"), "article_id", "left_semi")
    pairs = block_pairs(ready_rows(scored, "article_id"), ready_rows(ads, "ad_id"), (), block, group="owner", copies=AD_COPIES)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("l_owner", "l_vector", "r_owner", "r_word", "r_vector")
        for lo, lv, ro, rw, rv in _block_rows(batches, names):
            owners, ad_ids, words = np.array(lo.as_py()), np.array(ro.as_py()), np.array(rw.as_py())
            rows, cols = np.lexsort((words, ad_ids)), np.argsort(owners, kind="stable")
            sides = []
            for vectors, order, owned in ((lv, cols, owners), (rv, rows, ad_ids)):
                units, empty = _units(vectors, len(order))
                named, number = np.unique(owned[order], return_inverse=True)
                sides.append((named, Words.of(units[order], empty[order], number)))
            (article_names, articles), (ad_names, offers) = sides
            picks, places, scores = best_ads(articles, offers)
            out = {
                "article_id": article_names.tolist(),
                "ad_id": ad_names[picks].tolist(),
                "keyword": [str(w) for w in words[rows][offers.starts[picks] + places]],
                "score": scores,
            }
            yield pa.RecordBatch.from_pydict(out)

    schema = "article_id string, ad_id string, keyword string, score double"
    local = pairs.drop("l_word").mapInArrow(best, schema)
    winner = keep_first(local, ["article_id"], [F.desc(F.round("score", 9)), F.asc("ad_id")])
    every = salted_join(alike, winner.withColumnRenamed("article_id", "like"), ["like"]).drop("like")
    return every.select("article_id", "ad_id", "keyword", "score", F.concat_ws("_", "ad_id", "keyword").alias("keyword_ad"))


def nearest(queries: DataFrame, words: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest other words by cosine for each query word; each side is (word, vector)."""
    sought = _known(words.select("word", "vector"))
    index = BallIndex.of(sought if queries is words else _known(queries.select("word", "vector")), sought, (), block)
    if index is None:
        return queries.sparkSession.createDataFrame([], "word string, other string, similarity double")

    def score(left: Letters, right: Letters, i: np.ndarray, j: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        same = left.size[i] == right.size[j]
        same[same] = [left.words[x] == right.words[y] for x, y in zip(i[same], j[same])]
        return np.where(same, np.nan, np.round(cosines, 9))

    def least(left: Letters, right: Letters, i: np.ndarray, j: np.ndarray, floors: np.ndarray) -> np.ndarray:
        return floors

    passed = _best(index, score, least, k, -1.0).withColumnRenamed("score", "similarity")
    return top_k(passed, ["word"], [F.desc("similarity"), F.asc("other")], k)


def mean_vector(words: DataFrame, vectors: DataFrame, key: str = "id") -> DataFrame:
    """Mean word vector per document; unknown words are skipped, none known gives zeros.

    ``words`` is (key, word). Spark ML's summarizer averages dense vectors with partial aggregation.
    """
    known = words.join(vectors.select("word", array_to_vector("vector").alias("_v")), "word")
    means = known.groupBy(key).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("vector"))
    width = vectors.agg(F.max(F.size("vector"))).scalar()
    return (
        words.select(key).distinct().join(means, key, "left")
        .withColumn("vector", F.coalesce("vector", F.array_repeat(F.lit(0.0), width)))
    )


def catalogue_text(title: Column, product_id: Column) -> Column:
    """Catalogue title without symbols and without its own product id."""
    return without_term(strip_symbols(title), product_id)


def close_pairs(words: DataFrame, min_cosine: float, block: int = BLOCK) -> DataFrame:
    """(web_id, word, other, similarity) for all pairs of a tenant at or above ``min_cosine``."""
    usable = _known(words.select("web_id", "word", "vector"))

    def passing(own: list, left: Group, right: Group) -> Iterator[pa.RecordBatch]:
        words, others = (np.array(side.words, dtype=object) for side in (left, right))
        for i, j, cosines in _over(left, right, min_cosine - ROUNDING):
            cosines = np.round(cosines, 9)
            keep = (cosines >= min_cosine) & (words[i] != others[j])
            if keep.any():
                columns = [own * int(keep.sum()), words[i[keep]], others[j[keep]], cosines[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["web_id", "word", "other", "similarity"])

    schema = "web_id string, word string, other string, similarity double"
    index = BallIndex.of(usable, usable, ["web_id"], block)
    if index is None:
        return words.sparkSession.createDataFrame([], schema)
    return index.meet_groups(_near_groups(index, min_cosine - ROUNDING), passing, schema)
