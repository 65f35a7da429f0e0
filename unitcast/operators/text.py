"""Text features: G1, G2, G4, G5 and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unitcast import config
from unitcast.operators.aggregate import with_scalar
from unitcast.operators.joins import materialize
from unitcast.functions.columns import dash_subtype, dash_type, first_token, text_length, tokens, word_count


def text_stats(df: DataFrame, c: str, prefix: str | None = None) -> DataFrame:
    """Character length and single-space piece count of ``c``."""
    p = prefix or c
    return df.withColumn(f"{p}_length", text_length(c)).withColumn(f"{p}_word_count", word_count(c))


def shop_city(df: DataFrame, name: str = "shop_name") -> DataFrame:
    """First token of the shop name."""
    return df.withColumn("city", first_token(name))


def category_type_subtype(df: DataFrame, name: str = "item_category_name") -> DataFrame:
    """G5: 'type - subtype' split; the subtype falls back to the type."""
    return df.withColumn("type", dash_type(name)).withColumn("subtype", dash_subtype(name))


def term_totals(df: DataFrame, text: str) -> DataFrame:
    """(term, total, df): occurrences of each term and documents that hold it.
    Tokens and distinct tokens are exploded as plain arrays and counted
    map-side, so only a count per term and task is exchanged; both counts meet
    on the term they are already dealt by."""
    t = df.filter(F.col(text).isNotNull()).select(tokens(text).alias("_t"))

    def counted(terms, name: str) -> DataFrame:
        # outer: a plain explode would first split every text again to filter on its size
        return (t.select(F.explode_outer(terms).alias("term")).filter(F.col("term").isNotNull())
                .groupBy("term").agg(F.count(F.lit(1)).alias(name)))

    return counted(F.col("_t"), "total").join(counted(F.array_distinct("_t"), "df"), "term")


def tfidf_fit(df: DataFrame, id_col: str, text: str, max_features: int = config.TFIDF_TERMS) -> DataFrame:
    """G3 fit: vocabulary of the ``max_features`` most frequent terms.

    Returns (term, idx, idf): idx = alphabetical position among the kept
    terms, idf = ln((1 + n_docs) / (1 + df)) + 1.  Ties at the cut-off are
    broken by term.  The top-k is a distributed take-ordered (each task keeps
    only ``max_features`` rows), so the vocabulary frame has a proven bound.
    """
    n_docs = df.select(id_col).agg(F.count(F.lit(1)).alias("n_docs"))
    top = term_totals(df, text).orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    top = top.withColumn("n_docs", n_docs.scalar())
    return top.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).cast("int").alias("idx"),
        (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_transform(df: DataFrame, vocab: DataFrame, id_col: str, text: str,
                    max_features: int = config.TFIDF_TERMS) -> DataFrame:
    """G3 transform: long form (id, term, idx, weight), L2-normalised per
    document over the kept terms.  Documents without a kept term have no rows.
    Tokens meet the vocabulary (at most ``max_features`` terms, so broadcast)
    as they are exploded; the kept ones are counted map-side into one row per
    document, and weights and norm are sums over that row's array."""
    words = vocab.agg(F.array_sort(F.collect_list(F.struct("idx", "term", "idf"))).alias("_v"))
    rows = df.filter(F.col(text).isNotNull()).select(id_col, F.explode_outer(tokens(text)).alias("_term"))
    kept = rows.join(F.broadcast(vocab.select(F.col("term").alias("_term"), "idx")), "_term")
    n = kept.groupBy(id_col).agg(*[F.count(F.when(F.col("idx") == i, 1)).alias(f"_{i}") for i in range(max_features)])
    counted = with_scalar(n.select(id_col, F.array(*[f"_{i}" for i in range(max_features)]).alias("_n")), words)
    cells = counted.select(id_col, F.transform("_v", lambda v: F.struct(
        v["idx"].alias("idx"), v["term"].alias("term"), (F.get("_n", v["idx"]) * v["idf"]).alias("w"))).alias("_c"))
    norm = F.sqrt(F.aggregate("_c", F.lit(0.0), lambda s, c: s + c["w"] * c["w"]))
    out = cells.select(id_col, norm.alias("_norm"), F.explode("_c").alias("_c")).filter("_c.w > 0")
    return out.select(id_col, "_c.term", "_c.idx", (F.col("_c.w") / F.col("_norm")).alias("weight"))


def tfidf(df: DataFrame, id_col: str, text: str, max_features: int = config.TFIDF_TERMS) -> DataFrame:
    """G3 fit + transform.  The vocabulary is stored: it is read twice, as a
    lookup and as the array of its weights, and fitted once."""
    vocab = materialize(tfidf_fit(df, id_col, text, max_features))
    return tfidf_transform(df, vocab, id_col, text, max_features)


def tfidf_wide(long: DataFrame, id_col: str, prefix: str,
               max_features: int = config.TFIDF_TERMS) -> DataFrame:
    """Dense form for models: one column ``<prefix>_tfidf_<idx>`` per kept term."""
    out = long.groupBy(id_col).pivot("idx", list(range(max_features))).agg(F.first("weight"))
    return out.select(id_col, *[F.coalesce(F.col(f"`{i}`"), F.lit(0.0)).alias(f"{prefix}_tfidf_{i}")
                                for i in range(max_features)])
