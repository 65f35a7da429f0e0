"""Language identification by Bayesian evidence fusion.

For every row and language four pieces of evidence are multiplied:

* the likelihood of the text under a model of hashed character trigrams, the
  logarithm tempered because trigrams overlap and repeat;
* the likelihood of the declared (markup) language given the true one;
* the likelihood of the address suffix given the true language;
* the prior of the host: its languages, smoothed towards those of its domain,
  and these towards the whole corpus.

The last three come from grouped aggregations of the text posteriors of all
rows (soft counts), so a declaration, suffix or host counts as much as it has
proved to agree with the texts.  A row's own posterior is taken out of the
counts it is combined with.  A further class, ``und``, stands for text that is
no language seen (uniform trigrams).

The text model has every declared language, each trained on its own bounded
sample: about ``SAMPLE`` labelled rows chosen by a hash of the row, or all rows
of a rarer language.  ``PSEUDO`` smooths towards uniform trigrams, that is
towards ``und``: a language of few rows is weighed down where a larger model
fits, yet beats ``und`` on trigrams it has seen.  Everything else covers all
rows.  Only the model and totals of a few numbers per language reach the
driver.  The model is sparse: it has one entry of 12 bytes for every bucket that
a language's sample holds, so a tag of one row costs no more than that row's
trigrams.  A row carries the languages within ``CUT`` of its best one; the
others are e^-60 as likely by its text and no other evidence makes up for that.

A row is rejected if ``und`` wins or the winner's posterior is below
``LEAST_POSTERIOR``.

Edge cases: a null or empty text has no text evidence and is judged by the
rest; a null declaration, suffix or host is no evidence (the prior is then
that of the corpus); without any labelled row there is no model, no language
(null) and no rejection; repeated rows get equal results; null ids stay null;
an empty table gives an empty result; extra columns are ignored
(``accepted`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common
from unitcast.llm.decontaminate import checked

UND = "und"
BUCKETS = 1 << 14
SAMPLE = 2000                # training rows per declared language
PSEUDO = 0.5                 # added to every trigram count
OVERLAP = 1 / 3              # trigrams share two of three signs
MOST_EVIDENCE = 300          # trigrams that a text counts for at most, after OVERLAP
EVIDENCE_PSEUDO = 20.0       # rows that a declaration or suffix is smoothed with
PRIOR_ROWS = 50.0            # rows that a host or domain is smoothed with
LEAST_POSTERIOR = 0.5
CUT = 60.0                   # log likelihood below a text's best language that is not written
LEAST_SHARE = 1e-9           # smallest text posterior that counts in a group
EVENLY = -1                  # in place of a language: each language alike (a text without trigrams)
DENSE_CELLS = 1 << 18        # rows x languages that are fused at a time


def trigrams(text: str) -> np.ndarray:
    """Hash buckets of the character trigrams of a lower-cased text."""
    if not text.strip():
        return np.empty(0, dtype=np.int64)
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = (c[:-2] * np.uint32(0x01000193) + c[1:-1]) * np.uint32(0x01000193) + c[2:]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Counts of hashed trigrams by bucket.  A bucket that a language's sample
    lacks has the language's ``base``, the others add their ``gain``."""

    languages: list[str]        # UND is last
    base: np.ndarray            # per language: log probability of a bucket without a count
    first: np.ndarray           # per bucket: its first entry; one more at the end
    language: np.ndarray        # per entry
    gain: np.ndarray            # per entry

    def log_likelihood(self, text: str) -> np.ndarray:
        at = trigrams(text)
        if not len(at):
            return np.zeros(len(self.languages))
        counts = np.bincount(at, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        start, n = self.first[used], self.first[used + 1] - self.first[used]
        entry = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        total = self.base * len(at) + np.bincount(
            self.language[entry], self.gain[entry] * np.repeat(counts[used], n), minlength=len(self.languages))
        return total * (min(OVERLAP * len(at), MOST_EVIDENCE) / len(at))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def primary(language: Column) -> Column:
    """Primary subtag of a language tag, lower case; null if empty."""
    tag = F.lower(F.trim(F.regexp_extract(language, "^\\s*([A-Za-z]+)", 1)))
    return F.when(tag != "", tag)


def train(rows: DataFrame, sample: int = SAMPLE) -> TextModel | None:
    """Fit the trigram model on a sample of ``(_id, _text, _declared)`` that is
    bounded for each declared language."""
    labelled = rows.filter(F.col("_declared") != UND)
    large = labelled.groupBy(F.col("_declared").alias("_large")).agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > sample)       # the others are taken whole
    large = checked(common.stored(large, "large-languages"))
    draw = F.pmod(F.xxhash64("_id", "_text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = (labelled.join(large, F.col("_declared") == F.col("_large"), "left")
              .filter(F.col("_n").isNull() | (draw < F.lit(sample) / F.col("_n"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in common.slices(batches):
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
                held[language] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for language, found in held.items():
            used = np.flatnonzero(found)
            yield pa.record_batch([pa.array([language] * len(used), pa.string()), pa.array(used.astype("int32")),
                                   pa.array(found[used])], names=["_declared", "bucket", "n"])

    summed = (chosen.select("_declared", "_text").mapInArrow(run, "_declared string, bucket int, n long")
              .groupBy("_declared", "bucket").agg(F.sum("n").alias("n"))
              .groupBy("_declared").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n"))
              .orderBy("_declared").toArrow())      # one row per language, at most BUCKETS entries in it
    if not summed.num_rows:
        return None
    buckets, counts = summed["bucket"].combine_chunks(), summed["n"].combine_chunks()
    language = np.repeat(np.arange(summed.num_rows, dtype=np.int32), np.diff(buckets.offsets.to_numpy()))
    bucket, n = buckets.flatten().to_numpy(), counts.flatten().to_numpy()
    size = np.bincount(language, n, minlength=summed.num_rows) + PSEUDO * BUCKETS
    order = np.argsort(bucket, kind="stable")
    return TextModel([*summed["_declared"].to_pylist(), UND], np.append(np.log(PSEUDO / size), -np.log(BUCKETS)),
                     np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))]),
                     language[order], np.log1p(n / PSEUDO)[order])


def _scored(rows: DataFrame, model: TextModel) -> DataFrame:
    """Rows without text, with their likely languages ``_c``, the text
    evidence ``_ll`` and the text posterior ``_own`` of each."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["_id", "_row", "_declared", "_suffix", "_host", "_domain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in common.slices(batches):
            found = [likely(m, t.as_py()) for t in batch.column(len(kept))]
            starts = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([f[k] for f in found]), t))
                     for k, t in enumerate((pa.int32(), pa.float64(), pa.float64()))] if found else \
                [pa.array([], pa.list_(t)) for t in (pa.int32(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*kept, "_c", "_ll", "_own"])

    return rows.select(*kept, "_text").mapInArrow(
        run, "_id long, _row long, _declared string, _suffix string, _host string, _domain string, "
             "_c array<int>, _ll array<double>, _own array<double>")


def likely(model: TextModel, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language, log likelihood, posterior) of the languages within ``CUT`` of
    the text's best; ``EVENLY`` where the text says nothing."""
    ll = model.log_likelihood(text)
    if not ll.any():
        return np.array([EVENLY]), np.zeros(1), np.ones(1)
    c = np.flatnonzero(ll >= ll.max() - CUT)
    return c, ll[c], softmax(ll[c])


def _soft_counts(scored: DataFrame, key: str, name: str) -> DataFrame:
    """Summed text posteriors by language ``c`` per value of ``key`` (map-side
    combined; a list has at most one entry per language), and their total."""
    return (scored.filter(F.col(key).isNotNull())
            .select(F.col(key).alias(f"k{key}"), F.explode(F.arrays_zip("_c", "_own")).alias("_e"))
            .filter(F.col("_e._own") > LEAST_SHARE)
            .groupBy(f"k{key}", F.col("_e._c").alias("_c")).agg(F.sum("_e._own").alias("_n"))
            .groupBy(f"k{key}").agg(F.collect_list(F.struct(F.col("_c").alias("c"), F.col("_n").alias("n"))).alias(name),
                                    F.sum("_n").alias(f"{name}_total")))


def _of_row(counts: str) -> Column:
    """The counts of a group that concern the languages of its row."""
    return F.when(F.get("_c", F.lit(0)) == EVENLY, F.col(counts)).otherwise(
        F.filter(counts, lambda x: (x["c"] == EVENLY) | F.array_contains("_c", x["c"])))


def _dense(c: list, values: list, languages: int, empty: float) -> np.ndarray:
    """Rows x languages from lists (null: none) of languages and values; what
    is given ``EVENLY`` is shared by all languages (values) or holds for each
    (evidence, where ``empty`` is not 0)."""
    lengths = [0 if x is None else len(x) for x in c]
    out = np.full((len(c), languages), empty)
    if not sum(lengths):
        return out
    row = np.repeat(np.arange(len(c)), lengths)
    at = np.concatenate([x for x in c if x is not None]).astype(np.int64)
    value = np.concatenate([x for x in values if x is not None]).astype(np.float64)
    one = at >= 0
    out[row[one], at[one]] = value[one]
    if not one.all():
        if empty:
            out[row[~one]] = value[~one][:, None]
        else:
            out[row[~one]] += value[~one][:, None] / languages
    return out


def identify(df: DataFrame, id_col: str, text_col: str, declared_col: str | None = None, url_col: str | None = None,
             host_col: str | None = None, least_posterior: float = LEAST_POSTERIOR,
             sample: int = SAMPLE) -> DataFrame:
    """``(_id, _row, language, confidence, text_language, declared, keep)`` of
    every row.  ``url_col`` gives host and suffix; ``host_col`` a host alone."""
    none = F.lit(None).cast("string")
    host = F.lower(F.regexp_extract(F.col(url_col), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)) \
        if url_col else F.col(host_col) if host_col else none
    rows = df.select(
        common.key_of(id_col).alias("_id"), row_hash(F.col(id_col), F.col(text_col)).alias("_row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        (primary(F.col(declared_col)) if declared_col else none).alias("_declared"),
        F.when(host != "", host).alias("_host"))
    labels = F.split("_host", "\\.")
    rows = rows.withColumn("_domain", F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, -2, 2)))) \
        .withColumn("_suffix", F.when((F.size(labels) > 1), F.element_at(labels, -1)) if url_col else none)
    model = train(rows, sample)
    if model is None:
        return rows.select("_id", "_row", none.alias("language"), F.lit(None).cast("double").alias("confidence"),
                           none.alias("text_language"), F.col("_declared").alias("declared"), F.lit(True).alias("keep"))
    n = len(model.languages)
    scored = common.stored(_scored(rows, model), "language-scores")
    totals = (scored.select(F.explode(F.arrays_zip("_c", "_own")).alias("_e"))
              .groupBy(F.col("_e._c").alias("c")).agg(F.sum("_e._own").alias("n")).orderBy("c").toPandas())
    corpus = _dense([totals["c"].to_numpy()], [totals["n"].to_numpy()], n, 0.0)[0]
    distinct = scored.agg(F.count_distinct("_declared"), F.count_distinct("_suffix")).first()
    kinds, languages = {"d": max(1, distinct[0]), "s": max(1, distinct[1])}, np.array(model.languages, dtype=object)

    hosts = (_soft_counts(scored, "_host", "_h")
             .withColumn("_hd", F.when(F.size(F.split("k_host", "\\.")) > 1,
                                       F.concat_ws(".", F.slice(F.split("k_host", "\\."), -2, 2))))
             .join(_soft_counts(scored, "_domain", "_p"), F.col("_hd") == F.col("k_domain"), "left")
             .select("k_host", "_h", "_h_total", "_p", "_p_total"))
    fused = (scored
             .join(_soft_counts(scored, "_declared", "_d"), F.col("_declared") == F.col("k_declared"), "left")
             .join(_soft_counts(scored, "_suffix", "_s"), F.col("_suffix") == F.col("k_suffix"), "left")
             .join(hosts, F.col("_host") == F.col("k_host"), "left"))
    groups = ("_d", "_s", "_h", "_p")
    for g in groups:
        fused = fused.withColumn(g, _of_row(g))

    def posteriors(c: list, ll: list, own: list, counts: list, host_total: np.ndarray, domain_total: np.ndarray):
        """Text evidence and fused posterior, rows x languages."""
        text, mine = _dense(c, ll, n, -np.inf), _dense(c, own, n, 0.0)
        rest = np.maximum(corpus - mine, 0.0)
        # soft counts of the other rows of each group, zero where there is no group
        d, s, h, p = (np.maximum(_dense(k, v, n, 0.0) - np.where([[x is not None] for x in k], mine, 0.0), 0.0)
                      for k, v in counts)
        score = text.copy()
        for found, (k, _), kind in ((d, counts[0], "d"), (s, counts[1], "s")):
            fits = np.log((found + EVIDENCE_PSEUDO / kinds[kind]) / (rest + EVIDENCE_PSEUDO))
            score += np.where([[x is not None] for x in k], fits, 0.0)
        prior = (rest + 1.0 / n) / (rest.sum(axis=1, keepdims=True) + 1.0)
        for found, total in ((p, domain_total), (h, host_total)):
            others = np.maximum(total[:, None] - 1.0, 0.0)      # a row's own posterior sums to 1
            prior = (found + PRIOR_ROWS * prior) / (others + PRIOR_ROWS)
        return text, softmax(score + np.log(prior))

    @F.pandas_udf("language string, confidence double, text_language string")
    def fuse(c: pd.Series, ll: pd.Series, own: pd.Series, dc: pd.Series, dn: pd.Series, sc: pd.Series, sn: pd.Series,
             hc: pd.Series, hn: pd.Series, pc: pd.Series, pn: pd.Series, ht: pd.Series, pt: pd.Series) -> pd.DataFrame:
        lists = [x.to_list() for x in (c, ll, own, dc, dn, sc, sn, hc, hn, pc, pn)]
        ht, pt = ht.fillna(0.0).to_numpy(), pt.fillna(0.0).to_numpy()
        best, sure, by_text = [], [], []
        step = max(1, DENSE_CELLS // n)
        for at in range(0, len(c), step):
            x = [part[at:at + step] for part in lists]
            text, posterior = posteriors(*x[:3], list(zip(x[3::2], x[4::2])), ht[at:at + step], pt[at:at + step])
            best.append(posterior.argmax(axis=1))
            sure.append(posterior.max(axis=1))
            by_text.append(text.argmax(axis=1))
        if not best:
            return pd.DataFrame({"language": [], "confidence": [], "text_language": []})
        return pd.DataFrame({"language": languages[np.concatenate(best)], "confidence": np.concatenate(sure),
                             "text_language": languages[np.concatenate(by_text)]})

    sent = ["_c", "_ll", "_own", *[f"{g}.{k}" for g in groups for k in ("c", "n")], "_h_total", "_p_total"]
    return (fused.withColumn("_found", fuse(*sent))
            .select("_id", "_row", "_found.language", "_found.confidence", "_found.text_language",
                    F.col("_declared").alias("declared"))
            .withColumn("keep", (F.col("language") != UND) & (F.col("confidence") >= least_posterior)))


def row_hash(row_id: Column, text: Column) -> Column:
    return F.xxhash64(row_id.cast("long"), text)


def accepted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **evidence) -> DataFrame:
    """The rows of ``df`` (all columns) that language ID keeps."""
    found = identify(df, id_col, text_col, **evidence)
    gone = found.filter(~F.col("keep")).select(F.col("_id").alias("_gone"), F.col("_row").alias("_gone_row")).distinct()
    gone = checked(common.stored(gone, "rejected"))
    return df.join(gone, (common.key_of(id_col) == F.col("_gone"))
                   & (row_hash(F.col(id_col), F.col(text_col)) == F.col("_gone_row")), "left_anti")


def page_rows(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, declared)`` of web pages: text without markup,
    and the language that the markup declares."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(html, "(?i)<html[^>]*\\slang\\s*=\\s*[\"']?([A-Za-z-]+)", 1)
    return pages.select("page_id", "url", text.alias("text"), declared.alias("declared"))
